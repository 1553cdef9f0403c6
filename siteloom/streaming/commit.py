"""Per-batch commit of a stream of sites: each micro-batch's results are appended once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siteloom.sources.sites import SITES


def site_stream(spark: SparkSession, folder: str, files: int = 100) -> DataFrame:
    """CSV files of sites that arrive in a folder; each has the header of the full schema."""
    return spark.readStream.schema(SITES).option("header", True).option("maxFilesPerTrigger", files).csv(folder)


def commit(stream: DataFrame, process: Callable[[DataFrame], DataFrame], results: str, checkpoint: str):
    """Start a query that writes ``process`` of each batch. A batch that is repeated after a failure overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{results}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
