"""Exclusive running sums over a whole table in two passes over partition totals."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.llm.common import is_small, materialize, shuffles


def running_offsets(df: DataFrame, order: list[str], amount: str, group: list[str] | None = None) -> DataFrame:
    """Add ``offset``: the sum of ``amount`` over the rows before a row (of its group) in ``order``.

    Pass 1 range-partitions the rows and sums up each partition (of each group); pass 2 adds the sum of all earlier
    partitions to a running sum within the partition. No task sees more than one range of rows, so a hot group is
    spread over partitions. Rows that tie in ``order`` follow each other in any order.
    """
    group = group or []
    parts = materialize(
        df.repartitionByRange(shuffles(df.sparkSession), *group, *order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    totals = parts.groupBy("_part", *group).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(totals.select("_part", *group, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")), "totals")
    within = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    small = is_small(base)
    return (
        parts.withColumn("_before", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(F.broadcast(base) if small else base, ["_part", *group])
        .withColumn("offset", F.col("_base") + F.col("_before"))
        .drop("_part", "_base", "_before")
    )


def words_count(text: str = "text"):
    """Runs of anything but white space; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r\f]+")), F.lit(0)).cast("long")


def with_row(docs: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``: a row's place in the files that ``docs`` is read from. What isn't read from files, or from files without such places (JSON), is written first.

    The columns of ``docs`` are those of the struct ``_doc``, so names that clash do no harm.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")

    def placed(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")
        return df.select(whole, place["file_path"].alias("_file"), place["row_index"].alias("_row"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(materialize(docs, "rows"))


def short_file(rows: DataFrame) -> DataFrame:
    """``rows`` with a hash for ``_file``, if no two files have the same."""
    names = rows.select("_file").distinct().agg(F.count("*").alias("n"), F.count_distinct(F.xxhash64("_file")).alias("h")).first()
    return rows.withColumn("_file", F.xxhash64("_file")) if names.n == names.h else rows
