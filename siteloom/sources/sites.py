"""Files of a run: the input, results, names and folders."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITES = "id string, lat double, lon double, address string, label string, input_confidence string"
RESULTS = (
    SITES + ", geocode_source string, geocode_matched_address string, geocode_quality string, input_address string, site_type string, "
    "site_confidence double, site_evidence string, cell_equipment boolean, cell_equipment_confidence double, cell_equipment_evidence string, "
    "asset_lat double, asset_lon double, asset_offset_m double, asset_box_2d string, asset_view string, image_date string, nearmap_date string, nearmap_views string, view_count int, nearmap_tier string, "
    "nearmap_aoi_m double, classification_stage string, zoom_crops int, source_trust_mismatch boolean, primary_model string, escalation_model string, escalation_reason string, model string, chip_path string, "
    "review_image string, error string"
)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of sites by its header; columns that it lacks are null, blanks are null."""
    return _typed(spark, path, SITES)


def _typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quoted fields may hold commas, quotes and line breaks."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    types = dict(f.strip().split(" ") for f in schema.split(","))
    quoted = {c: F.col(f"`{c}`") for c in raw.columns}
    cols = [(F.nullif(F.trim(quoted[c]), F.lit("")) if c in quoted else F.lit(None)).try_cast(t).alias(c) for c, t in types.items()]
    return raw.select(*cols, *[x for c, x in quoted.items() if c not in types])


def read_results(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """Results kept as Parquet, or a detail CSV; without any an empty table, or an error if they are required."""
    folder = Path(path.removeprefix("file://"))
    if "://" not in path.removeprefix("file://") and not folder.exists():
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], RESULTS)
    return _typed(spark, path, RESULTS) if path.endswith(".csv") else spark.read.schema(RESULTS).parquet(path)


def append_results(results: DataFrame, path: str) -> None:
    """A batch is committed as a whole; what is there isn't written again."""
    results.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


@dataclass(frozen=True)
class Names:
    prefix: str
    detail: str
    report: str | None
    workbook: str | None
    summary: str


def names(input_csv: str, output: str | None = None, report: str | None = None, workbook: str | None = None) -> Names:
    """Of a run's files. Only ``X_assets.csv`` gives them a prefix, and a report without being asked."""
    stem = Path(input_csv).stem
    named = stem.endswith("_assets")
    prefix = stem.replace("_assets", "") if named else stem
    wanted = named or report or workbook
    return Names(
        prefix,
        Path(output).name if output else f"{prefix}_results_detail.csv" if named else "results_detail.csv",
        (Path(report).name if report else f"{prefix}_results.csv") if wanted else None,
        (Path(workbook).name if workbook else f"{prefix}_results.xlsx") if wanted else None,
        f"{prefix}_EXECUTIVE_SUMMARY.md" if named else "EXECUTIVE_SUMMARY.md",
    )


def input_of(folder: str, input_csv: str) -> str:
    """A run's own copy of its input, or the original where there is none."""
    copy = Path(folder) / Path(input_csv).name
    return str(copy) if copy.exists() else input_csv


def run_folder(base: str, prefix: str, reopen: str | None = None) -> Path:
    """A new stamped folder, or one that is there."""
    if reopen:
        if not Path(reopen).is_dir():
            raise FileNotFoundError(reopen)
        return Path(reopen)
    path = Path(base) / f"{datetime.now():%Y-%m-%d_%H%M%S}_{prefix}"
    (path / "chips").mkdir(parents=True, exist_ok=True)
    return path


def minutes(pending: int) -> int:
    """Estimate of a run's length."""
    return max(1, round(0.35 * pending))
