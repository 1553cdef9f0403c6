"""A run over the logged tables of what was fetched and answered, and its command line.

    python -m siteloom.run --input X_assets.csv --logs FOLDER [--run-dir DIR] [--regenerate-report]

FOLDER holds Parquet tables; those that are absent are empty: geocodes (address, source, lat, lon, matched_address, quality,
error), scenes (id, dt, item_ord), tiles and wide_tiles (id, view, status), coverage (id, capture_date, survey_ord, error),
replies (id, stage, attempt, model, raw, error), scans (id, raw), chips (path). Switches of the environment: NAIP_ONLY,
NEARMAP_TIERED, BIFURCATED_AI.
"""

from __future__ import annotations

import argparse
import shutil
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.config import STAGES, flag
from siteloom.functions.replies import SCAN, parse
from siteloom.operators import cascade, imagery, intake, reports
from siteloom.sources import sites as files
from siteloom.sources import workbook

_LOGS = {
    "geocodes": "address string, source string, lat double, lon double, matched_address string, quality string, error string", "scenes": "id string, dt timestamp, item_ord int",
    "tiles": "id string, view string, status int", "wide_tiles": "id string, view string, status int", "coverage": "id string, capture_date string, survey_ord int, error string",
    "replies": "id string, stage string, attempt int, model string, raw string, error string", "scans": "id string, raw string", "chips": "path string",
}


def read_logs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    there = {p.stem for p in Path(folder).iterdir()} if "://" not in folder else set(_LOGS)
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet") if name in there else spark.createDataFrame([], schema) for name, schema in _LOGS.items()}


def classify(sites: DataFrame, logs: dict[str, DataFrame], mode: str = "full", escalate: bool = True) -> DataFrame:
    """Result rows of ``sites``: an error, no imagery, or what the cascade found. Sites are moved by id once for each log."""
    resolved = intake.resolve(sites, logs["geocodes"])
    found = imagery.with_imagery(resolved.where("error IS NULL").drop("error"), logs["scenes"], logs["tiles"], logs["coverage"], logs["wide_tiles"])
    stages = cascade.pivot_stages(cascade.from_log(logs["replies"]), list(STAGES))
    scans = logs["scans"].select("id", parse(F.col("raw"), SCAN)["candidates"].alias("candidates"))
    asked = scans.join(sites.select("id", cascade.forced(F.col("label")).alias("forced")), "id").withColumn(
        "candidates", F.transform("candidates", lambda x: F.struct(F.transform(x["box_2d"], lambda v: v.try_cast("double")).alias("box"), x["reason"].alias("reason")))
    )
    crops = scans.select("id").distinct().join(cascade.crop_counts(imagery.zoom_candidates(asked)), "id", "left").withColumn("zoom_crops", F.coalesce("zoom_crops", F.lit(0)))
    lost = logs["replies"].where("raw IS NULL").groupBy("id").agg(F.max_by("error", "attempt").alias("_lost"))
    rows = cascade.final_projection(cascade.cascade(found.join(stages, "id", "left").join(crops, "id", "left"), mode, escalate))
    rows = rows.join(lost, "id", "left").withColumn("error", F.when(F.col("site_type").isNull(), F.coalesce("_lost", F.lit("no logged reply")))).drop("_lost")
    return resolved.where("error IS NOT NULL").unionByName(rows, allowMissingColumns=True)


def latest(results: DataFrame) -> DataFrame:
    """One row a site of a store that keeps each run's: what is done, else one of its failures."""
    done = intake.done(results)
    others = [c for c in results.columns if c != "id"]
    failed = results.join(done.select("id"), "id", "left_anti").groupBy("id").agg(F.max(F.struct(*others)).alias("_r")).select("id", "_r.*")
    return done.unionByName(failed)


def reports_of(spark: SparkSession, results: DataFrame, inputs: DataFrame, folder: Path, names: files.Names, chips: DataFrame | None = None) -> None:
    """Detail CSV, stakeholder CSV and summary; lines of the summary are streamed, the CSVs are folders of parts."""
    files.export_csv(results, f"{folder}/{names.detail}")
    if chips is not None:
        rows = results.drop("review_image").withColumn("zoom_paths", F.array().cast("array<string>"))
        zooms = chips.select("path", F.regexp_extract("path", r"([^/]+)_zoom_[0-9]+\.jpg$", 1).alias("id")).where("id <> ''").groupBy("id").agg(F.collect_set("path").alias("_zooms"))
        rows = rows.join(zooms, "id", "left").withColumn("zoom_paths", F.coalesce("_zooms", "zoom_paths")).drop("_zooms")
        results = results.drop("review_image").join(reports.review_images(rows, chips), "id", "left")
    if names.report:
        rows = reports.stakeholder_rows(results).orderBy("id")
        files.export_csv(reports.display(rows), f"{folder}/{names.report}")
        shown = rows.select("asset", "site_type", F.col("conf"), "located", "cell_equip", "views", "review_image")
        workbook.write(f"{folder}/{names.workbook}", ((r[0], r[1], "—" if r[2] is None else r[2], *r[3:]) for r in shown.toLocalIterator()), folder / "chips")
    totals = reports.kpis(results).first().asDict() | {"total": inputs.count()}
    placed = inputs.withColumn("input_ord", F.monotonically_increasing_id())
    lines = reports.summary_rows(reports.with_region(results, placed)).orderBy("id").select("line")
    (folder / names.summary).write_text(reports.markdown(totals, (r.line for r in lines.toLocalIterator()), time.strftime("%Y-%m-%d %H:%M")), encoding="utf-8")


def run(spark: SparkSession, input_csv: str, logs: str | None = None, runs: str = "runs", run_dir: str | None = None, output: str | None = None, report: str | None = None, book: str | None = None, regenerate: bool = False) -> Path:
    """A new run, one that goes on where it ended, or only its reports again; the folder."""
    if regenerate and not run_dir:
        raise SystemExit("--regenerate-report needs --run-dir")
    names = files.names(input_csv, output, report, book)
    folder = files.run_folder(runs, names.prefix, run_dir)
    if not run_dir:
        shutil.copy2(input_csv, folder / Path(input_csv).name)
    store = str(folder / "results.parquet")
    inputs = files.read_sites(spark, files.input_of(str(folder), input_csv))
    if regenerate:
        results = reports.regenerate(latest(files.read_results(spark, store, required=True)))
        fixed = results.where("changed").count()
        reports_of(spark, results.drop("changed"), inputs, folder, names)
        print(f"regenerated {folder}, confidence of {fixed} rows")
        return folder
    intake.validate(inputs)
    kept = intake.done(files.read_results(spark, store))
    todo = intake.pending(inputs, kept)
    number = todo.count()
    print(f"{number} sites, about {files.minutes(number)} min")
    mode = "naip_only" if flag("NAIP_ONLY") else "tiered" if flag("NEARMAP_TIERED") else "full"
    tables = read_logs(spark, logs) if logs else {n: spark.createDataFrame([], s) for n, s in _LOGS.items()}
    fresh = classify(todo, tables, mode, flag("BIFURCATED_AI", True))
    types = dict(f.strip().split(" ") for f in files.RESULTS.split(","))
    shaped = fresh.select(*[(F.col(c) if c in fresh.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
    files.append_results(shaped, store)
    every = latest(files.read_results(spark, store))
    reports_of(spark, every, inputs, folder, names, tables["chips"])
    shown = reports.terminal_rollup(every).first()
    print(f"classified {shown.ok}, errors {shown.errors}, towers {shown.towers}, rooftops {shown.rooftops}, equipment {shown.cell_hits}")
    return folder


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Classify sites from logged imagery and replies")
    parser.add_argument("--input", "-i", default="assets.csv", help="CSV of sites")
    parser.add_argument("--logs", default=None, help="folder of the logged tables")
    parser.add_argument("--runs", default="runs", help="where new run folders go")
    parser.add_argument("--run-dir", default=None, help="a run to go on with")
    parser.add_argument("--output", "-o", default=None, help="name of the detail table in the run folder")
    parser.add_argument("--report-csv", default=None, help="name of the report")
    parser.add_argument("--report-xlsx", default=None, help="name of the workbook")
    parser.add_argument("--regenerate-report", action="store_true", help="only the reports, from the results of a run")
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, a.input, a.logs, a.runs, a.run_dir, a.output, a.report_csv, a.report_xlsx, a.regenerate_report)


if __name__ == "__main__":
    main()
