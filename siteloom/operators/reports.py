"""Reports: totals, display rows, review images, and the regenerate job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.config import DEFAULT, OBLIQUES, Config
from siteloom.functions.scalars import asset_label, clean, confidence, cut, equipment, is_true, located, metres


def failed() -> Column:
    return clean(F.col("error")).isNotNull()


def classified() -> Column:
    return F.coalesce(F.col("site_type") != "no_imagery", F.lit(False)) & ~failed()


def is_located() -> Column:
    return F.col("asset_lat").isNotNull() | clean(F.col("asset_view")).isNotNull()


def kpis(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals of the summary, over everything or by ``by``; towers and rooftops count among the classified."""
    ok, one = classified(), lambda c, name: F.count_if(c).alias(name)
    return results.groupBy(*(by or [])).agg(
        F.count("*").alias("total"), one(failed(), "errors"), one(ok, "classified"), one(ok & (F.col("site_type") == "tower"), "towers"),
        one(ok & (F.col("site_type") == "rooftop"), "rooftops"), one(ok & is_true(F.col("cell_equipment")), "cell_hits"), one(ok & is_located(), "located"),
    )


def terminal_rollup(results: DataFrame) -> DataFrame:
    """Totals at a run's end: over all rows, errors included."""
    return results.agg(
        (F.count("*") - F.count_if(failed())).alias("ok"), F.count_if(failed()).alias("errors"), F.count_if(F.col("site_type") == "tower").alias("towers"),
        F.count_if(F.col("site_type") == "rooftop").alias("rooftops"), F.count_if(is_true(F.col("cell_equipment"))).alias("cell_hits"),
    )


def regenerate(results: DataFrame) -> DataFrame:
    """Results with confidences brought to 0..1 again, and whether a row changed."""
    names = [c for c in ("site_confidence", "cell_equipment_confidence") if c in results.columns]
    new = {c: confidence(F.col(c)) for c in names}
    changed = F.lit(False)
    for c in names:
        changed = changed | ~F.col(c).try_cast("double").eqNullSafe(new[c])
    return results.withColumn("changed", changed).withColumns(new)


def stakeholder_rows(results: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Display columns (and ``keep``): an error, no imagery, or the finding."""
    bad, none = failed(), F.coalesce(F.col("site_type") == "no_imagery", F.lit(False))
    dash = F.lit("—")
    conf = F.bround(confidence(F.col("site_confidence")), 2)
    return results.select(
        *(keep or ["id"]), asset_label(F.col("id"), F.col("label")).alias("asset"),
        F.when(bad, "error").when(none, "no imagery").otherwise(F.col("site_type")).alias("site_type"),
        F.when(~bad & ~none, conf).alias("conf"),
        F.when(bad | none, dash).otherwise(located(F.col("asset_offset_m"), F.col("asset_view"))).alias("located"),
        F.when(bad, F.substring(F.trim("error"), 1, 120)).when(none, dash).otherwise(equipment(F.col("cell_equipment"), F.col("cell_equipment_evidence"))).alias("cell_equip"),
        F.when(~bad & none, 0).otherwise(F.coalesce("view_count", F.lit(0))).alias("views"),
        F.when(bad | ~none, F.col("review_image")).alias("review_image"),
    )


def display(rows: DataFrame) -> DataFrame:
    """``stakeholder_rows`` under their headings; a confidence that isn't there is a dash, so the column is text."""
    conf = F.coalesce(F.col("conf").cast("string"), F.lit("—"))
    names = {"asset": "Asset", "site_type": "Site type", "conf": "Conf", "located": "Located", "cell_equip": "Cell equip", "views": "Views", "review_image": "Review image"}
    return rows.select(*[(conf if c == "conf" else F.col(c)).alias(n) for c, n in names.items()])


def regions(inputs: DataFrame, order: str = "input_ord") -> DataFrame:
    """id and region: the input's label; of a repeated id the last one's."""
    return inputs.groupBy("id").agg(F.max_by(F.trim("label"), order).alias("region"))


def with_region(results: DataFrame, inputs: DataFrame, order: str = "input_ord") -> DataFrame:
    """The optimizer broadcasts the inputs if they are small enough; there is no hint that would force it."""
    return results.join(regions(inputs, order), "id", "left").withColumn("region", F.coalesce("region", F.trim("label"), F.lit("")))


def summary_rows(results: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One line of the summary's table for each result that has a region."""
    bad, none = failed(), F.coalesce(F.col("site_type") == "no_imagery", F.lit(False))
    conf = F.concat(F.bround(F.col("site_confidence") * 100, 0).cast("long").cast("string"), F.lit("%"))
    cell = F.when(F.col("cell_equipment").isNull(), "Unknown").when(F.col("cell_equipment"), "Yes").otherwise("No")
    off, view = F.col("asset_offset_m"), clean(F.col("asset_view"))
    where = F.when(F.col("asset_lat").isNotNull(), F.coalesce(metres(off), F.lit("yes"))).when(view.isNotNull(), F.concat(F.lit("on "), view)).otherwise("—")
    stage = F.when(F.col("nearmap_aoi_m") == config.wide_m, "wide AOI").otherwise(F.coalesce("classification_stage", F.lit("primary")))
    head = [F.lit("|"), F.col("id"), F.lit("|"), F.col("region"), F.lit("|")]

    def line(*cells: Column) -> Column:
        parts = [*head]
        for c in cells:
            parts += [F.coalesce(c, F.lit("—")), F.lit("|")]
        return F.concat_ws(" ", *parts)

    d = F.lit("—")
    return results.select("id", F.when(bad, line(F.lit("**ERROR**"), d, d, d, d, cut(clean(F.col("error")), 60))).when(
        none, line(F.lit("No imagery"), d, d, d, d, F.lit("Outside coverage"))
    ).otherwise(line(F.col("site_type"), conf, cell, where, stage, cut(F.coalesce("site_evidence", F.lit("")), 90))).alias("line"))


def review_images(results: DataFrame, chips: DataFrame) -> DataFrame:
    """id and review_image: the best of a site's saved images (chips: path), null without one.

    results: id, cell_equipment, nearmap_views, asset_view, chip_path, zoom_paths (array). Candidates are ranked in one
    array, so one semi-join finds which exist.
    """
    views, shown = F.lower(F.coalesce("nearmap_views", F.lit(""))), F.lower(F.coalesce("asset_view", F.lit("")))

    def near(name: str) -> Column:
        return F.concat(F.col("id"), F.lit(f"_nearmap_{name}.jpg"))

    names = [v.lower() for v in OBLIQUES]
    ranked = [F.when(is_true(F.col("cell_equipment")) & (views.contains(n) | shown.contains(n)), near(n)) for n in names]
    ranked += [F.when(shown.contains(n), near(n)) for n in names]
    ranked += [F.when(shown.contains("nearmap top-down") | views.contains("vert"), near("vert")), clean(F.col("chip_path")), near("vert"), F.concat(F.col("id"), F.lit("_NAIP.jpg"))]
    every = F.concat(F.array(*ranked), F.array_sort(F.coalesce("zoom_paths", F.array().cast("array<string>"))))
    rows = results.select("id", F.posexplode(every).alias("pos", "path")).where("path IS NOT NULL").join(chips.select("path").distinct(), "path", "left_semi")
    return results.select("id").join(rows.groupBy("id").agg(F.min_by("path", "pos").alias("review_image")), "id", "left")


def progress(results: DataFrame, order: list[str]) -> DataFrame:
    """Results with their row number (from 1) in an order: ranges are numbered by themselves, then moved on by the rows before them."""
    parts = results.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # of one row a range
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return parts.join(counts, "_part").withColumn("row", F.col("_n") + F.col("_before")).drop("_part", "_n", "_before")


_TABLE = ["| Asset | Region | Site type | Confidence | Cell equip. | Located | Method | Key finding |", "|---|---|---|---:|---|---|---|---|"]
_GLANCE = (("Assets evaluated", "total"), ("Successfully classified", "classified"), ("Tower sites identified", "towers"), ("Rooftop sites identified", "rooftops"), ("Cellular equipment detected", "cell_hits"), ("Assets with a located position", "located"), ("Errors", "errors"))
_HOW = (
    "1. A site's newest public aerial image is fetched, and detailed views where there are any.",
    "2. A vision model names the kind of site, its equipment and where in an image it is; an unsure answer is asked for again with more views or another model.",
    "3. A site that stays unclear is looked at over a wider area, then in magnified crops.",
    "4. A box on the georeferenced image becomes coordinates and a distance from the recorded point.",
)
_SOURCES = ("| Source | Gives |", "|---|---|", "| NAIP | the wide view from above, on the map grid |", "| Nearmap | fine vertical and oblique views, by subscription |", "| Vision model | the answer, with its confidence and evidence |")
_NOTES = ("- Images are in `chips/`: `*_NAIP.jpg`, `*_nearmap_*.jpg`, `*_zoom_*.jpg`.", "- The detail table has every field of every site.")
_LIMITS = ("- Where there is no oblique view, equipment on walls is hard to see.", "- Small lattice towers may only show in the crops.", "- Answers of low confidence should be checked by eye.")
_NEXT = ("1. Look at what is unclear or of low confidence.", "2. Hand confident towers and rooftops on.")


def markdown(totals: dict, lines, generated: str = "") -> str:
    """The summary document from one row of totals and the lines of its table."""
    sections = [
        ("At a glance", [f"- **{name}:** {totals[key]}" for name, key in _GLANCE]), ("How it works", _HOW), ("Imagery sources", _SOURCES),
        ("Results by asset", [*_TABLE, *lines]), ("Operational notes", _NOTES), ("Known limitations", _LIMITS), ("Next steps", _NEXT),
    ]
    out = ["# Summary", ""] + ([f"*Generated: {generated}*", ""] if generated else [])
    for title, body in sections:
        out += [f"## {title}", "", *body, ""]
    return "\n".join(out)
