"""Imagery: scenes, tiles, views, candidate boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.config import DEFAULT, OBLIQUES, VIEWS, Config
from siteloom.functions import geo
from siteloom.functions.scalars import crop_label


def newest_scene(scenes: DataFrame, key: str = "id") -> DataFrame:
    """The newest scene of each key; among equally new ones the first of the catalogue (item_ord). Aggregated before the shuffle."""
    rest = [x for x in scenes.columns if x not in (key, "dt", "item_ord")]
    best = F.max_by(F.struct("dt", "item_ord", *rest), F.struct(F.col("dt").alias("a"), (-F.col("item_ord")).alias("b"))).alias("_s")
    return scenes.groupBy(key).agg(best).select(key, "_s.*")


def scenes_at(sites: DataFrame, scenes: DataFrame, cell: float = 1.0, most: int = 1024, spread: int = 8) -> DataFrame:
    """Sites with each scene whose bounding box holds them: an equi-join on grid cells, then the exact test.

    A scene is repeated for the cells that it touches, so ``cell`` should be about a footprint's size. Scenes of one box are tested once,
    as lists of at most ``most``. What a site gives may be thousands of rows, so both sides are shuffled and merged whatever their size
    (a broadcast would leave the work to the few tasks that read the sites), and a cell's sites go to ``spread`` tasks.
    """
    def at(c):
        return F.floor(c / cell)

    box, keys, parts = ["lat_min", "lat_max", "lon_min", "lon_max"], ["_cx", "_cy", "_part"], int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [x for x in scenes.columns if x not in box]
    hashed = [name for name, kind in sites.dtypes if "map<" not in kind]
    left = sites.withColumns({"_cx": at(F.col("lon")), "_cy": at(F.col("lat")), "_part": F.pmod(F.xxhash64(*hashed), F.lit(spread)).cast("int")}).where("lat IS NOT NULL AND lon IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy(*box).orderBy(*box))
    right = scenes.withColumn("_nth", F.floor((nth - 1) / most)).groupBy(*box, "_nth").agg(F.collect_list(F.struct(*rest)).alias("_scenes"))
    right = right.withColumn("_cx", F.explode(F.sequence(at(F.col("lon_min")), at(F.col("lon_max"))))).withColumn("_cy", F.explode(F.sequence(at(F.col("lat_min")), at(F.col("lat_max")))))
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    both = left.repartition(parts, *keys).join(right.repartition(parts, *keys).hint("merge"), keys).where("lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max")
    return both.withColumn("_scene", F.explode("_scenes")).select(*sites.columns, *[F.col(f"_scene.{x}") if x in rest else x for x in scenes.columns])


def tile_ranges(sites: DataFrame, side_m: float = DEFAULT.tile_m, zoom: int = DEFAULT.zoom) -> DataFrame:
    return sites.where("lat IS NOT NULL AND lon IS NOT NULL").withColumns(geo.tile_range(F.col("lat"), F.col("lon"), side_m, zoom))


def tile_plan(sites: DataFrame, views: tuple[str, ...] = VIEWS, config: Config = DEFAULT, side_m: float | None = None) -> DataFrame:
    """One row for each tile of each view, with its place on the view's canvas; nothing is shuffled."""
    side = side_m or config.tile_m
    zooms = F.create_map(*[F.lit(x) for v in views for x in (v, config.zoom if v == "Vert" else config.oblique_zoom)])
    ranges = sites.where("lat IS NOT NULL AND lon IS NOT NULL").withColumn("view", F.explode(F.array(*map(F.lit, views)))).withColumn("z", zooms[F.col("view")])
    two = {z: geo.tile_range(F.col("lat"), F.col("lon"), side, z) for z in (config.zoom, config.oblique_zoom)}
    ranges = ranges.withColumns({c: F.when(F.col("z") == config.zoom, two[config.zoom][c]).otherwise(two[config.oblique_zoom][c]) for c in ("x0", "x1", "y0", "y1")})
    tiles = ranges.withColumn("x", F.explode(F.sequence("x0", "x1"))).withColumn("y", F.explode(F.sequence("y0", "y1")))
    left, top = geo.placement(F.col("view"), F.col("x"), F.col("y"), config.tile_px)
    return tiles.withColumns({"left": left, "top": top})


def arrived_views(tiles: DataFrame) -> DataFrame:
    """id and views, in the fixed order, of which any tile arrived (status 200). A view's tiles that aren't there (404) are left out; any other failure (after the retries) loses the site's whole fetch."""
    spoilt = F.max(F.coalesce(~F.col("status").isin(200, 404), F.lit(True))).alias("_spoilt")
    order = F.array_position(F.array(*map(F.lit, VIEWS)), F.col("view"))
    got = F.array_sort(F.collect_set(F.when(F.col("status") == 200, F.struct(order.alias("o"), "view")))).alias("_v")
    return tiles.groupBy("id").agg(spoilt, got).where("NOT _spoilt AND size(_v) > 0").select("id", F.transform("_v", lambda v: v.view).alias("views"))


def capture_dates(coverage: DataFrame) -> DataFrame:
    """id and nearmap_date: of the surveys that cover a site (capture_date, survey_ord) the first; lookups that failed have none."""
    return coverage.where("error IS NULL").groupBy("id").agg(F.min_by("capture_date", "survey_ord").alias("nearmap_date"))


def with_imagery(sites: DataFrame, scenes: DataFrame, tiles: DataFrame, coverage: DataFrame, wide_tiles: DataFrame | None = None) -> DataFrame:
    """Sites with has_naip, image_date, views, wide_views and nearmap_date, from the logs of what was fetched; all joins are outer ones on id.

    scenes: (id, dt, item_ord) of those at a site. The date of a site without a view is null.
    """
    newest = newest_scene(scenes.select("id", "dt", "item_ord")).select("id", F.date_format("dt", "yyyy-MM-dd").alias("image_date"), F.lit(True).alias("has_naip"))
    none = F.array().cast("array<string>")
    wide = arrived_views(wide_tiles).withColumnRenamed("views", "wide_views") if wide_tiles is not None else sites.select("id").limit(0).withColumn("wide_views", none)
    out = sites.join(newest, "id", "left").join(arrived_views(tiles), "id", "left").join(capture_dates(coverage), "id", "left").join(wide, "id", "left")
    return out.withColumns({
        "has_naip": F.coalesce("has_naip", F.lit(False)), "views": F.coalesce("views", none), "wide_views": F.coalesce("wide_views", none),
        "nearmap_date": F.when(F.coalesce(F.size("views"), F.lit(0)) + F.coalesce(F.size("wide_views"), F.lit(0)) > 0, F.col("nearmap_date")),
    })


def without_imagery(sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sites with neither a NAIP image nor a view, as results, and the others."""
    bare = ~F.col("has_naip") & (F.size("views") == 0)
    return sites.where(bare).select("id", F.lit("no_imagery").alias("site_type")), sites.where(~bare)


def request_blocks(labels: Column, images: Column, prompt: Column) -> Column:
    """array of struct(type, text, data): for each view its label and its image (bytes, in base64), and the prompt last."""

    def block(kind: str, text: Column, data: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), data.cast("string").alias("data"))

    none = F.lit(None)
    pairs = F.transform(F.arrays_zip(labels.alias("l"), images.alias("i")), lambda v: F.array(block("text", F.concat(F.lit("View: "), v["l"]), none), block("image", none, F.base64(v["i"]))))
    return F.concat(F.flatten(pairs), F.array(block("text", prompt, none)))


def zoom_request(context: Column, crops: Column) -> Column:
    """Views of the zoom request: the first of the context, then the crops."""
    return F.concat(F.slice(context, F.lit(1), F.lit(1)), crops)


def merge_views(have: Column, more: Column) -> Column:
    """Views fetched before and now, in the order of arrival."""
    return F.array_union(have, more)


def assemble_views(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows (key, view) as one list a key in the order of ``VIEWS``."""
    order = F.array_position(F.array(*map(F.lit, VIEWS)), F.col("view"))
    lists = rows.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(order.alias("o"), "view"))).alias("_v"))
    views = F.transform("_v", lambda v: v.view)
    return lists.select(key, views.alias("views"))


def view_summary(lists: DataFrame) -> DataFrame:
    """nearmap_views, view_count, any_oblique, missing_views and the labels shown to the model."""
    v = F.col("views")
    label = F.transform(v, lambda x: F.when(x == "Vert", "Nearmap top-down").otherwise(F.concat(F.lit("Nearmap oblique ("), x, F.lit(")"))))
    missing = F.array_except(F.array(*map(F.lit, OBLIQUES)), v)
    return lists.withColumns({
        "nearmap_views": F.nullif(F.array_join(v, ","), F.lit("")), "view_count": F.size(v), "any_oblique": F.exists(v, lambda x: x != "Vert"),
        "missing_views": F.array_join(missing, ","), "labels": F.array_join(F.concat(F.array(F.lit("NAIP top-down")), label), "; "),
    })


def zoom_candidates(sites: DataFrame, forced: str = "forced", config: Config = DEFAULT) -> DataFrame:
    """sites: a column ``candidates`` of struct(box, reason), in order. One row for each crop: crop (its number), box, label.

    Two anchors go first. The list is cut (to 3 if forced, else 6) before invalid and repeated boxes go, so numbers may have gaps.
    """
    anchors = F.array(*[F.struct(F.array(*map(F.lit, b)).cast("array<double>").alias("box"), F.lit("anchor").alias("reason")) for b in geo.ANCHORS])
    every = F.concat(anchors, F.coalesce(F.col("candidates"), F.array().cast("array<struct<box: array<double>, reason: string>>")))
    most = F.when(F.col(forced), config.forced_crops).otherwise(config.max_crops)
    listed = F.transform(F.slice(every, F.lit(1), most), lambda x, i: F.struct((i + 1).alias("crop"), geo.valid_box(x["box"], config.min_side).alias("box"), crop_label(x["reason"]).alias("crop_label")))
    # Of equal boxes the first stays: places are looked up in the list of boxes, so nothing is shuffled.
    rows = sites.withColumn("_listed", listed).withColumn("_boxes", F.transform("_listed", lambda x: x["box"]))
    kept = F.filter("_listed", lambda x: x["box"].isNotNull() & (F.array_position(F.col("_boxes"), x["box"]) == x["crop"]))
    return rows.select(*[c for c in sites.columns if c != "candidates"], F.inline(kept))
