"""Intake: validation, resume, geocoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.functions.geo import haversine
from siteloom.functions.scalars import clean, has_coordinates


def require_columns(sites: DataFrame) -> None:
    names = set(sites.columns)
    if "id" not in names:
        raise ValueError("the input has no column id")
    if not ({"lat", "lon"} <= names or "address" in names):
        raise ValueError("the input has neither lat and lon nor address")


def invalid(sites: DataFrame) -> DataFrame:
    """Rows with neither coordinates nor an address."""
    return sites.where(~has_coordinates(F.col("lat"), F.col("lon")) & clean(F.col("address")).isNull())


def validate(sites: DataFrame) -> DataFrame:
    """``sites``, or an error that names five of the invalid rows."""
    require_columns(sites)
    bad = [r[0] for r in invalid(sites).select("id").take(6)]
    if bad:
        raise ValueError(f"rows without coordinates and address: {bad[:5]}{' and more' if len(bad) > 5 else ''}")
    return sites


def done(results: DataFrame) -> DataFrame:
    """Results that a resumed run keeps."""
    return results.where(F.col("site_type").isNotNull() & clean(F.col("error")).isNull())


def pending(sites: DataFrame, results: DataFrame) -> DataFrame:
    return sites.join(done(results).select("id"), "id", "left_anti")


def resume_union(results: DataFrame, fresh: DataFrame) -> DataFrame:
    return done(results).unionByName(fresh, allowMissingColumns=True)


def resolve(sites: DataFrame, geocodes: DataFrame, sources: tuple[str, ...] = ("census", "nominatim")) -> DataFrame:
    """Coordinates given win; else the first source that has the address; else an error that joins the sources' reasons.

    geocodes (address, source, lat, lon, matched_address, quality, error): one lookup a row; of repeated ones any success counts.
    """
    asked = clean(F.col("address"))
    given = has_coordinates(F.col("lat"), F.col("lon"))
    tried = geocodes.where(F.col("source").isin(*sources)).select(
        F.trim("address").alias("_address"), "source",
        F.when(has_coordinates(F.col("lat"), F.col("lon")), F.struct("source", "lat", "lon", "matched_address", "quality")).alias("hit"), "error",
    )
    aggs: list[Column] = []
    for s in sources:
        aggs += [F.min(F.when(F.col("source") == s, F.col("hit"))).alias(f"_{s}"), F.min(F.when(F.col("source") == s, F.col("error"))).alias(f"_{s}_error")]
    log = tried.groupBy("_address").agg(*aggs)
    joined = sites.withColumn("_asked", F.when(~given, asked)).join(log, F.col("_asked") == F.col("_address"), "left")
    hit = F.coalesce(*[F.col(f"_{s}") for s in sources])
    reasons = F.array_join(F.filter(F.array(*[F.concat(F.lit(f"{s}: "), F.coalesce(f"_{s}_error", F.lit("no match"))) for s in sources]), lambda x: x.isNotNull()), "; ")
    return joined.select(
        *[c for c in sites.columns if c not in ("lat", "lon")],
        F.when(given, F.col("lat")).otherwise(hit.lat).alias("lat"), F.when(given, F.col("lon")).otherwise(hit.lon).alias("lon"),
        F.when(~given, hit.source).alias("geocode_source"), F.when(~given, hit.matched_address).alias("geocode_matched_address"),
        F.when(~given, hit.quality).alias("geocode_quality"), F.when(~given & hit.isNotNull(), asked).alias("input_address"),
        F.when(~given & hit.isNull(), F.when(asked.isNull(), "no coordinates and no address").otherwise(reasons)).alias("error"),
    )


def nominatim_quality(kind: Column, category: Column) -> Column:
    """Of a hit: its type, or its class where that is blank."""
    return F.coalesce(F.nullif(kind, F.lit("")), category)


def _near(left: DataFrame, right: DataFrame, metres: float, steps: list[tuple[int, int]], where: str) -> DataFrame:
    """left (lat1, lon1, ...) with right (lat2, lon2, ...) within a distance, of those that ``where`` lets through; m is the distance.

    A join on grid cells of that size: rows of latitude, and columns as wide as the distance at the row's highest latitude. steps are the
    rows and columns from a left point's cell to those looked at; ``_own`` tells its own. Both sides are shuffled and merged whatever
    their size: a broadcast would leave the work to the few tasks that read the points.
    """
    c, dlat, keys, parts = F.col, metres / 111_000.0, ["_row", "_col"], int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = lambda row: F.lit(dlat) / F.cos(F.radians(F.least(F.lit(89.0), (F.abs(row) + 2) * dlat)))
    left = left.withColumn("_step", F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in steps]))).withColumn("_row", F.floor(c("lat1") / dlat) + c("_step.y"))
    left = left.withColumns({"_col": F.floor(c("lon1") / wide(c("_row"))) + c("_step.x"), "_own": (c("_step.y") == 0) & (c("_step.x") == 0)}).drop("_step")
    right = right.withColumn("_row", F.floor(c("lat2") / dlat)).withColumn("_col", F.floor(c("lon2") / wide(c("_row"))))
    both = left.repartition(parts, *keys).join(right.repartition(parts, *keys).hint("merge"), keys).where(where)
    return both.withColumn("m", haversine(c("lat1"), c("lon1"), c("lat2"), c("lon2"))).where(c("m") <= metres)


def near_pairs(points: DataFrame, metres: float, key: str = "id", most: int = 1024) -> DataFrame:
    """Extension: pairs (a, b, metres) of points within a distance; points without coordinates have no pairs.

    Distances are taken once for each two places, and lists of at most ``most`` keys a place are then multiplied out.
    """
    c = F.col
    nth = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("_k"))
    places = points.select(c(key).alias("_k"), "lat", "lon").where("lat IS NOT NULL AND lon IS NOT NULL AND _k IS NOT NULL").withColumn("_n", F.floor((nth - 1) / most)).groupBy("lat", "lon", "_n").agg(F.collect_list("_k").alias("_ks"))
    left, right = (places.selectExpr(f"lat AS lat{i}", f"lon AS lon{i}", f"_n AS n{i}", f"_ks AS ks{i}") for i in (1, 2))
    # Two places meet once: rows and columns only go up, and within a cell the smaller place goes first.
    pairs = _near(left, right, metres, [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)], "NOT _own OR lat1 < lat2 OR lat1 = lat2 AND (lon1 < lon2 OR lon1 = lon2 AND n1 <= n2)")
    pairs = pairs.select("ks1", "ks2", (c("_own") & (c("lat1") == c("lat2")) & (c("lon1") == c("lon2")) & (c("n1") == c("n2"))).alias("same"), F.round("m", 1).alias("metres"))
    pairs = pairs.withColumn("x", F.explode("ks1")).withColumn("y", F.explode("ks2")).where("CASE WHEN same THEN x < y ELSE x <> y END")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "metres")


def radius_dedup(points: DataFrame, metres: float, key: str = "id") -> DataFrame:
    """Extension: ``points`` without those that have one of a smaller key within the distance; those without coordinates stay.

    Pairs are not listed. First each point meets the smallest key of its cell, whose width is 0.6 of the distance, so hardly more than one a cell
    is left; those look for the smallest key at each place around them. A point meets a bounded number of others, so work is as the input.
    """
    c, side = F.col, metres / 111_000.0 * 0.6
    # Columns are cut at the row's lower latitude, where they are widest.
    low = F.when(c("_cy") >= 0, c("_cy")).otherwise(-c("_cy") - 1) * side
    cells = points.withColumn("_cy", F.floor(c("lat") / side)).withColumn("_cx", F.floor(c("lon") * F.cos(F.radians(F.least(F.lit(89.0), low))) / side))
    known = f"lat IS NOT NULL AND lon IS NOT NULL AND `{key}` IS NOT NULL"
    first = cells.where(known).groupBy("_cy", "_cx").agg(F.min(F.struct(c(key).alias("k"), c("lat").alias("lat"), c("lon").alias("lon"))).alias("_first"))
    gone = (c("_first.k") < c(key)) & (haversine(c("_first.lat"), c("_first.lon"), c("lat"), c("lon")) <= metres)
    left = cells.join(first, ["_cy", "_cx"], "left").where(~F.coalesce(gone, F.lit(False))).select(*points.columns)
    asking = left.where(known).select(c(key).alias("a"), c("lat").alias("lat1"), c("lon").alias("lon1")).distinct()
    places = points.where(known).groupBy("lat", "lon").agg(F.min(key).alias("b")).select("b", c("lat").alias("lat2"), c("lon").alias("lon2"))
    hits = _near(asking, places, metres, [(y, x) for y in (-1, 0, 1) for x in (-1, 0, 1)], "b < a").select(c("a").alias(key), c("lat1").alias("lat"), c("lon1").alias("lon")).distinct()
    return left.join(hits, [key, "lat", "lon"], "left_anti")
