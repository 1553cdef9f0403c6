"""Deterministic views of the test tables in the engine's shapes, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS k", "concat('site_', c_custkey) AS id",
        "CASE WHEN c_custkey % 5 <> 0 THEN 25 + (c_custkey * 7919 % 24000) / 1000.0D END AS lat",
        "CASE WHEN c_custkey % 5 <> 0 THEN -124 + (c_custkey * 104729 % 57000) / 1000.0D END AS lon",
        "CASE WHEN c_custkey % 35 = 0 THEN '  ' ELSE c_name END AS address",
        "CASE WHEN c_custkey % 17 = 0 THEN 'stealth' ELSE c_mktsegment END AS label",
        "CASE c_custkey % 6 WHEN 0 THEN 'high' WHEN 1 THEN ' Medium ' WHEN 2 THEN 'LOW' WHEN 3 THEN 'unknown' WHEN 4 THEN '' END AS input_confidence",
    )


SITES = """sites AS (SELECT c_custkey AS k, 'site_' || c_custkey AS id,
  CASE WHEN c_custkey % 5 <> 0 THEN 25 + (c_custkey * 7919 % 24000) / 1000.0::DOUBLE END AS lat,
  CASE WHEN c_custkey % 5 <> 0 THEN -124 + (c_custkey * 104729 % 57000) / 1000.0::DOUBLE END AS lon,
  CASE WHEN c_custkey % 35 = 0 THEN '  ' ELSE c_name END AS address,
  CASE WHEN c_custkey % 17 = 0 THEN 'stealth' ELSE c_mktsegment END AS label,
  CASE c_custkey % 6 WHEN 0 THEN 'high' WHEN 1 THEN ' Medium ' WHEN 2 THEN 'LOW' WHEN 3 THEN 'unknown' WHEN 4 THEN '' END AS input_confidence
  FROM customer)"""

_CONF = "CASE l_linenumber % 3 WHEN 0 THEN l_discount * 10 WHEN 1 THEN l_quantity WHEN 2 THEN l_extendedprice END"
_BASE = """l_orderkey AS site, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_extendedprice AS price, l_quantity AS q,
  CASE CAST(l_quantity AS BIGINT) % 4 WHEN 0 THEN 'tower' WHEN 1 THEN 'rooftop' WHEN 2 THEN 'other' ELSE 'unclear' END AS reply_type,
  CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS cell_equipment,
  CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN l_partkey % 901 + CAST(l_quantity AS BIGINT) * 4 ELSE l_partkey % 901 END AS y0, l_suppkey * 9 AS x0,
  CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN l_partkey % 901 ELSE l_partkey % 901 + CAST(l_quantity AS BIGINT) * 4 END AS y1,
  l_suppkey * 9 + l_linenumber * 40 AS x1"""
_MORE = """CASE WHEN s % 50 = 7 THEN 'no_imagery' WHEN p % 31 = 0 THEN NULL ELSE reply_type END AS site_type,
  CASE WHEN p % 23 = 0 THEN {error} WHEN p % 29 = 0 THEN '  ' END AS error,
  CASE WHEN p % 3 = 0 THEN 'seen on ' || reply_type || ' ' || repeat('x', CAST(p % 97 AS INT)) END AS site_evidence,
  CASE WHEN n % 2 = 0 THEN 30.5 + n END AS asset_lat, CASE n WHEN 2 THEN NULL WHEN 4 THEN CAST(p % 1777 AS DOUBLE) / 10 END AS asset_offset_m,
  CASE n WHEN 1 THEN 'NAIP top-down' WHEN 3 THEN 'Nearmap oblique (North)' WHEN 5 THEN '' END AS asset_view,
  CASE WHEN p % 19 = 0 THEN 250.0 ELSE 100.0 END AS nearmap_aoi_m,
  CASE p % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'wide_aoi' WHEN 2 THEN 'zoom' END AS classification_stage,
  CAST(CAST(q AS BIGINT) % 6 AS INT) AS view_count"""
_ERROR = "'request failed after the last retry: ' || repeat('service unavailable ', CAST(p % 8 AS INT))"


def replies(spark: SparkSession, d: str) -> DataFrame:
    """One reply a line item; also shaped as a result row."""
    base = table(spark, d, "lineitem").selectExpr(*_split(_BASE), f"CAST({_CONF} AS DOUBLE) AS conf")
    return base.selectExpr("*", *_split(_MORE.format(error=_ERROR)), "concat('site_', site) AS id")


REPLIES = f"""base AS (SELECT {_BASE}, CAST({_CONF} AS DOUBLE) AS conf FROM lineitem),
replies AS (SELECT *, {_MORE.format(error=_ERROR)}, 'site_' || site AS id FROM base)"""
#: Columns that tell replies apart.
KEY = ["site", "n", "p", "s", "price"]


def _split(text: str) -> list[str]:
    out, depth, quoted = [""], 0, False
    for c in text:
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def view_rows(spark: SparkSession, d: str) -> DataFrame:
    """id (of a group of events) and view."""
    return table(spark, d, "events").select(
        F.concat(F.lit("g"), F.col("user_id") * 100 + F.col("event_id") % 20).alias("id"),
        F.element_at(F.array(*map(F.lit, ("Vert", "North", "East", "South", "West"))), (F.floor(F.col("event_id") / 20) % 5 + 1).cast("int")).alias("view"), "event_id",
    )


VIEWS = """shown AS (SELECT 'g' || (user_id * 100 + event_id % 20) AS id, list_extract(['Vert','North','East','South','West'], (event_id // 20 % 5 + 1)::INT) AS view, event_id FROM events),
lists AS (SELECT id, list_transform(list_sort(list_distinct(list(list_position(['Vert','North','East','South','West'], view)))), lambda i: list_extract(['Vert','North','East','South','West'], i)) AS views FROM shown GROUP BY id)"""


def scenes(spark: SparkSession, d: str) -> DataFrame:
    """Footprints of three degrees from the suppliers."""
    return table(spark, d, "supplier").selectExpr(
        "s_suppkey AS item_ord", "concat('scene_', s_suppkey) AS item_id", "26 + (s_suppkey * 37 % 20) AS lat_min", "29 + (s_suppkey * 37 % 20) AS lat_max",
        "-123 + (s_suppkey * 91 % 53) AS lon_min", "-120 + (s_suppkey * 91 % 53) AS lon_max",
    )


SCENES = """scenes AS (SELECT s_suppkey AS item_ord, 'scene_' || s_suppkey AS item_id, 26 + (s_suppkey * 37 % 20) AS lat_min, 29 + (s_suppkey * 37 % 20) AS lat_max,
  -123 + (s_suppkey * 91 % 53) AS lon_min, -120 + (s_suppkey * 91 % 53) AS lon_max FROM supplier)"""


def geocodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").selectExpr("s_suppkey AS s", "inline(array(struct('census' AS source, 3L AS f), struct('nominatim' AS source, 5L AS f)))").selectExpr(
        "concat('Customer#', lpad(cast(s * f AS string), 9, '0')) AS address", "source",
        "CASE WHEN s % 7 <> 0 THEN 30 + s / 100.0D END AS lat", "CASE WHEN s % 7 <> 0 THEN -100 + f / 10.0D END AS lon",
        "CASE WHEN s % 7 <> 0 THEN concat('matched ', s) END AS matched_address", "CASE WHEN s % 7 <> 0 THEN source END AS quality", "CASE WHEN s % 7 = 0 THEN 'no match' WHEN s % 14 = 0 THEN 'timeout' END AS error",
    )


GEOCODES = """geocodes AS (SELECT 'Customer#' || lpad((s_suppkey * f)::VARCHAR, 9, '0') AS address, source, CASE WHEN s_suppkey % 7 <> 0 THEN 30 + s_suppkey / 100.0::DOUBLE END AS lat,
  CASE WHEN s_suppkey % 7 <> 0 THEN -100 + f / 10.0::DOUBLE END AS lon, 'matched ' || s_suppkey AS matched, source AS quality
  FROM supplier, (VALUES ('census', 3), ('nominatim', 5)) v(source, f))"""
