"""Queries over the test tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siteloom.config import STAGES
from siteloom.functions import geo, scalars
from siteloom.functions.replies import block_text as block_of
from siteloom.functions.replies import json_part, parse, unreadable
from siteloom.operators import cascade, imagery, intake, reports
from siteloom.plans import views as v
from siteloom.plans.views import GEOCODES, KEY, REPLIES, SCENES, SITES, VIEWS

_QUERIES: dict = {}
_SQL: dict[str, str] = {}
_K = ", ".join(KEY)
c = F.col


def query(sql: str):
    def add(f):
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _conf(x: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL AND NOT isnan({x}) THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN {x} > 100 THEN 1.0::DOUBLE WHEN {x} > 10 THEN {x} / 100 WHEN {x} > 1 THEN {x} / 10 ELSE {x} END)) END)"


def _band(x: str) -> str:
    return f"(CASE WHEN {_conf(x)} >= 0.75 THEN 'high' WHEN {_conf(x)} >= 0.6 THEN 'medium' ELSE 'low' END)"


def _trust(x: str) -> str:
    return f"(CASE WHEN lower(trim({x})) IN ('high', 'medium', 'low') THEN lower(trim({x})) ELSE 'medium' END)"


def _stop(t: str, x: str, e: str) -> str:
    return f"coalesce({t} IN ('tower', 'rooftop') AND {_band(x)} <> 'low' AND {e} IS NOT NULL, false)"


def _reason(t: str, x: str) -> str:
    return f"(CASE WHEN {t} = 'other' THEN 'other_type' WHEN {t} = 'unclear' THEN 'unclear_type' WHEN {_band(x)} = 'low' THEN 'low_confidence' END)"


_FAILED = "(error IS NOT NULL AND trim(error) <> '')"
_OK = f"(coalesce(site_type <> 'no_imagery', false) AND NOT {_FAILED})"
_LOCATED = "(asset_lat IS NOT NULL OR coalesce(asset_view, '') <> '')"
_KPIS = f"""count(*) AS total, count(*) FILTER ({_FAILED}) AS errors, count(*) FILTER ({_OK}) AS classified,
  count(*) FILTER ({_OK} AND site_type = 'tower') AS towers, count(*) FILTER ({_OK} AND site_type = 'rooftop') AS rooftops,
  count(*) FILTER ({_OK} AND cell_equipment) AS cell_hits, count(*) FILTER ({_OK} AND {_LOCATED}) AS located"""


def _results(spark, d):
    return v.replies(spark, d).withColumn("site_confidence", c("conf"))


@query(f"WITH {REPLIES} SELECT {_KPIS} FROM replies")
def regen_kpis(spark, d):
    return reports.kpis(reports.regenerate(_results(spark, d)))


@query(f"WITH {REPLIES} SELECT classification_stage, {_KPIS} FROM replies GROUP BY 1")
def kpis_by_stage(spark, d):
    return reports.kpis(_results(spark, d), ["classification_stage"])


@query(f"""WITH {REPLIES} SELECT count(*) - count(*) FILTER ({_FAILED}) AS ok, count(*) FILTER ({_FAILED}) AS errors, count(*) FILTER (site_type = 'tower') AS towers,
  count(*) FILTER (site_type = 'rooftop') AS rooftops, count(*) FILTER (cell_equipment) AS cell_hits FROM replies""")
def terminal_rollup(spark, d):
    return reports.terminal_rollup(_results(spark, d))


@query(f"WITH {REPLIES} SELECT count(*) FILTER (conf IS DISTINCT FROM {_conf('conf')}) AS fixed FROM replies")
def fixed_count(spark, d):
    return reports.regenerate(_results(spark, d)).agg(F.count_if("changed").alias("fixed"))


@query(f"WITH {REPLIES} SELECT {_K}, {_conf('conf')} AS confidence FROM replies")
def confidence_normalize(spark, d):
    return v.replies(spark, d).select(*KEY, scalars.confidence(c("conf")).alias("confidence"))


@query(f"WITH {REPLIES} SELECT {_K}, {_band('conf')} AS band FROM replies")
def confidence_band(spark, d):
    return v.replies(spark, d).select(*KEY, scalars.band(c("conf")).alias("band"))


@query(f"WITH {REPLIES} SELECT {_K}, {_stop('reply_type', 'conf', 'cell_equipment')} AS stop FROM replies")
def tier_stop(spark, d):
    return v.replies(spark, d).select(*KEY, scalars.confident_stop(c("reply_type"), c("conf"), c("cell_equipment")).alias("stop"))


@query(f"WITH {REPLIES} SELECT {_K}, {_reason('reply_type', 'conf')} AS reason FROM replies")
def escalation_reason(spark, d):
    return v.replies(spark, d).select(*KEY, scalars.escalation_reason(c("reply_type"), c("conf")).alias("reason"))


@query(f"WITH {SITES} SELECT id, {_trust('input_confidence')} AS trust FROM sites")
def trust_normalize(spark, d):
    return v.sites(spark, d).select("id", scalars.trust(c("input_confidence")).alias("trust"))


@query(f"WITH {SITES}, {REPLIES} SELECT {_K}, ({_trust('input_confidence')} = 'high' AND cell_equipment IS NOT DISTINCT FROM false) AS mismatch FROM replies r JOIN sites x ON x.k = r.site")
def trust_mismatch(spark, d):
    joined = v.replies(spark, d).drop("id").join(v.sites(spark, d), c("site") == c("k"))
    return joined.select(*KEY, scalars.trust_mismatch(c("input_confidence"), c("cell_equipment")).alias("mismatch"))


@query(f"WITH {SITES} SELECT id FROM sites WHERE (lat IS NULL OR lon IS NULL) AND trim(address) = ''")
def validate_inputs(spark, d):
    return intake.invalid(v.sites(spark, d)).select("id")


_PRIOR = "prior AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN 'tower' END AS site_type, CASE WHEN o_orderstatus = 'O' THEN 'failed' END AS error FROM orders)"


def _prior(spark, d):
    return v.table(spark, d, "orders").selectExpr("o_orderkey AS id", "CASE WHEN o_orderstatus <> 'P' THEN 'tower' END AS site_type", "CASE WHEN o_orderstatus = 'O' THEN 'failed' END AS error")


@query(f"WITH {_PRIOR} SELECT l_orderkey AS id, l_linenumber AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT id FROM prior WHERE site_type IS NOT NULL AND error IS NULL)")
def resume_pending(spark, d):
    return intake.pending(v.table(spark, d, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS n"), _prior(spark, d))


@query(f"WITH {_PRIOR}, kept AS (SELECT * FROM prior WHERE site_type IS NOT NULL AND error IS NULL) SELECT id, site_type, error, NULL::INTEGER AS n FROM kept UNION ALL SELECT l_orderkey, 'other', NULL, l_linenumber::INTEGER FROM lineitem WHERE l_orderkey NOT IN (SELECT id FROM kept)")
def resume_union(spark, d):
    fresh = resume_pending(spark, d).selectExpr("id", "'other' AS site_type", "CAST(n AS INT) AS n")
    return intake.resume_union(_prior(spark, d), fresh)


@query(f"""WITH {SITES}, {GEOCODES}, tried AS (SELECT x.*, (x.lat IS NOT NULL AND x.lon IS NOT NULL) AS given, nullif(trim(x.address), '') AS asked FROM sites x),
j AS (SELECT t.*, a.lat AS alat, a.lon AS alon, a.matched AS am, b.lat AS blat, b.lon AS blon, b.matched AS bm,
    coalesce(CASE WHEN a.address IS NOT NULL AND a.lat IS NULL THEN 'no match' END, 'no match') AS ae, coalesce(CASE WHEN b.address IS NOT NULL AND b.lat IS NULL THEN 'no match' END, 'no match') AS be
  FROM tried t LEFT JOIN geocodes a ON a.address = t.asked AND a.source = 'census' AND NOT t.given LEFT JOIN geocodes b ON b.address = t.asked AND b.source = 'nominatim' AND NOT t.given)
SELECT id, CASE WHEN given THEN lat ELSE coalesce(alat, blat) END AS lat, CASE WHEN given THEN lon WHEN alat IS NOT NULL THEN alon ELSE blon END AS lon,
  CASE WHEN given THEN NULL WHEN alat IS NOT NULL THEN 'census' WHEN blat IS NOT NULL THEN 'nominatim' END AS geocode_source,
  CASE WHEN given THEN NULL WHEN alat IS NOT NULL THEN am WHEN blat IS NOT NULL THEN bm END AS geocode_matched_address,
  CASE WHEN given OR coalesce(alat, blat) IS NOT NULL THEN NULL WHEN asked IS NULL THEN 'no coordinates and no address' ELSE 'census: ' || ae || '; nominatim: ' || be END AS error FROM j""")
def geocode_fallback(spark, d):
    return intake.resolve(v.sites(spark, d), v.geocodes(spark, d)).select("id", "lat", "lon", "geocode_source", "geocode_matched_address", "error")


@query("SELECT user_id AS id, event_id AS item_ord FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id) AS r FROM events) WHERE r = 1")
def newest_scene(spark, d):
    rows = v.table(spark, d, "events").select(c("user_id").alias("id"), F.date_trunc("day", "ts").alias("dt"), c("event_id").alias("item_ord"))
    return imagery.newest_scene(rows).select("id", "item_ord")


@query(f"WITH {SITES}, {SCENES} SELECT id, item_id FROM sites JOIN scenes ON lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max")
def scene_point_intersect(spark, d):
    return imagery.scenes_at(v.sites(spark, d).select("id", "lat", "lon"), v.scenes(spark, d).drop("item_ord"), 3.0).select("id", "item_id")


def _tiles(side: float, z: int) -> str:
    n, dlat, dlon = 2**z, f"{side / 2 / 111320.0!r}::DOUBLE", f"({side / 2}::DOUBLE / (111320.0::DOUBLE * cos(radians(lat))))"
    x = lambda lon: f"trunc(({lon} + 180) / 360 * {float(n)}::DOUBLE)::INT"
    y = lambda lat: f"trunc((1 - asinh(tan(radians({lat}))) / pi()) / 2 * {float(n)}::DOUBLE)::INT"
    return f"{x(f'(lon - {dlon})')} AS x0, {x(f'(lon + {dlon})')} AS x1, {y(f'(lat + {dlat})')} AS y0, {y(f'(lat - {dlat})')} AS y1"


@query(f"WITH {SITES} SELECT id, {_tiles(100.0, 21)} FROM sites WHERE lat IS NOT NULL")
def tile_range(spark, d):
    return imagery.tile_ranges(v.sites(spark, d)).select("id", "x0", "x1", "y0", "y1")


_PLAN = f"""{SITES}, r AS (SELECT id, 'Vert' AS view, 21 AS z, {_tiles(100.0, 21)} FROM sites WHERE lat IS NOT NULL
  UNION ALL SELECT id, unnest(['North','East','South','West']), 20, {_tiles(100.0, 20)} FROM sites WHERE lat IS NOT NULL),
a AS (SELECT *, unnest(range(x0, x1 + 1))::INT AS x FROM r), t AS (SELECT *, unnest(range(y0, y1 + 1))::INT AS y FROM a)"""


@query(f"WITH {_PLAN} SELECT id, view, z, x, y FROM t")
def tile_plan(spark, d):
    return imagery.tile_plan(v.sites(spark, d)).select("id", "view", "z", "x", "y")


@query(f"""WITH {_PLAN} SELECT id, view, x, y, 256 * CASE view WHEN 'South' THEN x1 - x WHEN 'East' THEN y - y0 WHEN 'West' THEN y1 - y ELSE x - x0 END AS "left",
  256 * CASE view WHEN 'South' THEN y1 - y WHEN 'East' THEN x1 - x WHEN 'West' THEN x - x0 ELSE y - y0 END AS top FROM t""")
def tile_placement(spark, d):
    return imagery.tile_plan(v.sites(spark, d)).select("id", "view", "x", "y", "left", "top")


def _boxed(spark, d):
    return v.replies(spark, d).withColumn("box", F.array(*[c(x).cast("double") for x in ("y0", "x0", "y1", "x1")]))


@query(f"""WITH {REPLIES} SELECT {_K}, CASE WHEN y0 >= 0 AND y0 <= y1 AND y1 <= 1000 AND x0 >= 0 AND x0 <= x1 AND x1 <= 1000
  THEN round_even(250 * sqrt(pow((x0 + x1) / 2000.0::DOUBLE - 0.5, 2) + pow((y0 + y1) / 2000.0::DOUBLE - 0.5, 2)), 1) END AS offset_m FROM replies""")
def box_center_offset(spark, d):
    return _boxed(spark, d).select(*KEY, F.bround(geo.box_offset(c("box")), 1).alias("offset_m"))


@query(f"WITH {SITES} SELECT id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM sites WHERE lat IS NOT NULL")
def utm_roundtrip(spark, d):
    rows = v.sites(spark, d).where("lat IS NOT NULL").withColumn("zone", geo.utm_zone(c("lon")))
    east, north = geo.utm_forward(c("lat"), c("lon"), c("zone"))
    rows = rows.withColumns({"e": east, "n": north})
    lat, lon = geo.utm_inverse(c("e"), c("n"), c("zone"))
    return rows.select("id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


_VALID = "(y0 >= 0 AND y1 <= 1000 AND x0 >= 0 AND x1 <= 1000 AND y1 - y0 >= 100 AND x1 - x0 >= 100)"


@query(f"WITH {REPLIES} SELECT {_K}, {_VALID} AS valid FROM replies")
def valid_box(spark, d):
    return _boxed(spark, d).select(*KEY, geo.valid_box(c("box")).isNotNull().alias("valid"))


def _pixels(x: str, size: int) -> str:
    return f"trunc(greatest(0, least(1000, {x})) / 1000.0::DOUBLE * {size})::INT"


@query(f"""WITH {REPLIES}, p AS (SELECT *, trunc((y1 - y0) * 0.15::DOUBLE)::INT AS py, trunc((x1 - x0) * 0.15::DOUBLE)::INT AS px FROM replies WHERE {_VALID}),
q4 AS (SELECT *, {_pixels('x0 - px', 1600)} AS "left", {_pixels('y0 - py', 1200)} AS top FROM p)
SELECT {_K}, "left", top, greatest("left" + 1, {_pixels('x1 + px', 1600)}) AS "right", greatest(top + 1, {_pixels('y1 + py', 1200)}) AS bottom FROM q4""")
def crop_rect(spark, d):
    rows = _boxed(spark, d).withColumn("valid", geo.valid_box(c("box"))).where("valid IS NOT NULL")
    return rows.select(*KEY, *[x.alias(n) for n, x in geo.crop_rect(c("valid"), F.lit(1600), F.lit(1200)).items()])


@query("SELECT 333 * r AS y0, 333 * k AS x0, CASE r WHEN 2 THEN 1000 ELSE 333 * (r + 1) END AS y1, CASE k WHEN 2 THEN 1000 ELSE 333 * (k + 1) END AS x1 FROM (SELECT unnest([0, 1, 2])::BIGINT AS r) a, (SELECT unnest([0, 1, 2])::BIGINT AS k) b")
def grid_boxes(spark, d):
    return spark.createDataFrame([tuple(b) for b in geo.grid_boxes()], "y0 long, x0 long, y1 long, x1 long")


@query(f"""WITH {REPLIES}, listed AS (SELECT site, y0, x0, y1, x1, reply_type AS reason, row_number() OVER (PARTITION BY site ORDER BY n, p, s, price) + 2 AS crop FROM replies
  UNION ALL SELECT DISTINCT site, 350, 350, 650, 650, 'anchor', 1 FROM replies UNION ALL SELECT DISTINCT site, 480, 380, 680, 620, 'anchor', 2 FROM replies),
good AS (SELECT *, row_number() OVER (PARTITION BY site, y0, x0, y1, x1 ORDER BY crop) AS r FROM listed WHERE crop <= CASE WHEN site % 17 = 0 THEN 3 ELSE 6 END AND {_VALID})
SELECT site AS id, crop::INT AS crop, reason AS crop_label, y0::INT AS y0, x0::INT AS x0 FROM good WHERE r = 1""")
def zoom_candidates(spark, d):
    lists = _boxed(spark, d).groupBy(c("site").alias("id")).agg(F.array_sort(F.collect_list(F.struct("n", "p", "s", "price", "box", c("reply_type").alias("reason")))).alias("l"))
    asked = lists.select("id", F.transform("l", lambda x: F.struct(x.box.alias("box"), x.reason.alias("reason"))).alias("candidates"), (c("id") % 17 == 0).alias("forced"))
    return imagery.zoom_candidates(asked).select("id", "crop", "crop_label", F.get("box", F.lit(0)).alias("y0"), F.get("box", F.lit(1)).alias("x0"))


@query(f"""WITH {VIEWS} SELECT id, array_to_string(views, ',') AS nearmap_views, len(views)::INT AS view_count, len(list_filter(views, lambda x: x <> 'Vert')) > 0 AS any_oblique,
  array_to_string(list_filter(['North','East','South','West'], lambda x: NOT list_contains(views, x)), ',') AS missing_views,
  array_to_string(list_concat(['NAIP top-down'], list_transform(views, lambda x: CASE WHEN x = 'Vert' THEN 'Nearmap top-down' ELSE 'Nearmap oblique (' || x || ')' END)), '; ') AS labels FROM lists""")
def view_assembly(spark, d):
    return imagery.view_summary(imagery.assemble_views(v.view_rows(spark, d))).drop("views")


_TEXT = "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN 'Sure: ' || props || ' done' WHEN 2 THEN substr(props, 1, length(props) - 1) ELSE 'no object, event ' || event_id END"


@query(f"""WITH t AS (SELECT event_id, {_TEXT} AS text FROM events), j AS (SELECT *, CASE WHEN regexp_matches(text, '\\{{.*\\}}', 's') THEN regexp_extract(text, '\\{{.*\\}}', 0, 's') ELSE text END AS j FROM t)
SELECT event_id, CASE WHEN json_valid(j) THEN json_extract_string(j, '$.k') END AS k, CASE WHEN NOT json_valid(j) THEN 'unparseable model reply: ' || substr(text, 1, 200) END AS evidence FROM j""")
def json_fallback(spark, d):
    rows = v.table(spark, d, "events").select("event_id", F.expr(_TEXT).alias("text"))
    got = parse(c("text"), "k string")
    return rows.select("event_id", got.k.alias("k"), F.when(got.isNull() & json_part(c("text")).isNotNull(), unreadable(c("text"))).alias("evidence"))


_LABEL = "CASE WHEN site % 17 = 0 THEN 'stealth' ELSE 'plain' END"
_INPUT = "CASE site % 6 WHEN 0 THEN 'high' WHEN 1 THEN ' Medium ' WHEN 2 THEN 'LOW' WHEN 3 THEN 'unknown' END"
_MANY = "CASE site % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 5 END"
_WIDE = "CASE site % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END"
_CROPS = "CASE WHEN site % 13 = 0 THEN 0 ELSE site % 6 + 1 END"
_NTH = {s: i for i, s in enumerate(STAGES)}
# A site's first reply is that of NAIP, the others are spread over all stages; of several in one stage the last counts.
_REPLY = f"""site AS id, rn AS attempt, CASE WHEN rn = 1 THEN 0 ELSE (p + s + n) % {len(STAGES)} END AS nth, reply_type AS site_type, conf, cell_equipment AS cell, p % 10 / 10.0{{double}} AS cell_conf,
  CASE WHEN p % 4 = 0 THEN {{cell}} END AS cell_evidence, site_evidence AS evidence, CASE WHEN p % 7 > 0 THEN {{box}} END AS box, CASE s % 3 WHEN 0 THEN 'NAIP top-down' WHEN 1 THEN 'Nearmap top-down' END AS view"""
_FIELDS = ", ".join(f"{x} := {y}" for x, y in zip(("t", "c", "e", "cc", "ce", "ev", "b", "w", "m"), ("site_type", "conf", "cell", "cell_conf", "cell_evidence", "evidence", "box", "view", "'m' || nth")))
_STAGED = f"""{REPLIES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n, p, s, price) AS rn FROM replies),
logged AS (SELECT {_REPLY.format(double='::DOUBLE', cell="'cell ' || p", box='[y0, x0, y1, x1]')} FROM ranked),
st AS (SELECT id, id AS site, {", ".join(f"max_by(struct_pack({_FIELDS}), attempt) FILTER (nth = {i}) AS r{i}" for i in range(len(STAGES)))} FROM logged GROUP BY id),
sites_st AS (SELECT *, {_LABEL} AS label, {_INPUT} AS input_confidence, {_MANY} AS nv, {_WIDE} AS wv, {_CROPS} AS crops, site % 11 <> 0 AS has_naip, (site % 11 <> 0)::INT AS n0 FROM st)"""


def _staged(spark, d):
    order = Window.partitionBy("site").orderBy("n", "p", "s", "price")
    box = "array(cast(y0 AS double), cast(x0 AS double), cast(y1 AS double), cast(x1 AS double))"
    rows = v.replies(spark, d).withColumn("rn", F.row_number().over(order)).selectExpr(*v._split(_REPLY.format(double="D", cell="concat('cell ', p)", box=box)))
    rows = rows.withColumns({"stage": F.element_at(F.array(*map(F.lit, STAGES)), (c("nth") + 1).cast("int")), "model": F.concat(F.lit("m"), c("nth"))})
    every = F.array(*map(F.lit, ("Vert", "North", "East", "South", "West")))
    wide = cascade.pivot_stages(rows, list(STAGES)).withColumn("site", c("id"))
    return wide.withColumns({
        "label": F.expr(_LABEL), "input_confidence": F.expr(_INPUT), "views": F.slice(every, F.lit(1), F.expr(_MANY)), "wide_views": F.slice(every, F.lit(1), F.expr(_WIDE)),
        "has_naip": F.expr("site % 11 <> 0"), "zoom_crops": F.expr(f"CAST({_CROPS} AS INT)"),
        "lat": F.expr("25 + (site * 7919 % 24000) / 1000.0D"), "lon": F.expr("-124 + (site * 104729 % 57000) / 1000.0D"),
    }).drop("site")


def _again(r: str, g: str, n: str) -> str:
    """r after the second look g, with n images."""
    seen = f"{_trust('input_confidence')} IN ('high', 'medium') AND {r}.e IS NOT DISTINCT FROM false AND {n} >= 2 AND coalesce({g}.e, false)"
    pick = lambda f: f"CASE WHEN {g}.t IN ('tower', 'rooftop') THEN coalesce({g}.{f}, {r}.{f}) ELSE {r}.{f} END"
    new = f"struct_pack(t := {pick('t')}, c := {pick('c')}, e := true, cc := coalesce({g}.cc, {r}.cc), ce := coalesce({g}.ce, {r}.ce), ev := {pick('ev')}, b := {r}.b, w := {r}.w, m := {r}.m)"
    return f"CASE WHEN {seen} THEN {new} ELSE {r} END"


@query(f"""WITH {_STAGED}, g AS (SELECT id, {_again('r4', 'r5', 'n0 + nv')} AS q FROM sites_st)
SELECT id, q.t AS site_type, q.c AS conf, q.e AS cell, q.cc AS cell_conf, q.ce AS cell_evidence FROM g""")
def recheck_merge(spark, d):
    r = cascade.rechecked("full", c("has_naip").cast("int") + F.size("views"))
    return _staged(spark, d).withColumn("r", r).select("id", "r.site_type", "r.conf", "r.cell", "r.cell_conf", "r.cell_evidence")


@query(f"""WITH {_STAGED}, g AS (SELECT *, {_reason('r0.t', 'r0.c')} AS escalation_reason FROM sites_st), u AS (SELECT *, escalation_reason IS NOT NULL AND r6 IS NOT NULL AS used FROM g)
SELECT id, escalation_reason, CASE WHEN used THEN 'secondary' ELSE 'primary' END AS provider, CASE WHEN used THEN r6.t ELSE r0.t END AS site_type FROM u""")
def routing(spark, d):
    r = cascade.route(c("naip"), c("escalate"))
    return _staged(spark, d).select("id", *[x.alias(n) for n, x in r.items()]).select("id", "escalation_reason", "provider", "reply.site_type")


def _tier(a: str, b: str, f: str) -> str:
    return f"CASE WHEN {_stop(f'{a}.t', f'{a}.c', f'{a}.e')} OR {b} IS NULL THEN 0 WHEN {_stop(f'{b}.t', f'{b}.c', f'{b}.e')} OR {f} IS NULL THEN 1 ELSE 2 END"


_TIERS = "CASE tier WHEN 0 THEN 'naip_only' WHEN 1 THEN 'vert_only' ELSE 'full' END"


@query(f"WITH {_STAGED}, g AS (SELECT *, {_tier('r0', 'r2', 'r4')} AS tier FROM st) SELECT id, {_TIERS} AS nearmap_tier, CASE tier WHEN 0 THEN r0.t WHEN 1 THEN r2.t ELSE r4.t END AS site_type FROM g")
def tier_cascade(spark, d):
    r = cascade.tier_cascade(c("naip"), c("vert"), c("full"))
    return _staged(spark, d).select("id", *[x.alias(n) for n, x in r.items()]).select("id", "nearmap_tier", "reply.site_type")


@query(f"WITH {_STAGED} SELECT id FROM sites_st WHERE r0.t IN ('other', 'unclear') AND nv <= 1")
def wide_aoi_gate(spark, d):
    return _staged(spark, d).where(cascade.wide_gate(c("naip.site_type"), c("views"))).select("id")


@query(f"WITH {_STAGED} SELECT id, (label = 'stealth' OR r0.t IN ('other', 'unclear')) AND (nv > 0 OR has_naip) AS gate, CASE WHEN nv > 0 THEN 'Nearmap top-down' WHEN has_naip THEN 'NAIP top-down' END AS source FROM sites_st")
def zoom_gate(spark, d):
    source = cascade.zoom_source(c("views"), c("has_naip"))
    return _staged(spark, d).select("id", cascade.zoom_gate(c("label"), c("naip.site_type"), source).alias("gate"), source.alias("source"))


@query(f"WITH {_STAGED} SELECT id, (r12 IS NOT NULL AND (r12.t IN ('tower', 'rooftop') OR coalesce({_conf('r12.c')}, 0) > coalesce({_conf('r0.c')}, 0) OR label = 'stealth')) AS wins FROM sites_st")
def zoom_wins(spark, d):
    return _staged(spark, d).select("id", F.coalesce(cascade.zoom_wins(c("naip"), c("zoom"), c("label")), F.lit(False)).alias("wins"))


_UNCLEAR = "struct_pack(t := 'unclear', c := 0.0::DOUBLE, e := NULL::BOOLEAN, cc := NULL::DOUBLE, ce := NULL::VARCHAR, ev := 'Zoom stage without valid crops.', b := NULL::BIGINT[], w := NULL::VARCHAR, m := NULL::VARCHAR)"


def _chain(tiers: str, none: str) -> str:
    """The rest of the cascade after ``tiers``, which gives q, tier and uv (the views shown)."""
    return f"""{_STAGED}, {tiers},
k2 AS (SELECT *, {_reason('q.t', 'q.c')} AS reason1, {_again('r6', 'r7', 'n0 + uv')} AS q6, {_again('r8', 'r9', 'n0 + wv')} AS q8, {_again('r10', 'r11', 'n0 + wv')} AS q10 FROM k1),
k3 AS (SELECT * REPLACE (CASE WHEN reason1 IS NOT NULL AND r6 IS NOT NULL THEN q6 ELSE q END AS q), reason1 IS NOT NULL AND r6 IS NOT NULL AS used1 FROM k2),
k4 AS (SELECT *, coalesce(q.t IN ('other', 'unclear'), false) AND uv <= 1 AND wv > 0 AND r8 IS NOT NULL AS wide FROM k3),
k5 AS (SELECT *, CASE WHEN wide AND NOT used1 THEN {_reason('q8.t', 'q8.c')} END AS reason2 FROM k4),
k6 AS (SELECT *, reason2 IS NOT NULL AND r10 IS NOT NULL AS used2 FROM k5),
k7 AS (SELECT * REPLACE (CASE WHEN used2 THEN q10 WHEN wide THEN q8 ELSE q END AS q, CASE WHEN wide THEN wv ELSE uv END AS uv), CASE WHEN crops = 0 THEN {_UNCLEAR} ELSE r12 END AS z FROM k6),
k8 AS (SELECT *, coalesce((label = 'stealth' OR q.t IN ('other', 'unclear')) AND (uv > 0 OR has_naip), false) AS gate, {none} AS nothing FROM k7),
k9 AS (SELECT *, gate AND z IS NOT NULL AND (coalesce(z.t IN ('tower', 'rooftop'), false) OR coalesce({_conf('z.c')}, 0) > coalesce({_conf('q.c')}, 0) OR label = 'stealth') AS zoom FROM k8),
k AS (SELECT * REPLACE (CASE WHEN zoom THEN z ELSE q END AS q), CASE WHEN zoom THEN 'zoom' WHEN wide THEN 'wide_aoi' ELSE 'primary' END AS stage,
  CASE WHEN zoom THEN 'zoom' WHEN wide THEN 'wide_aoi' ELSE {_TIERS} END AS shown_tier, coalesce(reason2, reason1) AS reason, used1 OR used2 AS second FROM k9)"""


_TIERED = f"""k0 AS (SELECT *, {_again('r0', 'r1', 'n0')} AS q0, CASE WHEN nv > 0 THEN {_again('r2', 'r3', 'n0 + 1')} END AS q2, {_again('r4', 'r5', 'n0 + nv')} AS q4 FROM sites_st),
t1 AS (SELECT *, {_tier('q0', 'q2', 'q4')} AS tier FROM k0), k1 AS (SELECT *, CASE tier WHEN 0 THEN q0 WHEN 1 THEN q2 ELSE q4 END AS q, CASE tier WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE nv END AS uv FROM t1)"""
_FULL = f"k1 AS (SELECT *, {_again('r4', 'r5', 'n0 + nv')} AS q, CASE WHEN nv > 0 THEN 2 ELSE 0 END AS tier, nv AS uv FROM sites_st)"
_ONLY = f"k1 AS (SELECT *, {_again('r0', 'r1', 'n0')} AS q, 0 AS tier, 0 AS uv FROM (SELECT * REPLACE (0 AS nv, 0 AS wv) FROM sites_st))"
_CASCADED = f"""id, CASE WHEN nothing THEN 'no_imagery' ELSE q.t END AS site_type, CASE WHEN NOT nothing THEN {_conf('q.c')} END AS site_confidence, CASE WHEN NOT nothing THEN q.e END AS cell_equipment,
  CASE WHEN NOT nothing THEN q.m END AS model, CASE WHEN NOT nothing THEN stage END AS classification_stage, CASE WHEN NOT nothing THEN shown_tier END AS nearmap_tier,
  CASE WHEN NOT nothing THEN reason END AS escalation_reason, CASE WHEN NOT nothing THEN CASE WHEN second THEN 'secondary' ELSE 'primary' END END AS provider"""


def _outcome(df):
    return df.select("id", "reply.site_type", scalars.confidence(c("reply.conf")).alias("site_confidence"), c("reply.cell").alias("cell_equipment"), "reply.model", "classification_stage", "nearmap_tier", "escalation_reason", "provider")


@query(f"WITH {_chain(_TIERED, 'NOT has_naip')} SELECT {_CASCADED} FROM k")
def full_cascade(spark, d):
    return _outcome(cascade.cascade(_staged(spark, d)))


@query(f"WITH {_chain(_FULL, 'NOT has_naip AND nv = 0')} SELECT {_CASCADED} FROM k")
def full_cascade_untiered(spark, d):
    return _outcome(cascade.cascade(_staged(spark, d), mode="full"))


@query(f"WITH {_chain(_ONLY, 'NOT has_naip')} SELECT {_CASCADED} FROM k")
def full_cascade_naip_only(spark, d):
    return _outcome(cascade.cascade(_staged(spark, d), mode="naip_only"))


_ON_MAP = "(NOT nothing AND len(q.b) > 0 AND q.w = 'NAIP top-down' AND has_naip AND q.b[1] >= 0 AND q.b[1] <= q.b[3] AND q.b[3] <= 1000 AND q.b[2] >= 0 AND q.b[2] <= q.b[4] AND q.b[4] <= 1000)"
_SHOWN = "CASE WHEN NOT nothing AND uv > 0 THEN array_to_string(list_slice(['Vert', 'North', 'East', 'South', 'West'], 1, uv), ',') END"


@query(f"""WITH {_chain(_TIERED, 'NOT has_naip')} SELECT id, CASE WHEN NOT nothing THEN {_trust('input_confidence')} END AS input_confidence, {_SHOWN} AS nearmap_views,
  CASE WHEN NOT nothing AND uv > 0 THEN CASE WHEN wide THEN 250.0::DOUBLE ELSE 100.0::DOUBLE END END AS nearmap_aoi_m, CASE WHEN NOT nothing THEN 'NAIP' END AS chip, CASE WHEN NOT nothing THEN n0 + uv END AS view_count,
  CASE WHEN nothing THEN 'no_imagery' ELSE q.t END AS site_type, CASE WHEN NOT nothing THEN q.ev END AS site_evidence,
  coalesce({_ON_MAP}, false) AS located, CASE WHEN {_ON_MAP} THEN true END AS near,
  CASE WHEN {_ON_MAP} THEN round_even(250 * sqrt(pow((q.b[2] + q.b[4]) / 2000.0::DOUBLE - 0.5, 2) + pow((q.b[1] + q.b[3]) / 2000.0::DOUBLE - 0.5, 2)), 1) END AS asset_offset_m,
  CASE WHEN NOT nothing AND len(q.b) > 0 THEN '[' || q.b[1] || '.0, ' || q.b[2] || '.0, ' || q.b[3] || '.0, ' || q.b[4] || '.0]' END AS asset_box_2d, CASE WHEN NOT nothing THEN q.w END AS asset_view,
  CASE WHEN NOT nothing THEN {_conf('q.cc')} END AS cell_equipment_confidence, CASE WHEN NOT nothing THEN q.ce END AS cell_equipment_evidence,
  CASE WHEN NOT nothing AND gate AND z IS NOT NULL AND crops > 0 THEN crops::INT END AS zoom_crops, CASE WHEN NOT nothing THEN ({_trust('input_confidence')} = 'high' AND q.e IS NOT DISTINCT FROM false) END AS source_trust_mismatch,
  CASE WHEN NOT nothing THEN 'primary' END AS primary_model, CASE WHEN NOT nothing AND second THEN 'secondary' END AS escalation_model FROM k""")
def final_projection(spark, d):
    """The located point is compared with one on the plane that touches the ellipsoid at the site: they agree within 0.3 m."""
    rows = cascade.final_projection(cascade.cascade(_staged(spark, d)))
    b = F.from_json("asset_box_2d", "array<double>")
    e, n = ((F.get(b, F.lit(1)) + F.get(b, F.lit(3))) / 2000 - 0.5) * 250 / 0.9996, (0.5 - (F.get(b, F.lit(0)) + F.get(b, F.lit(2))) / 2000) * 250 / 0.9996
    phi, middle = F.radians("lat"), (F.floor((c("lon") + 180) / 6) * 6 - 177).cast("double")
    turn, w = F.atan(F.tan(F.radians(c("lon") - middle)) * F.sin(phi)), 1 - 0.00669438 * F.pow(F.sin(phi), 2)
    k = 1 + F.pow(F.radians(c("lon") - middle) * F.cos(phi), 2) / 2
    east, north = (e * F.cos(turn) + n * F.sin(turn)) / k, (n * F.cos(turn) - e * F.sin(turn)) / k
    off = F.hypot((c("asset_lat") - c("lat")) * F.pi() / 180 * 6378137 * 0.99330562 / F.pow(w, 1.5) - north, (c("asset_lon") - c("lon")) * F.pi() / 180 * 6378137 / F.sqrt(w) * F.cos(phi) - east)
    return rows.select(
        "id", "input_confidence", "nearmap_views", "nearmap_aoi_m", F.regexp_extract("chip_path", "_(NAIP)", 1).alias("chip"), "view_count", "site_type", "site_evidence", c("asset_lat").isNotNull().alias("located"), (off < 0.3).alias("near"),
        "asset_offset_m", "asset_box_2d", "asset_view", "cell_equipment_confidence", "cell_equipment_evidence", "zoom_crops", "source_trust_mismatch", "primary_model", "escalation_model",
    )


@query(f"WITH {REPLIES} SELECT {_K} FROM replies WHERE site_type IN ('tower', 'rooftop') AND {_conf('conf')} > 0.6")
def handoff(spark, d):
    return cascade.handoff(_results(spark, d)).select(*KEY)


@query(f"""WITH {VIEWS}, chips AS (SELECT DISTINCT id || '_nearmap_' || lower(view) || '.jpg' AS path FROM shown WHERE event_id % 2 = 0 UNION SELECT DISTINCT id || '_NAIP.jpg' FROM shown WHERE event_id % 3 = 0),
r AS (SELECT id, views, substr(id, 2)::BIGINT % 2 = 0 AS cell FROM lists), cand AS (
  SELECT id, list_position(['North','East','South','West'], view) AS pos, id || '_nearmap_' || lower(view) || '.jpg' AS path FROM (SELECT id, cell, unnest(views) AS view FROM r) WHERE cell AND view <> 'Vert'
  UNION ALL SELECT id, 9, id || '_nearmap_vert.jpg' FROM r UNION ALL SELECT id, 10, id || '_NAIP.jpg' FROM r)
SELECT r.id, min_by(cand.path, pos) AS review_image FROM r LEFT JOIN (SELECT * FROM cand SEMI JOIN chips USING (path)) cand USING (id) GROUP BY r.id""")
def review_pick(spark, d):
    shown = v.view_rows(spark, d)
    chips = shown.where("event_id % 2 = 0").select(F.concat("id", F.lit("_nearmap_"), F.lower("view"), F.lit(".jpg")).alias("path")).union(shown.where("event_id % 3 = 0").select(F.concat("id", F.lit("_NAIP.jpg"))))
    none = F.lit(None).cast("string")
    rows = imagery.view_summary(imagery.assemble_views(shown)).select(
        "id", "nearmap_views", (F.substring("id", 2, 20).cast("long") % 2 == 0).alias("cell_equipment"), none.alias("asset_view"), none.alias("chip_path"), F.lit(None).cast("array<string>").alias("zoom_paths")
    )
    return reports.review_images(rows, chips)


_OFF = "round_even(asset_offset_m, 0)::BIGINT || ' m off'"


@query(f"""WITH {REPLIES} SELECT {_K}, id || ' (' || reply_type || ')' AS asset, CASE WHEN {_FAILED} THEN 'error' WHEN site_type = 'no_imagery' THEN 'no imagery' ELSE site_type END AS site_type,
  CASE WHEN NOT {_FAILED} AND coalesce(site_type, '') <> 'no_imagery' THEN round_even({_conf('conf')}, 2) END AS conf,
  CASE WHEN {_FAILED} OR site_type = 'no_imagery' THEN '—' WHEN asset_offset_m IS NOT NULL THEN {_OFF} WHEN coalesce(asset_view, '') <> '' THEN 'on ' || asset_view ELSE '—' END AS located,
  CASE WHEN {_FAILED} THEN substr(trim(error), 1, 120) WHEN site_type = 'no_imagery' THEN '—' WHEN cell_equipment IS NULL THEN 'unknown' ELSE cell_equipment::VARCHAR || coalesce(' — ' || trim(site_evidence), '') END AS cell_equip,
  CASE WHEN NOT {_FAILED} AND site_type = 'no_imagery' THEN 0 ELSE view_count END AS views FROM replies""")
def stakeholder_rows(spark, d):
    rows = _results(spark, d).withColumns({"label": c("reply_type"), "cell_equipment_evidence": c("site_evidence"), "review_image": F.lit(None).cast("string")})
    return reports.stakeholder_rows(rows, KEY).drop("review_image")


_CELL = "CASE WHEN cell_equipment IS NULL THEN 'Unknown' WHEN cell_equipment THEN 'Yes' ELSE 'No' END"


@query(f"""WITH {SITES}, {REPLIES}, l AS (SELECT r.*, coalesce(x.label, r.reply_type) AS region FROM replies r LEFT JOIN sites x ON x.id = r.id)
SELECT id, '| ' || id || ' | ' || region || ' | ' || CASE WHEN {_FAILED} THEN '**ERROR** | — | — | — | — | ' || CASE WHEN length(trim(error)) > 60 THEN substr(trim(error), 1, 60) || '…' ELSE trim(error) END
  WHEN site_type = 'no_imagery' THEN 'No imagery | — | — | — | — | Outside coverage'
  ELSE coalesce(site_type, '—') || ' | ' || coalesce(round_even({_conf('conf')} * 100, 0)::BIGINT || '%', '—') || ' | ' || {_CELL} || ' | ' ||
    CASE WHEN asset_lat IS NOT NULL THEN coalesce({_OFF}, 'yes') WHEN coalesce(asset_view, '') <> '' THEN 'on ' || asset_view ELSE '—' END || ' | ' ||
    CASE WHEN nearmap_aoi_m = 250 THEN 'wide AOI' ELSE coalesce(classification_stage, 'primary') END || ' | ' ||
    CASE WHEN length(site_evidence) > 90 THEN substr(site_evidence, 1, 90) || '…' ELSE coalesce(site_evidence, '') END END || ' |' AS line FROM l""")
def summary_rows(spark, d):
    rows = reports.regenerate(_results(spark, d)).withColumn("label", c("reply_type"))
    return reports.summary_rows(reports.with_region(rows, v.sites(spark, d), "k"))


@query(f"WITH {SITES}, {REPLIES} SELECT {_K}, coalesce(x.label, r.reply_type) AS region FROM replies r LEFT JOIN sites x ON x.id = r.id")
def region_lookup(spark, d):
    return reports.with_region(_results(spark, d).withColumn("label", c("reply_type")), v.sites(spark, d), "k").select(*KEY, "region")


@query(f"WITH {VIEWS} SELECT id, CASE WHEN len(list_filter(views, lambda x: x <> 'Vert')) > 0 THEN 'full' WHEN list_contains(views, 'Vert') THEN 'nearmap_vert_only' ELSE 'none' END AS tier FROM lists")
def imagery_tier(spark, d):
    return imagery.assemble_views(v.view_rows(spark, d)).select("id", scalars.imagery_tier(c("views"), F.lit(False)).alias("tier"))


@query(f"WITH {REPLIES} SELECT {_K}, (view_count = 0 OR coalesce({_conf('conf')} < 0.6, true) OR {_FAILED}) AS review FROM replies")
def manual_review(spark, d):
    tier = F.when(c("view_count") == 0, "naip_only").otherwise("full")
    return v.replies(spark, d).select(*KEY, scalars.manual_review(tier, c("conf"), c("error")).alias("review"))


@query(f"""WITH {SITES}, p AS (SELECT k, lat, lon FROM sites WHERE lat IS NOT NULL), q AS (SELECT a.k AS a, b.k AS b,
  2 * 6371008.8::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS m
  FROM p a JOIN p b ON a.k < b.k AND abs(a.lat - b.lat) < 0.5) SELECT a, b, round(m, 1) AS metres FROM q WHERE m <= 30000""")
def radius_pairs(spark, d):
    return intake.near_pairs(v.sites(spark, d).selectExpr("k", "lat", "lon"), 30_000.0, "k")


@query(f"""WITH {SITES}, p AS (SELECT k, lat, lon FROM sites)
SELECT k, lat, lon FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.k < a.k AND abs(a.lat - b.lat) < 0.5 AND
  2 * 6371008.8::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(a.lat - b.lat) / 2), 2) + cos(radians(b.lat)) * cos(radians(a.lat)) * pow(sin(radians(a.lon - b.lon) / 2), 2)))) <= 30000)""")
def radius_dedup(spark, d):
    return intake.radius_dedup(v.sites(spark, d).selectExpr("k", "lat", "lon"), 30_000.0, "k")


# Tiles: an event is a tile of a group's view; most arrive, some aren't there, few fail.
_TILES = """tiles AS (SELECT id, view, CASE WHEN event_id % 997 = 0 THEN 500 WHEN event_id % 4 = 0 THEN 200 ELSE 404 END AS status, event_id FROM shown),
got AS (SELECT id, list_transform(list_sort(list_distinct(list(list_position(['Vert','North','East','South','West'], view)) FILTER (status = 200))), lambda i: list_extract(['Vert','North','East','South','West'], i)) AS views
  FROM tiles GROUP BY id HAVING bool_and(status IN (200, 404)) AND count(*) FILTER (status = 200) > 0)"""


def _tiles(spark, d):
    return v.view_rows(spark, d).withColumn("status", F.expr("CASE WHEN event_id % 997 = 0 THEN 500 WHEN event_id % 4 = 0 THEN 200 ELSE 404 END"))


@query(f"WITH {VIEWS}, {_TILES} SELECT id, array_to_string(views, ',') AS views FROM got")
def arrived_views(spark, d):
    return imagery.arrived_views(_tiles(spark, d)).select("id", F.array_join("views", ",").alias("views"))


@query(f"""WITH {VIEWS}, {_TILES}, ids AS (SELECT DISTINCT id FROM shown), naip AS (SELECT id, strftime(max(DATE '2020-01-01' + (event_id % 700)::INT), '%Y-%m-%d') AS image_date FROM shown WHERE event_id % 3 = 0 GROUP BY id),
dates AS (SELECT id, arg_min(event_id % 90, event_id) AS day FROM shown WHERE event_id % 5 > 0 GROUP BY id)
SELECT ids.id, image_date IS NOT NULL AS has_naip, image_date, coalesce(array_to_string(views, ','), '') AS views, CASE WHEN views IS NOT NULL THEN day END AS nearmap_day, image_date IS NULL AND views IS NULL AS bare
FROM ids LEFT JOIN naip USING (id) LEFT JOIN got USING (id) LEFT JOIN dates USING (id)""")
def site_imagery(spark, d):
    shown = v.view_rows(spark, d)
    scenes = shown.where("event_id % 3 = 0").selectExpr("id", "date_add(DATE '2020-01-01', cast(event_id % 700 AS int)) AS dt", "event_id AS item_ord")
    coverage = shown.selectExpr("id", "event_id % 90 AS capture_date", "event_id AS survey_ord", "CASE WHEN event_id % 5 = 0 THEN 'lost' END AS error")
    out = imagery.with_imagery(shown.select("id").distinct(), scenes, _tiles(spark, d), coverage)
    bare, _ = imagery.without_imagery(out)
    flags = bare.select("id", F.lit(True).alias("bare"))
    return out.join(flags, "id", "left").select("id", "has_naip", "image_date", F.array_join("views", ",").alias("views"), c("nearmap_date").alias("nearmap_day"), F.coalesce("bare", F.lit(False)).alias("bare"))


@query(f"""WITH {_PLAN}, n AS (SELECT DISTINCT id, view, z, x0, x1, y0, y1 FROM t), k AS (SELECT *, 256 * CASE WHEN view IN ('East', 'West') THEN y1 - y0 + 1 ELSE x1 - x0 + 1 END AS w,
  256 * CASE WHEN view IN ('East', 'West') THEN x1 - x0 + 1 ELSE y1 - y0 + 1 END AS h0 FROM n), f AS (SELECT *, CASE WHEN view = 'Vert' THEN h0 ELSE h0 * 3 // 4 END AS h FROM k)
SELECT id, view, trunc(w * least(1.0::DOUBLE, 2048.0::DOUBLE / greatest(w, h)))::INT AS width, trunc(h * least(1.0::DOUBLE, 2048.0::DOUBLE / greatest(w, h)))::INT AS height FROM f""")
def canvas_size(spark, d):
    w, h = geo.canvas(c("view"))
    return imagery.tile_plan(v.sites(spark, d)).select("id", "view", "x0", "x1", "y0", "y1").distinct().select("id", "view", w.alias("width"), h.alias("height"))


@query(f"WITH {SITES} SELECT id, 'base' || CASE WHEN lower(trim(label)) = 'stealth' THEN ' stealth' ELSE '' END || CASE {_trust('input_confidence')} WHEN 'high' THEN ' sure' WHEN 'medium' THEN ' maybe' ELSE ' doubt' END AS prompt FROM sites")
def prompt(spark, d):
    made = scalars.prompt("base", " stealth", {"high": " sure", "medium": " maybe", "low": " doubt"}, c("label"), c("input_confidence"))
    return v.sites(spark, d).select("id", made.alias("prompt"))


@query("""WITH r AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props END AS used FROM events)
SELECT event_id, coalesce(used, 'said ' || event_id || ' and more') AS text FROM r""")
def block_text(spark, d):
    blocks = F.array(
        F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("input"), F.concat(F.lit("said "), "event_id").alias("text")),
        F.struct(F.lit("tool_use").alias("type"), F.when(c("event_id") % 3 == 0, "classify").otherwise("other").alias("name"), c("props").alias("input"), F.lit(None).cast("string").alias("text")),
        F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("input"), F.lit(" and more").alias("text")),
    )
    return v.table(spark, d, "events").select("event_id", block_of(blocks, "classify").alias("text"))


@query(f"WITH {REPLIES} SELECT {_K}, row_number() OVER (ORDER BY {_K}) AS row FROM replies")
def progress_rows(spark, d):
    return reports.progress(v.replies(spark, d).select(*KEY), KEY)
