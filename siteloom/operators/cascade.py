"""The cascade over the reply log. Replies are structs of ``FIELDS``, one column a stage; null: no reply.

Every stage's reply has a second look of its own; each is judged with the views that its stage has shown. Modes: ``tiered``
(NAIP, then the vertical view, then all), ``full`` (all views at once) and ``naip_only``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.config import DEFAULT, NAIP, TOP_DOWN, Config
from siteloom.functions import geo
from siteloom.functions.replies import reply as parsed
from siteloom.functions.scalars import confidence, confident_stop, escalation_reason, is_asset, is_false, is_true, trust, trust_mismatch

FIELDS = ("site_type", "conf", "cell", "cell_conf", "cell_evidence", "evidence", "box", "view", "model")
_UNSURE = ("other", "unclear")


def from_log(log: DataFrame) -> DataFrame:
    """Replies as text (id, stage, attempt, model, raw) as rows of ``FIELDS``; failed requests (no raw) give none."""
    got = parsed(F.col("raw"))
    names = {
        "site_type": "site_type", "conf": "site_confidence", "cell": "cell_equipment", "cell_conf": "cell_equipment_confidence", "cell_evidence": "cell_equipment_evidence",
        "evidence": "site_evidence", "box": "asset_box_2d", "view": "asset_view",
    }
    return log.where("raw IS NOT NULL").select("id", "stage", "attempt", "model", *[got[name].alias(field) for field, name in names.items()])


def pivot_stages(replies: DataFrame, stages: list[str], key: str = "id", attempt: str = "attempt") -> DataFrame:
    """One row a key with a struct for each stage, of its last attempt; one shuffle for all stages.

    A key's replies are put into one list, the last attempt first, in which each stage is looked up: an aggregate for each stage would
    handle every reply once a stage. A reply without a number of its attempt counts for no stage.
    """
    c = F.col
    one = F.struct(c(attempt).alias("attempt"), F.when(c(attempt).isNotNull(), c("stage")).alias("stage"), F.struct(*FIELDS).alias("reply"))
    listed = replies.groupBy(key).agg(F.sort_array(F.collect_list(one), asc=False).alias("_all")).withColumn("_stages", c("_all.stage"))
    return listed.select(key, *[F.get("_all", (F.array_position("_stages", F.lit(s)) - 1).cast("int"))["reply"].alias(s) for s in stages])


def attempts(log: DataFrame) -> DataFrame:
    """id, stage, attempts: of each request the tries that it took."""
    return log.groupBy("id", "stage").agg(F.max("attempt").alias("attempts"))


def recheck_gate(reply: Column, input_confidence: Column, views: Column) -> Column:
    """A trusted site whose equipment wasn't seen, though two or more images (NAIP counts) were shown, is looked at again."""
    return trust(input_confidence).isin("high", "medium") & is_false(reply.cell) & F.coalesce(views >= 2, F.lit(False))


def recheck_merge(reply: Column, again: Column, gate: Column) -> Column:
    """The reply, overruled where a second look sees equipment; the type only where that is a clear one."""
    seen = gate & is_true(again.cell)
    adopt = seen & is_asset(again.site_type)
    new = {
        "site_type": (adopt, again.site_type), "conf": (adopt, F.coalesce(again.conf, reply.conf)), "cell": (seen, F.lit(True)),
        "cell_conf": (seen, F.coalesce(again.cell_conf, reply.cell_conf)), "cell_evidence": (seen, F.coalesce(again.cell_evidence, reply.cell_evidence)),
        "evidence": (adopt, F.coalesce(again.evidence, reply.evidence)),
    }
    return F.when(seen, F.struct(*[(F.when(*new[f]).otherwise(reply[f]) if f in new else reply[f]).alias(f) for f in FIELDS])).otherwise(reply)


def rechecked(stage: str, views: Column) -> Column:
    return recheck_merge(F.col(stage), F.col(f"{stage}_recheck"), recheck_gate(F.col(stage), F.col("input_confidence"), views))


def second_looks(df: DataFrame, views: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``rechecked`` for each (stage: name, SQL of the images shown). What decides is a column of its own, and the rest is text, which keeps plans small and quick to build."""
    seen = {f"_seen_{s}": F.expr(f"_trusted AND {s}.cell <=> false AND coalesce({shown} >= 2, false) AND {s}_recheck.cell <=> true") for s, (_, shown) in views.items()}
    adopt = {f"_adopt_{s}": F.expr(f"_seen_{s} AND coalesce({s}_recheck.site_type IN ('tower', 'rooftop'), false)") for s in views}

    def merged(s: str) -> Column:
        either = lambda flag, f: f"CASE WHEN {flag}_{s} THEN coalesce({s}_recheck.{f}, {s}.{f}) ELSE {s}.{f} END"
        flags = {"site_type": "_adopt", "conf": "_adopt", "evidence": "_adopt", "cell_conf": "_seen", "cell_evidence": "_seen"}
        fields = ", ".join(f"'{f}', " + ("true" if f == "cell" else either(flags[f], f) if f in flags else f"{s}.{f}") for f in FIELDS)
        return F.expr(f"CASE WHEN _seen_{s} THEN named_struct({fields}) ELSE {s} END")

    return df.withColumns(seen).withColumns(adopt).withColumns({name: merged(s) for s, (name, _) in views.items()})


def route(primary: Column, secondary: Column, enabled: bool = True, config: Config = DEFAULT) -> dict[str, Column]:
    """The reply adopted after escalation, and why."""
    reason = escalation_reason(primary.site_type, primary.conf, config) if enabled else F.lit(None).cast("string")
    use = reason.isNotNull() & secondary.isNotNull()
    return {"escalation_reason": reason, "provider": F.when(use, "secondary").otherwise("primary"), "reply": F.when(use, secondary).otherwise(primary)}


def tier_cascade(naip: Column, vert: Column, full: Column, config: Config = DEFAULT) -> dict[str, Column]:
    """Each tier replaces the one before, until one is sure or the imagery ends (``vert`` or ``full`` is null)."""
    stop0 = confident_stop(naip.site_type, naip.conf, naip.cell, config) | vert.isNull()
    stop1 = confident_stop(vert.site_type, vert.conf, vert.cell, config) | full.isNull()
    return {
        "nearmap_tier": F.when(stop0, "naip_only").when(stop1, "vert_only").otherwise("full"),
        "reply": F.when(stop0, naip).when(stop1, vert).otherwise(full),
    }


def wide_gate(site_type: Column, views: Column, naip_only: bool = False, has_key: bool = True) -> Column:
    """A site of no clear type without an oblique view is tried over a wider area."""
    oblique = F.coalesce(F.exists(views, lambda v: v != "Vert"), F.lit(False))
    return F.coalesce(site_type.isin(*_UNSURE), F.lit(False)) & ~oblique & F.lit(has_key and not naip_only)


def forced(label: Column) -> Column:
    return F.coalesce(F.lower(F.trim(label)) == "stealth", F.lit(False))


def zoom_source(views: Column, has_naip: Column) -> Column:
    """The image that crops are made of."""
    return F.when(F.coalesce(F.array_contains(views, "Vert"), F.lit(False)), TOP_DOWN).when(is_true(has_naip), NAIP)


def zoom_gate(label: Column, site_type: Column, source: Column) -> Column:
    return (forced(label) | F.coalesce(site_type.isin(*_UNSURE), F.lit(False))) & source.isNotNull()


def zoom_wins(prior: Column, zoom: Column, label: Column) -> Column:
    better = F.coalesce(confidence(zoom.conf), F.lit(0.0)) > F.coalesce(confidence(prior.conf), F.lit(0.0))
    return zoom.isNotNull() & (is_asset(zoom.site_type) | better | forced(label))


def crop_counts(candidates: DataFrame) -> DataFrame:
    """id, zoom_crops from ``imagery.zoom_candidates``."""
    return candidates.groupBy("id").agg(F.count("*").cast("int").alias("zoom_crops"))


def cascade(stages: DataFrame, mode: str = "tiered", escalate: bool = True, has_key: bool = True, config: Config = DEFAULT) -> DataFrame:
    """The whole cascade; one row a site, nothing is shuffled.

    stages: id, label, input_confidence, has_naip, views and wide_views (those that arrived), zoom_crops (how many could be made; null: not tried), and a
    reply struct for each of ``config.STAGES``. A site without any image is no_imagery. Added: reply, classification_stage,
    nearmap_tier, shown_views, escalation_reason, provider, and zoomed (whether crops were looked at).
    """
    c = F.col
    one = "CAST(has_naip AS INT)"
    empty = F.array().cast("array<string>")
    df = stages.withColumns({"has_naip": is_true(c("has_naip")), "views": F.coalesce("views", empty) if has_key else empty, "wide_views": F.coalesce("wide_views", empty), "_trusted": trust(c("input_confidence")).isin("high", "medium")})
    if mode == "tiered":
        vert = F.when(F.array_contains("views", "Vert"), c("_vert"))
        df = second_looks(df, {"naip": ("_naip", one), "vert": ("_vert", f"{one} + 1"), "full": ("_full", f"{one} + size(views)")})
        tier = tier_cascade(c("_naip"), vert, c("_full"), config)
        df = df.withColumns({"_tier": tier["nearmap_tier"], "_r": tier["reply"]})
        shown = F.when(c("_tier") == "naip_only", empty).when(c("_tier") == "vert_only", F.array(F.lit("Vert"))).otherwise(c("views"))
        df = df.withColumns({"_shown": shown, "_none": ~c("has_naip")})
    elif mode == "full":
        df = second_looks(df, {"full": ("_r", f"{one} + size(views)")}).withColumns({"_tier": F.when(F.size("views") > 0, "full").otherwise("naip_only"), "_shown": c("views"), "_none": ~c("has_naip") & (F.size("views") == 0)})
    elif mode == "naip_only":
        df = second_looks(df, {"naip": ("_r", one)}).withColumns({"_tier": F.lit("naip_only"), "_shown": empty, "_none": ~c("has_naip")})
    else:
        raise ValueError(f"no such mode: {mode}")
    df = second_looks(df, {"escalate": ("_second", f"{one} + size(_shown)"), "wide": ("_w", f"{one} + size(wide_views)"), "wide_escalate": ("_w2", f"{one} + size(wide_views)")})
    routed = route(c("_r"), c("_second"), escalate, config)
    df = df.withColumns({"_reason": routed["escalation_reason"], "_provider": routed["provider"], "_next": routed["reply"]}).withColumn("_r", c("_next"))
    # The wider area goes by the provider that has the site now; only the primary one is escalated from.
    df = df.withColumn("_wide", wide_gate(c("_r.site_type"), c("_shown"), mode == "naip_only", has_key) & (F.size("wide_views") > 0) & c("wide").isNotNull())
    again = route(c("_w"), c("_w2"), escalate, config)
    df = df.withColumn("_again", c("_wide") & (c("_provider") == "primary"))
    df = df.withColumns({"_reason2": F.when(c("_again"), again["escalation_reason"]), "_provider2": F.when(c("_again"), again["provider"]), "_next": F.when(c("_again"), again["reply"]).when(c("_wide"), c("_w")).otherwise(c("_r"))})
    df = df.withColumns({"_r": c("_next"), "_shown": F.when(c("_wide"), c("wide_views")).otherwise(c("_shown"))})
    nothing = F.struct(*[(F.lit("unclear") if f == "site_type" else F.lit(0.0) if f == "conf" else F.lit("Zoom stage without valid crops.") if f == "evidence" else F.lit(None).cast(stages.schema["zoom"].dataType[f].dataType)).alias(f) for f in FIELDS])
    gate = zoom_gate(c("label"), c("_r.site_type"), zoom_source(c("_shown"), c("has_naip")))
    df = df.withColumns({"_gate": gate, "_z": F.when(c("zoom_crops") == 0, nothing).otherwise(c("zoom"))})
    df = df.withColumn("_zoom", F.coalesce(c("_gate") & zoom_wins(c("_r"), c("_z"), c("label")), F.lit(False)) & ~c("_none"))
    seen = lambda x: F.when(~c("_none"), x)
    blank = F.struct(*[(F.lit("no_imagery") if f == "site_type" else F.lit(None).cast(stages.schema["zoom"].dataType[f].dataType)).alias(f) for f in FIELDS])
    return df.select(
        *stages.columns, F.when(c("_none"), blank).when(c("_zoom"), c("_z")).otherwise(c("_r")).alias("reply"),
        seen(F.when(c("_zoom"), "zoom").when(c("_wide"), "wide_aoi").otherwise("primary")).alias("classification_stage"),
        seen(F.when(c("_zoom"), "zoom").when(c("_wide"), "wide_aoi").otherwise(c("_tier"))).alias("nearmap_tier"),
        seen(c("_shown")).alias("shown_views"), seen(F.coalesce("_reason2", "_reason")).alias("escalation_reason"), seen(F.coalesce("_provider2", "_provider")).alias("provider"),
        seen(c("_gate") & c("_z").isNotNull()).alias("zoomed"), seen(c("_wide")).alias("widened"),
    )


def locate(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Add asset_lat, asset_lon and asset_offset_m: of a box that was drawn on the (georeferenced) NAIP image of the site at lat, lon.

    Column by column, so that the series of the projection are computed once each.
    """
    c = F.col
    on_map = F.coalesce((F.size("reply.box") > 0) & (c("reply.view") == NAIP) & is_true(c("has_naip")), F.lit(False))
    df = df.withColumns({"_zone": geo.utm_zone(c("lon")), "_centre": F.when(on_map, geo.box_centre(c("reply.box")))})
    east, north = geo.utm_forward(c("lat"), c("lon"), c("_zone"))
    df = df.withColumns({"_e": east, "_n": north})
    at = geo.chip_bounds(c("_e"), c("_n"), config.chip_m)
    # The image's first row is its northern edge.
    df = df.withColumns({"_x": at["x_min"] + c("_centre.cx") * (at["x_max"] - at["x_min"]), "_y": at["y_max"] - c("_centre.cy") * (at["y_max"] - at["y_min"])})
    lat, lon = geo.utm_inverse(c("_x"), c("_y"), c("_zone"))
    offset = F.when(on_map, F.bround(geo.box_offset(c("reply.box"), config.chip_m), 1))
    return df.withColumns({"asset_lat": lat, "asset_lon": lon, "asset_offset_m": offset}).drop("_zone", "_centre", "_e", "_n", "_x", "_y")


def final_projection(cascaded: DataFrame, primary: str = "primary", secondary: str = "secondary", config: Config = DEFAULT) -> DataFrame:
    """Result rows of ``cascade``'s output with lat and lon (and image_date, nearmap_date and chip_path, if there are): the detail table's columns."""
    c, r = F.col, lambda f: F.col(f"reply.{f}")
    df = locate(cascaded, config)
    box = F.concat(F.lit("["), F.array_join(F.transform(r("box"), lambda v: v.cast("string")), ", "), F.lit("]"))
    done = c("classification_stage").isNotNull()
    have = lambda name: c(name) if name in cascaded.columns else F.lit(None).cast("string")
    given = [x for x in ("id", "lat", "lon", "address", "label", "geocode_source", "geocode_matched_address", "geocode_quality", "input_address") if x in cascaded.columns]
    return df.select(
        *given, F.when(done, trust(c("input_confidence"))).alias("input_confidence"), have("image_date").alias("image_date"), F.when(done, have("nearmap_date")).alias("nearmap_date"),
        F.when(F.size("shown_views") > 0, F.array_join("shown_views", ",")).alias("nearmap_views"),
        F.when(F.size("shown_views") > 0, F.when(c("widened"), config.wide_m).otherwise(config.tile_m)).alias("nearmap_aoi_m"),
        F.when(done & is_true(c("has_naip")), F.coalesce(have("chip_path"), F.concat("id", F.lit("_NAIP.jpg")))).alias("chip_path"),
        (is_true(c("has_naip")).cast("int") + F.size("shown_views")).alias("view_count"),
        r("site_type").alias("site_type"), confidence(r("conf")).alias("site_confidence"), r("evidence").alias("site_evidence"),
        "asset_lat", "asset_lon", "asset_offset_m", F.when(F.size(r("box")) > 0, box).alias("asset_box_2d"), r("view").alias("asset_view"),
        r("cell").alias("cell_equipment"), confidence(r("cell_conf")).alias("cell_equipment_confidence"), r("cell_evidence").alias("cell_equipment_evidence"), "classification_stage",
        F.when(c("zoomed") & (c("zoom_crops") > 0), c("zoom_crops")).alias("zoom_crops"), F.when(done, trust_mismatch(c("input_confidence"), r("cell"))).alias("source_trust_mismatch"),
        r("model").alias("model"), "nearmap_tier", F.when(done, F.lit(primary)).alias("primary_model"), F.when(c("provider") == "secondary", secondary).alias("escalation_model"), "escalation_reason",
    )


def handoff(results: DataFrame, threshold: float = DEFAULT.medium) -> DataFrame:
    """Extension: what goes on downstream, towers and rooftops above a confidence."""
    return results.where(is_asset(F.col("site_type")) & (confidence(F.col("site_confidence")) > threshold))
