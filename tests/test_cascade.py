"""Cascades worked out by hand: which reply wins, by which stage, and where the asset is."""

import pytest
from pyspark.sql import functions as F

from siteloom.config import STAGES
from siteloom.operators import cascade

_KIND = "struct<site_type: string, conf: double, cell: boolean, cell_conf: double, cell_evidence: string, evidence: string, box: array<double>, view: string, model: string>"
_SCHEMA = "id string, label string, input_confidence string, has_naip boolean, views array<string>, wide_views array<string>, zoom_crops int, lat double, lon double, " + ", ".join(f"{s} {_KIND}" for s in STAGES)


def reply(site_type=None, conf=None, cell=None, box=None, view=None, model=None, cell_conf=None, cell_evidence=None, evidence=None):
    return (site_type, conf, cell, cell_conf, cell_evidence, evidence, box, view, model)


def site(label="plain", trust="high", image=True, views=(), wide_views=(), crops=None, lat=40.0, lon=-90.0, **replies):
    return ("s", label, trust, image, list(views), list(wide_views), crops, lat, lon, *[replies.get(s) for s in STAGES])


@pytest.fixture(scope="module")
def run(spark):
    """One site at a time; compiling the plan would take far longer than running it."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)

    def go(mode="tiered", project=False, routed=True, **facts):
        out = cascade.cascade(spark.createDataFrame([site(**facts)], _SCHEMA), mode=mode, escalate=routed)
        if project:
            return cascade.final_projection(out).first()
        r = out.select("reply.*", "classification_stage", "nearmap_tier", "shown_views", "escalation_reason", "provider", "zoomed").first()
        return r

    yield go
    for k, v in before.items():
        spark.conf.set(k, v)


SURE, NO_GEAR = reply("tower", 0.9, True, model="a"), reply("tower", 0.9, False, model="a", evidence="old")


def test_sure_first_tier_stops(run):
    r = run(views=["Vert", "North"], image=True, **{"naip": SURE, "vert": reply("rooftop", 0.9, True), "full": reply("rooftop", 0.9, True)})
    assert (r.site_type, r.nearmap_tier, r.shown_views, r.classification_stage) == ("tower", "naip_only", [], "primary")


def test_second_look_needs_two_images_and_naip_counts(run):
    """With NAIP alone there is one image; NAIP and the vertical view are two."""
    again = reply("rooftop", 0.8, True, cell_conf=0.7, cell_evidence="panels", evidence="new")
    one = run(image=True, **{"naip": NO_GEAR, "naip_recheck": again})
    assert (one.site_type, one.cell) == ("tower", False)
    unsure = reply("unclear", 0.5, None)
    two = run(views=["Vert"], **{"naip": unsure, "vert": NO_GEAR, "vert_recheck": again})
    assert (two.site_type, two.conf, two.cell, two.cell_conf, two.cell_evidence, two.evidence, two.model, two.nearmap_tier) == ("rooftop", 0.8, True, 0.7, "panels", "new", "a", "vert_only")
    other = run(views=["Vert"], **{"naip": unsure, "vert": NO_GEAR, "vert_recheck": reply("other", 0.8, True, cell_conf=0.7, evidence="new")})
    assert (other.site_type, other.conf, other.cell, other.cell_conf, other.evidence) == ("tower", 0.9, True, 0.7, "old")
    low = run(trust=" LOW ", views=["Vert"], **{"naip": unsure, "vert": NO_GEAR, "vert_recheck": again})
    assert (low.site_type, low.cell) == ("tower", False)


def test_second_look_may_stop_a_tier(run):
    """Equipment that is unknown never stops; the second look is only for what is false."""
    r = run(views=["Vert", "North"], **{"naip": reply("tower", 0.9, None), "vert": reply("rooftop", 0.65, False), "full": SURE})
    assert (r.site_type, r.nearmap_tier) == ("rooftop", "vert_only")
    r = run(views=["Vert", "North"], **{"naip": reply("tower", 0.9, None), "vert": reply("rooftop", 0.59, False), "full": SURE})
    assert (r.site_type, r.nearmap_tier, r.shown_views) == ("tower", "full", ["Vert", "North"])
    r = run(views=["North"], **{"naip": reply("unclear", 0.1, None), "vert": SURE, "full": SURE})
    assert (r.nearmap_tier, r.escalation_reason) == ("naip_only", "unclear_type")


def test_escalation_has_its_own_second_look(run):
    first = reply("other", 0.9, True)
    r = run(views=["Vert"], mode="full", **{"full": first, "escalate": reply("tower", 0.9, False, model="b"), "escalate_recheck": reply("other", 0.9, True, cell_conf=0.6)})
    assert (r.site_type, r.cell, r.cell_conf, r.model, r.provider, r.escalation_reason) == ("tower", True, 0.6, "b", "secondary", "other_type")
    r = run(views=["Vert"], mode="full", routed=False, **{"full": first, "escalate": SURE})
    assert (r.site_type, r.provider, r.escalation_reason) == ("other", "primary", None)


def test_wide_area(run):
    """Only without obliques; escalated only from the primary provider."""
    facts = {"naip": reply("unclear", 0.2, None), "vert": reply("unclear", 0.3, None), "full": reply("unclear", 0.3, None), "wide": reply("other", 0.9, True, model="w"), "wide_escalate": reply("rooftop", 0.9, True, model="we")}
    r = run(views=["Vert"], wide_views=["Vert", "North"], **facts)
    assert (r.site_type, r.model, r.nearmap_tier, r.classification_stage, r.provider, r.escalation_reason, r.shown_views) == ("rooftop", "we", "wide_aoi", "wide_aoi", "secondary", "other_type", ["Vert", "North"])
    r = run(views=["Vert"], wide_views=["Vert"], **facts, escalate=reply("unclear", 0.4, None))
    assert (r.site_type, r.model, r.provider, r.escalation_reason) == ("other", "w", "secondary", "unclear_type")
    r = run(views=["Vert", "North"], wide_views=["Vert"], **facts)
    assert (r.site_type, r.classification_stage) == ("unclear", "primary")
    r = run(mode="naip_only", views=["Vert"], wide_views=["Vert"], **facts)
    assert (r.site_type, r.classification_stage, r.nearmap_tier) == ("unclear", "primary", "naip_only")


def test_zoom(run):
    base = {"naip": reply("unclear", 0.5, None, model="n")}
    assert run(**base, zoom=reply("other", 0.4, None, model="z")).model == "n"
    assert run(**base, zoom=reply("other", 0.6, None, model="z")).model == "z"
    assert run(**base, zoom=reply("tower", 0.1, None, model="z")).nearmap_tier == "zoom"
    stealth = run(label=" Stealth", image=True, **{"naip": SURE}, zoom=reply("unclear", 0.1, None, model="z"))
    assert (stealth.model, stealth.classification_stage) == ("z", "zoom")
    none = run(label="stealth", **{"naip": SURE}, zoom=reply("tower", 0.9, None), crops=0)
    assert (none.site_type, none.conf) == ("unclear", 0.0)
    # Without an image to crop there is no zoom: obliques alone are none.
    r = run(mode="full", image=False, views=["North"], **{"full": reply("unclear", 0.1, None, model="f")}, zoom=reply("tower", 0.9, None))
    assert (r.model, r.zoomed) == ("f", False)


def test_no_imagery(run):
    r = run(mode="full", image=False, **{"full": SURE})
    assert (r.site_type, r.conf, r.classification_stage, r.shown_views) == ("no_imagery", None, None, None)
    assert run(image=False, views=["Vert"], **{"naip": SURE}).site_type == "no_imagery"
    assert run(mode="full", image=False, views=["Vert"], **{"full": SURE}).site_type == "tower"


def test_location(run):
    """A box in the image's south-east quarter: its centre is 62.5 m east and 62.5 m south of the site on the map grid."""
    on = reply("tower", 9.0, True, box=[500.0, 500.0, 1000.0, 1000.0], view="NAIP top-down")
    r = run(project=True, image=True, views=["Vert"], lat=40.0, lon=-93.0, **{"naip": on})
    assert r.asset_offset_m == 88.4 and r.asset_box_2d == "[500.0, 500.0, 1000.0, 1000.0]"
    assert r.asset_lat == pytest.approx(40.0 - 62.5 / 0.9996 / 111_034.6, abs=2e-7) and r.asset_lon == pytest.approx(-93.0 + 62.5 / 0.9996 / 85_393.9, abs=5e-6)
    assert (r.site_confidence, r.view_count, r.chip_path, r.nearmap_views, r.nearmap_aoi_m, r.source_trust_mismatch) == (0.9, 1, "s_NAIP.jpg", None, None, False)
    middle = run(project=True, **{"naip": reply("tower", 0.9, True, box=[400.0, 400.0, 600.0, 600.0], view="NAIP top-down")}, lat=33.3, lon=-117.7)
    assert (middle.asset_lat, middle.asset_lon, middle.asset_offset_m) == (pytest.approx(33.3, abs=1e-8), pytest.approx(-117.7, abs=1e-8), 0.0)
    for box, view in (([500.0, 500.0, 1000.0, 1000.0], "Nearmap top-down"), ([600.0, 0.0, 500.0, 10.0], "NAIP top-down"), ([], "NAIP top-down"), ([1.0, 2.0, 3.0], "NAIP top-down"), (None, "NAIP top-down")):
        r = run(project=True, **{"naip": reply("tower", 0.9, True, box=box, view=view)})
        assert (r.asset_lat, r.asset_lon, r.asset_offset_m) == (None, None, None)
    wide = run(project=True, views=["Vert"], wide_views=["Vert", "North"], crops=4, trust="high", **{"naip": reply("unclear", 0.2, None), "vert": reply("other", 0.2, None), "wide": reply("other", 0.9, False)})
    assert (wide.nearmap_aoi_m, wide.nearmap_views, wide.view_count, wide.zoom_crops, wide.source_trust_mismatch, wide.escalation_model) == (250.0, "Vert,North", 3, None, True, None)


def test_log_to_rows(spark):
    """From text replies: the last attempt of a stage counts, failed requests give none."""
    text = lambda t, c: f'{{"site_type": "{t}", "site_confidence": {c}, "asset_box_2d": [1, 2, 3, 4], "asset_view": "NAIP top-down"}}'
    log = spark.createDataFrame([("1", "naip", 1, "m", text("other", 3)), ("1", "naip", 2, "m", text("tower", 85)), ("1", "vert", 1, "m", None), ("2", "naip", 3, "m", "no json")], "id string, stage string, attempt int, model string, raw string")
    got = {r.id: r for r in cascade.pivot_stages(cascade.from_log(log), list(STAGES)).collect()}
    assert (got["1"].naip.site_type, got["1"].naip.conf, got["1"].vert, got["1"].naip.box) == ("tower", 0.85, None, ["1", "2", "3", "4"])
    assert (got["2"].naip.site_type, got["2"].naip.conf) == ("unclear", 0.0)
    assert {(r.id, r.stage): r.attempts for r in cascade.attempts(log).collect()} == {("1", "naip"): 2, ("1", "vert"): 1, ("2", "naip"): 3}
    assert cascade.crop_counts(spark.createDataFrame([("1", 1), ("1", 3)], "id string, crop int").withColumn("box", F.lit(None))).first().zoom_crops == 2
