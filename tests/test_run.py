"""A whole run from files to reports, its resumption, and the connectors that fill the logs."""

import csv
import json
from pathlib import Path
from xml.etree import ElementTree
from zipfile import ZipFile

import pytest
from pyspark.sql import functions as F

from siteloom import config, run
from siteloom.functions import services
from siteloom.operators import imagery, intake, reports
from siteloom.sources import connectors, sites, workbook


def text(site_type, conf, cell=True, box=None, view=None):
    return json.dumps({"site_type": site_type, "site_confidence": conf, "cell_equipment": cell, "asset_box_2d": box, "asset_view": view, "site_evidence": "seen"})


def rows_of(folder):
    return [r for p in sorted(Path(folder).glob("part-*.csv")) for r in csv.DictReader(p.open(encoding="utf-8"))]


def test_run(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("NEARMAP_TIERED", " Yes ")
    monkeypatch.setenv("BIFURCATED_AI", "0")
    assert config.flag("NEARMAP_TIERED") and not config.flag("BIFURCATED_AI", True) and config.flag("NO_SUCH_SWITCH", True)
    source = tmp_path / "WI_assets.csv"
    source.write_text('id,lat,lon,address,label,input_confidence\n1,40.5,-90,,plain,high\n2,,,"1 Main St,\nTown",stealth,\n3,,,Nowhere,plain,low\n4,41,-91,,plain,\n5,42,-92,,plain,\n')
    logs = tmp_path / "logs"

    def log(name, rows):
        spark.createDataFrame(rows, run._LOGS[name]).write.mode("overwrite").parquet(f"{logs}/{name}.parquet")

    log("geocodes", [("1 Main St,\nTown", "census", 40.0, -93.0, "MAIN", "census_match", None), ("Nowhere", "nominatim", None, None, None, None, "timeout")])
    day = __import__("datetime").datetime(2022, 5, 1)
    log("scenes", [("1", day, 0), ("2", day, 0), ("5", day, 0)])
    log("tiles", [("1", "Vert", 200), ("1", "North", 404)])
    log("coverage", [("1", "2024-01-02", 0, None)])
    log("replies", [
        ("1", "naip", 1, "m", text("unclear", 3), None), ("1", "vert", 1, "m", text("tower", 85), None), ("2", "naip", 1, "m", text("other", 0.9), None),
        ("2", "zoom", 1, "m", text("rooftop", 0.7, box=[0, 0, 1000, 1000], view="NAIP top-down"), None), ("5", "naip", 2, "m", None, "overloaded"),
    ])
    log("scans", [("2", json.dumps({"candidates": [{"box_2d": [0, 0, 300, 300], "reason": "roof"}, {"box_2d": [0, 0, 5, 5], "reason": "small"}]}))])
    log("chips", [("2_zoom_3.jpg",), ("2_zoom_1.jpg",), ("1_nearmap_vert.jpg",)])
    folder = run.run(spark, str(source), str(logs), str(tmp_path / "runs"))
    assert folder.name.endswith("_WI") and (folder / "chips").is_dir() and (folder / "WI_assets.csv").exists()
    got = {r["id"]: r for r in rows_of(folder / "WI_results_detail.csv")}
    assert (got["1"]["site_type"], got["1"]["nearmap_tier"], got["1"]["nearmap_date"], got["1"]["image_date"], got["1"]["site_confidence"]) == ("tower", "vert_only", "2024-01-02", "2022-05-01", "0.85")
    assert (got["2"]["site_type"], got["2"]["classification_stage"], got["2"]["zoom_crops"], got["2"]["asset_offset_m"], got["2"]["geocode_source"]) == ("rooftop", "zoom", "3", "0.0", "census")
    assert got["3"]["error"] == "census: no match; nominatim: timeout" and got["4"]["site_type"] == "no_imagery" and got["5"]["error"] == "overloaded"
    shown = {r["Asset"]: r for r in rows_of(folder / "WI_results.csv")}
    assert shown["2 (stealth)"]["Review image"] == "2_zoom_1.jpg" and shown["1 (plain)"]["Review image"] == "1_nearmap_vert.jpg"
    assert (shown["4 (plain)"]["Conf"], shown["1 (plain)"]["Conf"], shown["2 (stealth)"]["Located"]) == ("—", "0.85", "0 m off")
    with ZipFile(folder / "WI_results.xlsx") as z:
        assert "2 (stealth)" in z.read("xl/worksheets/sheet1.xml").decode()
    summary = (folder / "WI_EXECUTIVE_SUMMARY.md").read_text()
    assert "**Assets evaluated:** 5" in summary and "**Errors:** 2" in summary and "| 4 | plain | No imagery |" in summary and "## Known limitations" in summary
    # Going on: only what failed is done again.
    log("replies", [("5", "naip", 3, "m", text("tower", 0.9), None)])
    run.run(spark, str(source), str(logs), run_dir=str(folder))
    again = {r["id"]: r for r in rows_of(folder / "WI_results_detail.csv")}
    assert len(again) == 5 and again["5"]["site_type"] == "tower" and again["1"]["site_type"] == "tower" and again["3"]["error"]
    run.run(spark, str(source), run_dir=str(folder), regenerate=True)
    assert len(rows_of(folder / "WI_results_detail.csv")) == 5
    back = sites.read_results(spark, f"{folder}/WI_results_detail.csv")
    assert back.where("id = '1'").first().site_confidence == 0.85 and dict(back.dtypes)["view_count"] == "int"
    with pytest.raises(SystemExit):
        run.run(spark, str(source), regenerate=True)
    with pytest.raises(FileNotFoundError):
        run.run(spark, str(source), run_dir=str(tmp_path / "none"))


def test_answers_of_services(spark):
    census = json.dumps({"result": {"addressMatches": [{"matchedAddress": "A", "coordinates": {"x": -90.5, "y": 40.5}}, {"matchedAddress": "B", "coordinates": {"x": 1, "y": 2}}]}})
    osm = lambda kind: json.dumps([{"lat": "40.5", "lon": "-90.5", "display_name": "D", "type": kind, "class": "building"}])
    df = spark.createDataFrame([(1, census, osm("tower")), (2, '{"result": {"addressMatches": []}}', osm("")), (3, "broken", "[]"), (4, None, None)], "n int, c string, o string")
    got = {r.n: r for r in df.select("n", services.census(F.col("c")).alias("c"), services.nominatim(F.col("o")).alias("o")).collect()}
    assert tuple(got[1].c) == ("census", 40.5, -90.5, "A", "census_match", None) and tuple(got[1].o) == ("nominatim", 40.5, -90.5, "D", "tower", None)
    assert got[2].c.error == "no match" and got[2].o.quality == "building" and got[3].c.lat is None and got[3].o.error == got[4].o.error == "no match"
    stac = json.dumps({"features": [{"id": "a", "properties": {"datetime": "2022-01-01T00:00:00Z"}, "assets": {"image": {"href": "h"}}}, {"id": "b"}]})
    r = spark.createDataFrame([(stac, '{"surveys": [{"captureDate": "2024-01-02"}, {"captureDate": "2020-01-01"}]}'), ("x", "{}")], "s string, d string").select(services.scenes(F.col("s")).alias("s"), services.capture_date(F.col("d")).alias("d")).collect()
    assert [(x.item_ord, x.item_id, x.href) for x in r[0].s] == [(0, "a", "h"), (1, "b", None)] and (r[0].d, r[1].s, r[1].d) == ("2024-01-02", None, None)
    assert services.nominatim_parameters("x")["limit"] == services.coverage_parameters()["limit"] == 1 and services.census_parameters("x")["address"] == "x"
    assert services.stac_parameters(1.0, 2.0)["intersects"]["coordinates"] == [2.0, 1.0]


def test_tiles(spark):
    waits = []
    answers = iter([(429, None), (503, None), (200, b"x"), (502, None), (503, None), (429, None), (404, b"no")])
    get = lambda url: next(answers)
    assert connectors.tile(get, "u", sleep=waits.append) == (200, b"x") and waits == [2.0, 4.0]
    assert connectors.tile(get, "u", sleep=waits.append) == (429, None) and connectors.tile(get, "u") == (404, None)

    def make():
        def get(url):
            if "/9/" in url:
                raise OSError("no route")
            return (200, b"jpg") if "/Vert/" in url else (404, None)

        return get

    plan = spark.createDataFrame([("1", "Vert", 21, 1, 2), ("1", "North", 20, 1, 2), ("2", "Vert", 21, 9, 2)], "id string, view string, z int, x int, y int")
    got = connectors.tiles(plan, make, "t/{view}/{z}/{x}/{y}")
    assert {(r.id, r.view): (r.status, r.data) for r in got.collect()} == {("1", "Vert"): (200, b"jpg"), ("1", "North"): (404, None), ("2", "Vert"): (0, None)}
    assert [(r.id, r.views) for r in imagery.arrived_views(got).collect()] == [("1", ["Vert"])]
    assert connectors.dispatch("wide_escalate_recheck") == {"provider": "secondary", "prompt": "equipment", "tool": "classify_site", "schema": "REPLY"}
    assert connectors.dispatch("scan")["tool"] == "scan_candidates" and connectors.dispatch("zoom")["prompt"] == "zoom"


def test_requests_are_paced(spark):
    import time

    def make():
        return lambda request, model: str(time.monotonic())

    asked = spark.createDataFrame([(str(i), "naip", "p") for i in range(3)], "id string, stage string, payload string").coalesce(1)
    at = sorted(float(r.raw) for r in connectors.call(asked, make, ["m"], pace=0.2).collect())
    assert at[1] - at[0] >= 0.19 and at[2] - at[1] >= 0.19


def test_request_blocks(spark):
    df = spark.createDataFrame([(["NAIP top-down", "Nearmap top-down"], [b"a", b"bc"], "what?"), ([], [], "what?")], "l array<string>, i array<binary>, p string")
    got = [r.b for r in df.select(imagery.request_blocks(F.col("l"), F.col("i"), F.col("p")).alias("b")).collect()]
    assert [tuple(x) for x in got[0]] == [("text", "View: NAIP top-down", None), ("image", None, "YQ=="), ("text", "View: Nearmap top-down", None), ("image", None, "YmM="), ("text", "what?", None)]
    assert [tuple(x) for x in got[1]] == [("text", "what?", None)]
    one = spark.createDataFrame([(["a", "b"], ["z1", "z2"], ["Vert"], ["Vert", "North"])], "c array<string>, z array<string>, h array<string>, m array<string>")
    r = one.select(imagery.zoom_request(F.col("c"), F.col("z")).alias("z"), imagery.merge_views(F.col("h"), F.col("m")).alias("v")).first()
    assert r.z == ["a", "z1", "z2"] and r.v == ["Vert", "North"]


def test_regenerate_fixes_both_confidences(spark):
    df = spark.createDataFrame([("1", 85.0, 0.5), ("2", 0.5, 7.0), ("3", 0.5, None)], "id string, site_confidence double, cell_equipment_confidence double")
    assert {r.id: (r.changed, r.site_confidence, r.cell_equipment_confidence) for r in reports.regenerate(df).collect()} == {"1": (True, 0.85, 0.5), "2": (True, 0.5, 0.7), "3": (False, 0.5, None)}


def test_review_images(spark):
    """The branches in order: equipment with an oblique, an oblique that is shown, vertical, the saved chip, crops in order of their names."""
    rows = [("1", True, "Vert,East", "", None, []), ("2", False, "", "Nearmap oblique (South)", None, []), ("3", None, "", "Nearmap top-down", None, []), ("4", None, None, None, "kept.jpg", []), ("5", None, None, None, " ", ["5_zoom_2.jpg", "5_zoom_10.jpg"]), ("6", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, cell_equipment boolean, nearmap_views string, asset_view string, chip_path string, zoom_paths array<string>")
    chips = spark.createDataFrame([(x,) for x in ("1_nearmap_east.jpg", "1_nearmap_vert.jpg", "2_nearmap_south.jpg", "3_nearmap_vert.jpg", "3_NAIP.jpg", "kept.jpg", "4_NAIP.jpg", "5_zoom_2.jpg", "5_zoom_10.jpg")], "path string")
    got = {r.id: r.review_image for r in reports.review_images(df, chips).collect()}
    assert got == {"1": "1_nearmap_east.jpg", "2": "2_nearmap_south.jpg", "3": "3_nearmap_vert.jpg", "4": "kept.jpg", "5": "5_zoom_10.jpg", "6": None}


def test_near_points(spark):
    points = spark.createDataFrame([(1, 40.0, -90.0), (2, 40.0003, -90.0), (3, 40.0, -90.002), (4, None, -90.0), (5, 89.9, 10.0), (6, 89.9, 10.01)], "id long, lat double, lon double")
    assert [(r.a, r.b, r.metres) for r in intake.near_pairs(points, 50.0).orderBy("a").collect()] == [(1, 2, 33.4), (5, 6, 1.9)]
    assert sorted(r.id for r in intake.radius_dedup(points, 50.0).collect()) == [1, 3, 4, 5]


def test_names_and_folders(spark, tmp_path):
    assert sites.input_of(str(tmp_path), "x/y.csv") == "x/y.csv"
    (tmp_path / "y.csv").write_text("id\n1\n")
    assert sites.input_of(str(tmp_path), "x/y.csv") == str(tmp_path / "y.csv")
    assert sites.run_folder(str(tmp_path), "p", str(tmp_path)) == tmp_path and (sites.minutes(0), sites.minutes(674)) == (1, 236)


def test_workbook(tmp_path):
    """Every part is XML, each relation leads to a part, rows are whole over several sheets, images keep their sides' ratio."""
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\xf0\x01\xe0\x01\x01\x11\x00\xff\xd9"
    (tmp_path / "a.jpg").write_bytes(jpeg)
    assert workbook.jpeg_size(jpeg) == (480, 240) and workbook.fitted(480, 240) == (160, 80) and workbook.fitted(10, 20) == (10, 20) and workbook.jpeg_size(b"no") is None
    rows = [(f"s{i} <&>", "tower", 0.5 if i else "—", "—", None, i, "a.jpg" if i % 2 else "none.jpg") for i in range(5)]
    path = workbook.write(str(tmp_path / "x.xlsx"), rows, tmp_path, sheet_rows=4)
    with ZipFile(path) as z:
        for name in z.namelist():
            if name.endswith((".xml", ".rels")):
                ElementTree.fromstring(z.read(name))
            if name.endswith(".rels"):
                base = Path("/" + name).parent.parent
                for r in ElementTree.fromstring(z.read(name)):
                    assert str((base / r.get("Target")).resolve())[1:] in z.namelist()
        cells = [[t.text for t in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{k}.xml")).iter("{http://schemas.openxmlformats.org/spreadsheetml/2006/main}t")] for k in (1, 2)]
        assert [sum(t.startswith("s") for t in c) for c in cells] == [3, 2] and cells[0][:7] == list(workbook.HEADERS) and "s1 <&>" in cells[0]
        assert sum(n.startswith("xl/media/") for n in z.namelist()) == 2
    assert workbook.write(str(tmp_path / "empty.xlsx"), []).endswith("empty.xlsx")
