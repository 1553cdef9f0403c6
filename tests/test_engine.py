import math

import pytest
from pyspark.sql import functions as F

from siteloom.functions import geo, replies, scalars
from siteloom.operators import imagery, intake, reports
from siteloom.sources import connectors, sites
from siteloom.streaming import commit


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("value", "wanted"), [("8", 0.8), ("85", 0.85), ("250", 1.0), ("-1", 0.0), ("abc", None), ("nan", None), ("0.4", 0.4), ("", None)])
def test_confidence_of_text(spark, value, wanted):
    got = one(spark, scalars.confidence(F.col("v")), v=value)
    assert got == wanted or math.isclose(got, wanted)


def test_replies(spark):
    text = 'Here: {"site_type": "tower", "site_confidence": "8", "asset_box_2d": [1, 2.5, 3, 4]} bye'
    df = spark.createDataFrame([(text,), ("no object",), ('{"site_type": "tow',), (None,), ("",)], "t string")
    got = df.select(*[x.alias(n) for n, x in replies.reply(F.col("t")).items()]).collect()
    assert (got[0].site_type, got[0].site_confidence, got[0].asset_box_2d) == ("tower", 0.8, ["1", "2.5", "3", "4"])
    assert all(r.site_type == "unclear" and r.site_confidence == 0 for r in got[1:])
    assert got[1].site_evidence == "unparseable model reply: no object"


def test_boxes(spark):
    def box(*values):
        return F.array(*[F.lit(float(v)) for v in values])

    assert one(spark, geo.box_offset(box(0, 0, 1000, 1000))) == 0
    assert one(spark, geo.box_offset(box(600, 0, 500, 10))) is None
    assert one(spark, geo.box_offset(box(1, 2, 3))) is None
    assert one(spark, geo.valid_box(box(0, 0, 99, 500))) is None
    assert one(spark, geo.valid_box(box(0, 0, 100.7, 500))) == [0, 0, 100, 500]
    assert geo.grid_boxes()[-1] == [666, 666, 1000, 1000]


def test_candidates_keep_numbers_and_drop_repeats(spark):
    boxes = [([350.0, 350.0, 650.0, 650.0], "again"), ([0.0, 0.0, 50.0, 50.0], "small"), ([0.0, 0.0, 200.0, 200.0], "a\nb"), ([1.0, 1.0, 300.0, 300.0], "")]
    df = spark.createDataFrame([("a", False, boxes)], "id string, forced boolean, candidates array<struct<box: array<double>, reason: string>>")
    got = [(r.crop, r.crop_label) for r in imagery.zoom_candidates(df).orderBy("crop").collect()]
    assert got == [(1, "anchor"), (2, "anchor"), (5, "a b"), (6, "candidate")]


def test_intake(spark, tmp_path):
    (tmp_path / "x_assets.csv").write_text('id,lat,lon,address,label\n1,40.5,-90,,a\n2,,,"1 Main St, Town",b\n3,,, ,c\n')
    df = sites.read_sites(spark, f"file://{tmp_path}/x_assets.csv")
    assert [r.address for r in df.orderBy("id").collect()] == [None, "1 Main St, Town", None]
    assert [r.id for r in intake.invalid(df).collect()] == ["3"]
    with pytest.raises(ValueError, match="3"):
        intake.validate(df)
    with pytest.raises(ValueError, match="column id"):
        intake.require_columns(df.drop("id"))
    assert sites.names("x_assets.csv").detail == "x_results_detail.csv" and sites.names("x.csv").report is None
    assert sites.read_results(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        sites.read_results(spark, str(tmp_path / "none"), required=True)


def test_attempts():
    asked = []

    def client(fails):
        def go(request, model):
            asked.append(model)
            if fails:
                raise connectors.Failure(fails.pop(0))
            return "ok"

        return go

    wait = lambda s: None
    assert connectors.attempt(client([404]), {}, ["a", "b"], sleep=wait)["model"] == "b"
    assert connectors.attempt(client([500, 503]), {}, ["a", "b"], sleep=wait)["model"] == "a"
    assert connectors.attempt(client([429] * 3), {}, ["a", "b"], sleep=wait)["at"] == 1
    assert connectors.attempt(client([500] * 3), {}, ["a", "b"], sleep=wait)["error"] == "500"
    with pytest.raises(connectors.Failure):
        connectors.attempt(client([404]), {}, ["a"], sleep=wait)


def test_calls_isolate_errors(spark):
    def make():
        def go(request, model):
            if request["payload"] == "bad":
                raise RuntimeError("broken")
            return "{}"

        return go

    asked = spark.createDataFrame([("1", "naip", "good"), ("2", "naip", "bad")], "id string, stage string, payload string")
    got = {r.id: r for r in connectors.call(asked, make, ["m"]).collect()}
    assert got["1"].raw == "{}" and got["2"].error == "RuntimeError: broken"
    log = spark.createDataFrame([("1", "naip", "m", 1, "a", None), ("1", "naip", "m", 2, "b", None)], "id string, stage string, model string, attempt int, raw string, error string")
    got = {r.id: r for r in connectors.replay(asked, log).collect()}
    assert got["1"].raw == "b" and got["2"].error == "no logged reply"


def test_stream_commits_each_batch_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    head = "id,lat,lon,address,label,input_confidence\n"
    (inbox / "a.csv").write_text(head + "1,40,-90,,x,high\n")

    def go():
        commit.commit(commit.site_stream(spark, str(inbox)), lambda b: b.select("id", scalars.trust(F.col("input_confidence")).alias("trust")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    go()
    (inbox / "b.csv").write_text(head + "2,41,-91,,x,odd\n")
    go()
    assert sorted((r.id, r.trust) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("1", "high"), ("2", "medium")]


def test_summary_text(spark):
    row = spark.createDataFrame([], sites.RESULTS)
    text = reports.markdown(reports.kpis(row).first().asDict(), [], "today")
    assert "**Assets evaluated:** 0" in text and "*Generated: today*" in text and text.count("\n## ") == 7
