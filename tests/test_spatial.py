"""Joins by place: whole results on copies and on borders, and work that is spread whatever the input's files are."""

from math import asin, cos, radians, sin, sqrt
from random import Random

from pyspark.sql import functions as F

from siteloom.operators import imagery, intake


def tasks(df) -> int:
    """Partitions with rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_scenes_of_one_file_are_joined_by_many_tasks(spark):
    """Copies of sites and footprints, more of a box than a list holds; borders count; nulls don't."""
    spots = [(10.0, 20.0), (10.5, 20.5), (13.0, 23.0), (13.1, 20.0), (None, 20.0), (10.0, None)]
    boxes = [(10.0, 13.0, 20.0, 23.0), (9, 10, 19, 20), (12.9, 14.0, 19.0, 24.0), (None, 13.0, 20.0, 23.0), (13.0, 10.0, 20.0, 23.0)]
    sites = [(i, *spots[i % len(spots)]) for i in range(120)]
    scenes = [(j, f"s{j}", *map(lambda x: x if x is None else float(x), boxes[j % len(boxes)])) for j in range(60)]
    left = spark.createDataFrame(sites, "id long, lat double, lon double").coalesce(1)
    right = spark.createDataFrame(scenes, "item_ord long, item_id string, lat_min double, lat_max double, lon_min double, lon_max double").coalesce(1)
    want = sorted((i, lat, lon, *s) for i, lat, lon in sites for s in scenes if None not in (lat, lon, *s) and s[4] <= lon <= s[5] and s[2] <= lat <= s[3])
    for cell, most in ((1.0, 1024), (3.0, 5), (3.0, 1)):
        got = imagery.scenes_at(left, right, cell, most=most)
        assert got.columns == left.columns + right.columns and sorted(map(tuple, got.collect())) == want
    assert tasks(imagery.scenes_at(left, right, 3.0)) > 1


def metres_of(a, b) -> float:
    (p, l), (q, m) = (map(radians, x) for x in (a, b))
    return 2 * 6371008.8 * asin(sqrt(min(1.0, sin((q - p) / 2) ** 2 + cos(p) * cos(q) * sin((m - l) / 2) ** 2)))


def scattered() -> list[tuple]:
    """Places in both hemispheres and far north, with copies of them, unknown places and a repeated key."""
    r = Random(7)
    at = [(r.uniform(-1, 1), r.uniform(-1, 1)) for _ in range(150)] + [(r.uniform(88.0, 89.5), r.uniform(0, 30)) for _ in range(40)] + [(r.uniform(-61, -60), r.uniform(-1, 1)) for _ in range(60)]
    rows = [(i, *at[r.randrange(len(at))]) for i in range(400)] + [(400, None, 1.0), (401, 1.0, None), (7, 0.5, 0.5), (7, -60.5, 0.0)]
    return r.sample(rows, len(rows))


def test_pairs_of_one_file_are_made_by_many_tasks(spark):
    rows = scattered()
    points = spark.createDataFrame(rows, "id long, lat double, lon double").coalesce(1)
    for metres in (9_000.0, 60_000.0):
        want = sorted((a[0], b[0], round(metres_of(a[1:], b[1:]), 1)) for a in rows for b in rows if a[0] < b[0] and None not in (*a, *b) and metres_of(a[1:], b[1:]) <= metres)
        for most in (1024, 2):
            assert sorted(map(tuple, intake.near_pairs(points, metres, most=most).collect())) == want
    assert tasks(intake.near_pairs(points, 60_000.0)) > 1


def joined(df) -> int:
    """Rows that the joins of a plan gave when it ran."""
    df.collect()

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        kids = node.children()
        own = node.metrics().apply("numOutputRows").value() if "Join" in name else 0
        return own + sum(walk(kids.apply(i)) for i in range(kids.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_dedup_lists_no_pairs(spark):
    """A crowd: 2000 points within one distance are two million pairs."""
    r = Random(3)
    points = spark.createDataFrame([(i, r.uniform(40.0, 40.001), r.uniform(-90.0, -89.999)) for i in range(2000)], "id long, lat double, lon double")
    out = intake.radius_dedup(points, 500.0)
    assert [x.id for x in out.collect()] == [0] and joined(out) < 20_000


def test_dedup_is_that_of_all_pairs(spark):
    """A point that goes takes others with it all the same; of a repeated key each row is judged alone."""
    rows = scattered()
    points = spark.createDataFrame(rows, "id long, lat double, lon double")
    for metres in (9_000.0, 60_000.0, 5_000_000.0):
        want = sorted((a for a in rows if None in a or not any(b[0] < a[0] and None not in b and metres_of(a[1:], b[1:]) <= metres for b in rows)), key=str)
        assert sorted(map(tuple, intake.radius_dedup(points, metres).collect()), key=str) == want
