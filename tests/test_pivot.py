from siteloom.operators import cascade


def test_a_reply_is_handled_once_whatever_the_stages(spark):
    """Of a stage the last attempt; other stages and replies without a number count for none, but their site has a row; one aggregate for all."""
    kinds = "site_type string, conf double, cell boolean, cell_conf double, cell_evidence string, evidence string, box array<double>, view string, model string"
    rest = (0.5, None, None, None, None, [1.0, 2.0], None, "m")
    rows = [(1, "a", 1, "old", *rest), (1, "a", 10, None, *rest), (1, "a", 2, "mid", *rest), (1, "b", 3, "b3", *rest), (2, "z", 1, "none", *rest), (3, "a", None, "none", *rest), (3, "b", 1, "b1", *rest), (4, None, 1, "none", *rest)]
    wide = cascade.pivot_stages(spark.createDataFrame(rows, f"id long, stage string, attempt int, {kinds}"), ["a", "b", "c"])
    got = {r.id: tuple(x and (x.site_type, x.box) for x in (r.a, r.b, r.c)) for r in wide.collect()}
    box = [1.0, 2.0]
    assert wide.columns == ["id", "a", "b", "c"]
    assert got == {1: ((None, box), ("b3", box), None), 2: (None, None, None), 3: (None, ("b1", box), None), 4: (None, None, None)}
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "max_by" not in plan
