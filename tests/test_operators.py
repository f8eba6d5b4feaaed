"""Small cases with known answers."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lodestone.operators import asof, checks, hist, intervals, lineage, ranges, relval, resources


def test_axes_empty_and_nan(spark):
    h = lambda rows: spark.createDataFrame(rows, "object string, bins int, lo double, hi double, bin int, content double, sumw2 double")
    step = [("step", 10, 0.0, 10.0, i + 1, float(i), float(i)) for i in range(10)]
    a = h(step + [("axis", 10, 0.0, 10.0, 1, 1.0, 1.0), ("empty", 10, 0.0, 10.0, 1, 0.0, 0.0), ("over", 10, 0.0, 10.0, 11, 5.0, 5.0), ("nan", 10, 0.0, 10.0, 1, math.nan, 1.0)])
    b = h(step + [("axis", 5, 0.0, 10.0, 1, 1.0, 1.0), ("empty", 10, 0.0, 10.0, 1, 3.0, 3.0), ("over", 10, 0.0, 10.0, 11, 5.0, 5.0), ("nan", 10, 0.0, 10.0, 1, 2.0, 2.0), ("extra", 1, 0.0, 1.0, 1, 1.0, 1.0)])
    t = {r["object"]: r for r in hist.identical(hist.comparable(hist.totals(hist.pair(a, b)))).collect()}
    assert {k: v["code"] for k, v in t.items() if k != "extra"} == {"step": "ok", "axis": "axes", "empty": "empty", "over": "empty", "nan": "not_finite"}
    assert t["step"]["identical"] and not t["empty"]["identical"]
    m = {(r["object"], r["metric"]): r for r in hist.compare(a, b).collect()}
    assert m["step", "test_chi2"]["value"] == 0 and m["step", "test_kolmogorov"]["value"] == 1 and m["step", "test_num_entries"]["value"] == 0
    assert not m["nan", "test_chi2"]["comparable"] and ("extra", "test_chi2") not in m
    v = {(r["object"], r["metric"]): r["verdict"] for r in relval.interpret(relval.test(hist.compare(a, b), relval.default_limits(hist.compare(a, b)))).collect()}
    assert v["step", "test_chi2"] == "GOOD" and v["nan", "test_chi2"] == "CRIT_NC"


def test_registered_metric(spark):
    a = hist.fill(spark.range(10).select(F.lit("o").alias("object"), F.col("id").cast("double").alias("x")), spark.createDataFrame([("o", 5, 0.0, 10.0)], "object string, bins int, lo double, hi double"))
    hist.register_metric("total", lambda p, t, key: t.select(*key, (F.col("sum_a") + F.col("sum_b")).alias("value")), 1.0, True)
    try:
        assert hist.compare(a, a, ["total"]).first()["value"] == 20
    finally:
        hist.unregister_metric("total")
    assert "total" not in hist.metrics()


def test_objects_without_comparable_values(spark):
    rows = [("a", "m", 2.0, True, 1.0, True, None), ("a", "m", 4.0, True, 1.0, True, None), ("b", "m", None, False, 1.0, True, "empty"), ("c", "m", -2.0, True, -1.0, True, None)]
    m = spark.createDataFrame(rows, "object string, metric string, value double, comparable boolean, threshold double, lower_is_better boolean, note string")
    user = {r["object"]: (r["mean"], r["low"], r["high"]) for r in relval.user_limits(m, "mean", 0.1).collect()}
    assert user["a"] == (3.0, None, 3.0 * 0.1) and user["b"] == (None, None, None) and user["c"] == (-2.0, None, -2.0 * 0.1)
    assert {r["object"]: r["mean"] for r in relval.user_limits(m, "extreme").collect()} == {"a": 4.0, "b": None, "c": -2.0}
    regions = relval.region_limits(m)
    assert {r["object"] for r in regions.collect()} == {"a", "b", "c"}
    for limits in (relval.user_limits(m), regions):
        verdicts = [r["verdict"] for r in relval.interpret(relval.test(m, limits)).where("object = 'b'").collect()]
        assert verdicts and set(verdicts) == {"CRIT_NC"}
    own = relval.interpret(relval.test(m, relval.user_limits(m)), function=lambda r: F.when(r["value"] > 3, "HIGH").otherwise("LOW"))
    assert relval.query(own, lambda r: r["verdict"] == "HIGH").count() == 1
    assert relval.patterns_in(["# all", "^a  # first", "", "b$"]) == ["^a", "b$"]


def test_nearest_rules(spark):
    table = spark.createDataFrame([(10, "a", 1), (20, "b", 2), (20, "c", 3)], "t long, v string, n int")
    q = spark.createDataFrame([(0,), (10,), (15,), (14,), (99,)], "t long")
    got = {r["t"]: r["nearest"] for r in asof.nearest(q, table, "t", "v", order="n").collect()}
    assert got == {0: "a", 10: "a", 15: "c", 14: "a", 99: "c"}
    keyed = asof.nearest(q.withColumn("k", F.lit(1)), table.withColumn("k", F.lit(2)), "t", "v", ["k"])
    assert {r["nearest"] for r in keyed.collect()} == {None}
    own = asof.nearest(table.select("t", F.col("n").alias("m")), table, "t", "n", order="n")
    assert own.where("nearest < m").count() == 0


def test_windows_tail(spark):
    lab = lambda hi: spark.createDataFrame([("r", 0, 10), ("r", 5, hi)], "run string, lo long, hi long")
    rows = lambda hi: [(r["ws"], r["we"], r["margin"]) for r in intervals.plan_windows(lab(hi), 100, 20).orderBy("window").collect()]
    assert rows(249) == [(0, 99, 9), (100, 249, 14)]
    assert rows(250) == [(0, 99, 9), (100, 199, 9), (200, 250, 5)]
    assert rows(60) == [(0, 60, 6)]


def test_merge_order(spark):
    s = spark.createDataFrame([("t", "m", 2, 1.0, 3.0, 2.0, 1.0), ("t", "m", 3, 0.0, 9.0, 5.0, 2.0), ("t", "m", 1, 4.0, 4.0, 4.0, 0.0)], "name string, metric string, count long, min double, max double, mean double, std double")
    whole = resources.merge_stats(s, mode="full").first()
    first = resources.merge_stats(s.where("count > 1"), mode="full").select("name", "metric", "count", "min", "max", "mean", "std")
    twice = resources.merge_stats(first.unionByName(s.where("count = 1")), mode="full").first()
    for c in ("count", "min", "max", "mean", "std"):
        assert math.isclose(whole[c], twice[c], rel_tol=1e-12)


def test_deep_chain_has_levels(spark):
    n = spark.createDataFrame([(k,) for k in range(24)], "name int")
    e = spark.createDataFrame([(k + 1, k) for k in range(23)], "name int, need int")
    assert {r["name"]: r["level"] for r in lineage.levels(n, e).collect()} == {k: k for k in range(24)}


@pytest.mark.parametrize("task_rows", [0, 1 << 40])
def test_nearest_of_one_hot_key(spark, monkeypatch, task_rows):
    """One key's rows in one task or over many ranges, against the rule on a sorted list."""
    import bisect
    import random

    monkeypatch.setattr(ranges, "TASK_ROWS", task_rows)
    rng = random.Random(1)
    table = sorted({rng.randint(0, 4000) for _ in range(300)})
    queries = [rng.randint(-100, 4100) for _ in range(700)]
    left = spark.createDataFrame([(k, q, 1) for k, q in enumerate(queries)] + [(-1, None, 1), (-2, 5, None)], "n int, t int, k int")
    right = spark.createDataFrame([(x, x, 1) for x in table] + [(9, 9, 2)], "t int, v int, k int")
    got = {r["n"]: r["nearest"] for r in asof.nearest(left.repartition(7), right, "t", "v", ["k"]).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None
    for k, q in enumerate(queries):
        i = bisect.bisect_left(table, q)
        up, down = table[i] if i < len(table) else None, table[i - 1] if i else None
        assert got[k] == (down if up is None or (down is not None and q - down < up - q) else up)


@pytest.mark.parametrize("task_rows", [0, 1 << 40])
def test_numbers_and_neighbours_by_ranges(spark, monkeypatch, task_rows):
    monkeypatch.setattr(ranges, "TASK_ROWS", task_rows)
    import random

    rng = random.Random(2)
    values = [rng.choice((None, -1, rng.randint(0, 50))) for _ in range(400)]
    d = spark.createDataFrame([(k % 3 if k % 5 else None, k, v) for k, v in enumerate(values)], "p int, k int, v int").repartition(5)
    got = {(r["p"], r["k"]): (r["n"], r["_prev"], r["_top"]) for r in ranges.with_previous(ranges.numbered(d, ["p"], ["k"], "n"), ["p"], "k", "v", top=F.when(F.col("v") >= 0, F.col("v"))).collect()}
    for p in (None, 0, 1, 2):
        own = [k for k in range(400) if (k % 3 if k % 5 else None) == p]
        for n, k in enumerate(own):
            before = [values[i] for i in own[:n]]
            assert got[p, k] == (n, before[-1] if before else None, max((v for v in before if v is not None and v >= 0), default=None))
    m = checks.monotonic(d.where("p = 1"), "k", "v", ["p"]).first()
    one = [values[k] for k in range(400) if k % 5 and k % 3 == 1]
    assert m["violations"] == sum(a is not None and b is not None and b <= a for a, b in zip(one, one[1:], strict=False)) and m["rows"] == len(one)


def test_sliding_at_stored_points(spark):
    """Of equal x the last counts, and a query gets the statistics of its nearest point."""
    d = spark.createDataFrame([(0, 1.0, 1), (1, 9.0, 2), (1, 3.0, 3), (2, 5.0, 4), (50, 7.0, 5), (None, 1.0, 6)], "x int, y double, n int")
    own = {r["n"]: (r["mean"], r["std"], r["median"]) for r in asof.sliding(d, "x", "y", 1, stats=("mean", "std", "median"), order="n").collect()}
    assert own[1] == (2.0, math.sqrt(2), 3.0) and own[2] == own[3] == (3.0, 2.0, 3.0) and own[4] == (4.0, math.sqrt(2), 5.0) and own[5] == (7.0, None, 7.0) and own[6] == (None,) * 3
    q = spark.createDataFrame([(-9,), (26,), (25,)], "x int")
    assert {r["x"]: r["mean"] for r in asof.sliding(d, "x", "y", 1, order="n", query=q).collect()} == {-9: 2.0, 25: 4.0, 26: 7.0}


def test_cycle_has_no_level(spark):
    n = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    e = spark.createDataFrame([("b", "a"), ("c", "d"), ("d", "c")], "name string, need string")
    assert {r["name"]: r["level"] for r in lineage.levels(n, e).collect()} == {"a": 0, "b": 1, "c": None, "d": None}
