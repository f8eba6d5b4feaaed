"""Interval operators against brute force, with lengths from nothing to everything."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import intervals as I
from lodestone.operators import ranges


def mixed(rng, n, top=2_000):
    out = [(rng.choice(["a", "b", None]), lo := rng.randrange(-top, top), lo + rng.choice([-1, 0, 0, 1, 7, 8, 63, 64, 500]), i) for i in range(n)]
    return [*out, ("a", -(10**12), 10**15, n), ("b", -5, 5, n + 1)]


@pytest.fixture(params=[None, 50])
def cut(request, monkeypatch):
    """Once with parts that a task sorts whole, once with parts dealt by ranges."""
    if request.param:
        monkeypatch.setattr(ranges, "TASK_ROWS", request.param)


@pytest.mark.parametrize("inclusive", [True, False])
def test_overlap(spark, inclusive):
    rng = random.Random(7)
    a, b = mixed(rng, 150), mixed(rng, 120)
    got = I.overlap(spark.createDataFrame(a, "run string, lo long, hi long, i long"), spark.createDataFrame([(r, x, y, j, j % 5) for r, x, y, j in b], "run string, ws long, we long, j long, m long"), ["run"], "m", inclusive)
    want = sorted((i, j) for r, lo, hi, i in a for q, x, y, j in b if r == q and r is not None and lo <= hi and x <= y and hi >= x and lo <= y and (inclusive or min(hi, y) - max(lo, x) > j % 5))
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want and len(want) > 150


def test_rows_of_an_interval_do_not_grow_with_its_length(spark):
    df = spark.createDataFrame([(-(2**40), 2**61, 0), (0, 0, 1), (7, 8, 2), (-1, 0, 3), (0, 525_600 * 60, 4)], "lo long, hi long, i long")
    assert {r["i"]: r["count"] for r in I._kept(df, "lo", "hi").groupBy("i").count().collect()} == {0: 2, 1: 1, 2: 2, 3: 2, 4: 1}
    assert I._probing(df.where("i = 2"), "lo", "hi", [3, 9, 63], True).count() == 4


def test_merged_points_and_skim(spark, cut):
    rng = random.Random(9)
    a = mixed(rng, 60)[:-2] + [("b", 900, 10**9, 99)]
    points = [(rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(-2_100, 2_700)]), i) for i in range(600)] + [("a", 5, 7), ("a", 5, 7)]
    iv, pt = spark.createDataFrame(a, "run string, lo long, hi long, i long"), spark.createDataFrame(points, "run string, t long, k long")
    got = sorted((r["run"], r["lo"], r["hi"]) for r in I.merged(iv.where("run is not null"), ["run"]).collect())
    want = []
    for run in ("a", "b"):
        for lo, hi in sorted((x, y) for r, x, y, _ in a if r == run and x <= y):
            if want and want[-1][0] == run and lo <= want[-1][2]:
                want[-1] = (run, want[-1][1], max(hi, want[-1][2]))
            else:
                want.append((run, lo, hi))
    assert got == want
    held = lambda run, t: t is not None and any(r == run and r is not None and x <= t <= y for r, x, y, _ in a)
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted(map(tuple, I.exclude_points(pt, iv, "t", "run").collect()), key=key) == sorted((p for p in points if not held(*p[:2])), key=key)
    some = iv.where("i < 8")
    near = [(x - 20, y + 30) for _, x, y, i in a if i < 8]
    got = sorted(map(tuple, I.skim(pt, some, "t", 20, 30).collect()), key=key)
    assert got == sorted((p for p in points if p[1] is not None and any(x <= p[1] <= y for x, y in near)), key=key)


def test_lookup_keeps_repeated_rows(spark):
    df = spark.createDataFrame([("x", 5), ("x", 5), ("y", 50), ("z", None), ("x", 5)], "n string, run long")
    s = spark.createDataFrame([(0, 10, "wide"), (4, 6, "b"), (4, 5, "a"), (-(10**9), 10**9, "all"), (60, 40, "none")], "lo long, hi long, setting string")
    got = sorted(map(tuple, I.run_lookup(df, s, "run").collect()), key=str)
    assert got == sorted([("x", 5, "b"), ("x", 5, "b"), ("x", 5, "b"), ("y", 50, "all"), ("z", None, None)], key=str)
    assert I.run_lookup(df, s.where("false"), "run").where(F.col("setting").isNull()).count() == 5


def test_lookup_against_every_range(spark):
    rng = random.Random(11)
    ends = [-(2**63), -(2**40), -9, -1, 0, 1, 6, 7, 8, 64, 1_000, 2**40, 2**63 - 1]
    s = [(lo := rng.randrange(-300, 300), lo + rng.choice([-1, 0, 1, 2, 5, 7, 8, 63, 64, 500]), f"s{i % 7}") for i in range(90)]
    s += [(x, y, f"e{x}") for x in ends for y in ends if rng.random() < 0.3] + [(-(2**63), 2**63 - 1, "all"), (5, 9, None)]
    runs = [*ends, *range(-350, 900), None, 7, 7]
    got = I.run_lookup(spark.createDataFrame([(r,) for r in runs], "run long"), spark.createDataFrame(s, "lo long, hi long, setting string"), "run").collect()
    best = lambda r: max((x, v is not None, v or "") for x, y, v in s if x <= r <= y)
    want = [(r, None if r is None or not best(r)[1] else best(r)[2]) for r in runs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_lookup_makes_no_pairs(spark):
    """4,000 repeated runs under 4,000 ranges that hold nearly half of them: no step has a row per run and range."""
    df = spark.range(40_000).select((F.col("id") % 4_000).alias("run"))
    s = spark.range(4_000).select(F.col("id").alias("lo"), (F.col("id") + 1_000_000_000).alias("hi"), F.col("id").cast("string").alias("setting"))
    got = I.run_lookup(df, s, "run")
    assert [tuple(r) for r in got.where("setting = run").groupBy().agg(F.count("*"), F.countDistinct("run")).collect()] == [(40_000, 4_000)]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    done = store.executionsList().last().executionId()
    values, nodes, most = store.executionMetrics(done), store.planGraph(done).allNodes(), 0
    for n in range(nodes.size()):
        metrics = nodes.apply(n).metrics()
        for m in (metrics.apply(i) for i in range(metrics.size())):
            if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    assert 40_000 <= most < 400_000
