"""Sliding medians and moments by both routes, and order statistics by digits, against brute force."""

from __future__ import annotations

import random
import statistics

import pytest

from lodestone.operators import asof, ranges


@pytest.mark.parametrize("task_rows", [10**6, 30])
def test_sliding_moments(spark, monkeypatch, task_rows):
    """Stretches of one point and of far more than a task may hold, a null group, points far from zero, an empty table."""
    monkeypatch.setattr(ranges, "TASK_ROWS", task_rows)
    rng = random.Random(task_rows)
    rows = [(g, x, 1e6 + rng.random()) for g, xs in (("a", range(160)), (None, range(-5, 300, 7)), ("b", [9])) for x in xs]
    d = spark.createDataFrame(rows, "g string, x long, y double").repartition(3)
    got = {(r["g"], r["x"]): (r["mean"], r["std"]) for r in asof.sliding(d, "x", "y", 10, ["g"]).collect()}
    assert len(got) == len(rows)
    for g, x, _ in rows:
        around = [v for h, z, v in rows if h == g and abs(z - x) <= 10]
        mean, std = got[g, x]
        assert mean == pytest.approx(statistics.fmean(around), abs=1e-9)
        assert std is None if len(around) == 1 else std == pytest.approx(statistics.stdev(around), abs=1e-9)
    assert asof.sliding(d.limit(0), "x", "y", 10, ["g"]).count() == 0


@pytest.mark.parametrize(("gathered", "task_rows"), [(256, 10**6), (3, 10**6), (3, 40)])
def test_sliding_median(spark, monkeypatch, gathered, task_rows):
    """Groups of different sizes and a null one, equal values, repeated x (the largest value counts), gaps, single points."""
    monkeypatch.setattr(asof, "GATHERED", gathered)
    monkeypatch.setattr(ranges, "TASK_ROWS", task_rows)
    rng = random.Random(gathered)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([*range(-60, 90), 500, None]), rng.choice([None, 1.5, 1.5, rng.random() * 100])) for _ in range(220)]
    got = asof.sliding(spark.createDataFrame(rows, "g string, x long, y double"), "x", "y", 7, ["g"], ("median",)).collect()
    points = {}
    for g, x, y in rows:
        if x is not None and y is not None:
            points[g, x] = max(y, points.get((g, x), y))
    want = []
    for g, x, y in rows:
        around = sorted(v for (h, z), v in points.items() if h == g and x is not None and abs(z - x) <= 7) if (g, x) in points else []
        want.append((g, x, y, around[len(around) // 2] if around else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_select(spark, monkeypatch):
    """Ranges of any length over two groups, one of them too large for a task."""
    monkeypatch.setattr(ranges, "TASK_ROWS", 100)
    rng = random.Random(4)
    ranks = {"p": rng.sample(range(300), 300), "q": rng.sample(range(17), 17), "r": [0]}
    rows = spark.createDataFrame([(g, i, v) for g, r in ranks.items() for i, v in enumerate(r)], "_g string, _pos long, _rank long")
    asked = []
    for g, r in ranks.items():
        for i in range(40):
            a, b = sorted(rng.sample(range(len(r) + 1), 2)) if len(r) > 1 else (0, 1)
            asked.append((g, i, a, b, rng.randrange(b - a)))
    got = asof.select(rows, spark.createDataFrame(asked, "_g string, i long, _a long, _b long, _k long"))
    assert {(r["_g"], r["i"]): r["_rank"] for r in got.collect()} == {(g, i): sorted(ranks[g][a:b])[k] for g, i, a, b, k in asked}
