"""Graph loops by contraction against brute force, and the number of rounds they take."""

from __future__ import annotations

import random

import pytest

from lodestone.operators import lineage as L


def graph(rng, n, extra, ring):
    """Trees, joins and parallel ways; optionally rings, one of them reached from outside."""
    edges = {(rng.randrange(max(0, k - 6), k), k) for k in range(1, n)} | {(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(extra)) if a < b}
    if ring:
        edges |= {(3, n), (n, n + 1), (n + 1, n), (n + 2, n + 3), (n + 3, n + 2), (n + 1, n + 5), (n + 5, n + 6)}
    return sorted(edges)


def reach(edges, seeds):
    seen = set(seeds)
    while more := {b for a, b in edges if a in seen} - seen:
        seen |= more
    return seen


def level_of(names, edges):
    into = {v: [a for a, b in edges if b == v] for v in names}
    out, before = {}, None
    while before != len(out):
        before = len(out)
        out |= {v: max((out[a] for a in into[v]), default=-1) + 1 for v in names if v not in out and all(a in out for a in into[v])}
    return {v: out.get(v) for v in names}


@pytest.mark.parametrize(("n", "extra", "ring"), [(40, 0, False), (40, 25, True), (60, 150, False)])
def test_against_brute_force(spark, n, extra, ring):
    rng = random.Random(n + extra)
    edges = graph(rng, n, extra, ring)
    df = spark.createDataFrame([*edges, edges[0], (None, 1), (2, None)], "src long, dst long")
    seeds = [0 if ring else 5, n - 3, 999]
    got = [r["node"] for r in L.closure(df, spark.createDataFrame([(s,) for s in [*seeds, seeds[0], None]], "node long")).collect()]
    assert len(got) == len(set(got)) and set(got) == reach(edges, seeds)
    names = sorted({v for e in edges for v in e} - {7})  # 7 is needed but undefined
    got = {r["name"]: r["level"] for r in L.levels(spark.createDataFrame([(v,) for v in names], "name long"), df.selectExpr("dst as name", "src as need")).collect()}
    want = level_of(names, [e for e in edges if e[1] in names])
    assert got == want
    nodes = spark.createDataFrame([(v, v % 4) for v in names], "name long, weight long")
    if ring:
        with pytest.raises(ValueError, match="cycle"):
            L.longest_path(nodes, df)
    else:
        got = {r["name"]: r["length"] for r in L.longest_path(nodes, df).collect()}
        best = {}
        for v in sorted(names, reverse=True):
            best[v] = v % 4 + max((best[b] for a, b in edges if a == v and b in best), default=0)
        assert got == best


def test_depth_costs_few_rounds(spark, monkeypatch):
    """A chain of 1,000 and a ladder of 300 parallel ways: tables written are rounds."""
    written = []
    monkeypatch.setattr(L, "table", lambda df, name, f=L.table: written.append(name) or f(df, name))
    monkeypatch.setattr(L, "counted", lambda df, name, f=L.counted, **w: written.append(name) or f(df, name, **w))
    chain = spark.range(1000).selectExpr("id as src", "id + 1 as dst")
    assert L.closure(chain, spark.range(1, 2).toDF("node")).count() == 1000 and len(written) < 25
    written.clear()
    names = spark.range(1001).toDF("name")
    assert L.levels(names, chain.selectExpr("dst as name", "src as need")).selectExpr("max(level)", "count(level)").first() == (1000, 1001) and len(written) < 25
    written.clear()
    ladder = spark.range(300).selectExpr("explode(array(struct(3 * id as s, 3 * id + 1 as d), struct(3 * id as s, 3 * id + 2 as d), struct(3 * id + 1 as s, 3 * id + 3 as d), struct(3 * id + 2 as s, 3 * id + 3 as d))) as e").selectExpr("e.s as src", "e.d as dst")
    assert L.longest_path(spark.range(901).selectExpr("id as name", "1 as weight"), ladder).selectExpr("max(length)").first()[0] == 601 and len(written) < 25


def test_empty_graphs(spark):
    none = spark.createDataFrame([], "src long, dst long")
    one = spark.createDataFrame([(4,)], "name long")
    assert [tuple(r) for r in L.levels(one, none.selectExpr("dst as name", "src as need")).collect()] == [(4, 0)]
    assert [tuple(r) for r in L.longest_path(one.selectExpr("name", "9 as weight"), none).collect()] == [(4, 9)]
    assert [tuple(r) for r in L.closure(none, one.toDF("node")).collect()] == [(4,)]
    assert L.closure(none, one.toDF("node").where("false")).count() == L.levels(one.where("false"), none.selectExpr("dst as name", "src as need")).count() == 0
