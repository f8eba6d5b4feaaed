"""The linked-table fixture: expectations come from the input."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestone.operators import checks, links

REGISTRY = {
    "bc": {"key": "fGlobalBC"},
    "bcflag": {"paste": "bc"},
    "collision": {"sort": "fIndexBCs", "links": {"fIndexBCs": ("bc", "scalar")}},
    "mccollision": {"sort": "fIndexBCs", "dedup": ["fEventWeight"], "links": {"fIndexBCs": ("bc", "scalar")}},
    "mcparticle": {
        "sort": "fIndexMcCollisions", "follow_drops": True,
        "links": {"fIndexMcCollisions": ("mccollision", "scalar"), "mothers": ("mcparticle", "array"), "daughters": ("mcparticle", "slice")},
    },
    "track": {"sort": "fIndexCollisions", "links": {"fIndexCollisions": ("collision", "scalar")}},
    "tracklabel": {"paste": "track", "links": {"fIndexMcParticles": ("mcparticle", "scalar")}},
    "mft": {"sort": "fIndexCollisions", "links": {"fIndexCollisions": ("collision", "scalar")}},
    "fwd": {"sort": "fIndexCollisions", "links": {"fIndexCollisions": ("collision", "scalar"), "fIndexMFT": ("mft", "scalar"), "fIndexMatch": ("fwd", "scalar")}},
    "cluster": {"links": {"fIndexFwd": ("fwd", "scalar")}},
    "ambiguous": {"links": {"fIndexTracks": ("track", "scalar"), "sliceBCs": ("bc", "slice")}},
}


@pytest.fixture(scope="module")
def tables(spark):
    def t(schema, rows):
        return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], f"df_id int, row_id long, {schema}")

    keys, vertex = [200, 201, 202, 100, 101, 201], [0, 1, 3, 4, 5]
    parts = []
    for v in range(5):
        parts += [(v, 100 + 3 * v, [], (3 * v + 1, 3 * v + 2)), (v, 101 + 3 * v, [3 * v], (-1, -1)), (v, 102 + 3 * v, [3 * v], (-1, -1))]
    fwd_coll, match = [0, 1, -1, 2, 3, -1], [-1, 0, -1, -1, 3, -1]
    return {
        "bc": t("fRunNumber int, fGlobalBC long", [(1, k) for k in keys]),
        "bcflag": t("flag int", [(i + 1,) for i in range(6)]),
        "collision": t("fIndexBCs int, x float", [(b, 500.0 + i) for i, b in enumerate([0, 2, 3, 4])]),
        "mccollision": t("fIndexBCs int, x float, fEventWeight float", [(b, 600.0 + i, w) for i, (b, w) in enumerate(zip(vertex, [1.5, 2.5, 3.5, 4.5, 2.5], strict=True))]),
        "mcparticle": t("fIndexMcCollisions int, pdg int, mothers array<int>, daughters struct<first: int, last: int>", parts),
        "track": t("fIndexCollisions int, x float", [(c, 10.0 + i) for i, c in enumerate([0, 0, 1, -1, 2, 3, -1])]),
        "tracklabel": t("fIndexMcParticles int, mask int", [(p, i) for i, p in enumerate([0, 1, 3, -1, 6, 9, -1])]),
        "mft": t("fIndexCollisions int, x float", [(c, 1000.0 + i) for i, c in enumerate(fwd_coll)]),
        "fwd": t("fIndexCollisions int, fIndexMFT int, fIndexMatch int, x float", [(c, i, m, 2000.0 + i) for i, (c, m) in enumerate(zip(fwd_coll, match, strict=True))]),
        "cluster": t("fIndexFwd int, x float", [(f, 3000.0 + i) for i, f in enumerate([0, 1, 3, 4])]),
        "ambiguous": t("fIndexTracks int, sliceBCs struct<first: int, last: int>", [(3, (0, 2)), (6, (3, 4))]),
    }


def column(df, c):
    return [r[c] for r in df.orderBy("row_id").collect()]


@pytest.fixture(scope="module")
def after(tables):
    return {k: v.cache() for k, v in links.rewrite(tables, REGISTRY).items()}


def test_maps(tables):
    maps = links.plan_maps(tables, REGISTRY)
    assert [r["new"] for r in maps["bc"].orderBy("old").collect()] == [2, 3, 4, 0, 1, 3]
    assert [r["old"] for r in maps["collision"].orderBy("new").collect()] == [2, 3, 0, 1]
    assert [r["old"] for r in maps["mccollision"].where("survives").orderBy("new").collect()] == [2, 3, 0, 1]


def test_keys_and_links(after):
    assert column(after["bc"], "fGlobalBC") == [100, 101, 200, 201, 202]
    assert column(after["collision"], "fIndexBCs") == [0, 1, 2, 4]
    assert column(after["bcflag"], "flag") == [4, 5, 1, 2, 3]
    assert after["mccollision"].count() == 4 and after["mcparticle"].count() == 12


def test_particles_keep_family(after):
    p = after["mcparticle"]
    d = p.alias("m").join(p.alias("d"), F.expr("d.row_id between m.daughters.first and m.daughters.last"))
    assert [tuple(r) for r in d.select("m.pdg", "d.pdg").where("m.pdg + 1 <> d.pdg and m.pdg + 2 <> d.pdg").collect()] == []
    assert d.count() == 8


def test_forward_tracks_keep_partner(after):
    j = after["fwd"].join(after["mft"].select(F.col("row_id").alias("fIndexMFT"), F.col("x").alias("mx")), "fIndexMFT")
    assert [r[0] for r in j.select(F.col("x") - F.col("mx")).distinct().collect()] == [1000.0]
    m = after["fwd"].alias("a").join(after["fwd"].alias("b"), F.expr("a.fIndexMatch = b.row_id")).select("a.x", "b.x")
    assert sorted(map(tuple, m.collect())) == [(2001.0, 2000.0), (2004.0, 2003.0)]


def test_nothing_unexplained(tables, after):
    found = checks.link_preservation(tables, after, REGISTRY)
    assert found.where("unexplained > 0").count() == 0
    wrong = dict(after) | {"track": after["track"].withColumn("fIndexCollisions", F.when(F.col("fIndexCollisions") == 0, 1).otherwise(F.col("fIndexCollisions")))}
    assert checks.link_preservation(tables, wrong, REGISTRY).where("unexplained > 0").count() == 1


def test_twice_is_once(after):
    again = links.rewrite(after, REGISTRY)
    for name in ("bc", "collision", "track", "fwd", "mccollision"):
        assert sorted(map(str, again[name].collect())) == sorted(map(str, after[name].collect()))


def test_grouped_table_is_sorted_again(after):
    assert column(after["cluster"], "fIndexFwd") == sorted(column(after["cluster"], "fIndexFwd"))


def _disk(spark):
    """Bytes in Spark's own files, and values (rows by columns) in the application's tables."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq
    from lodestone.operators import durable

    own = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [pq.read_metadata(f) for f in Path(urlparse(durable.folder(spark)).path).rglob("*.parquet")]
    return sum(own.apply(i).length() for i in range(own.size()) if own.apply(i).getName().startswith("shuffle_")), sum(m.num_rows * m.num_columns for m in found)


def _settled(spark, most):
    """Bytes of Spark's own files once they are down to ``most``, or after ten seconds."""
    for _ in range(50):
        if (now := _disk(spark)[0]) <= most:
            break
        time.sleep(0.2)
    return now


def test_tables_leave_no_shuffle_files(spark):
    from lodestone.operators import durable

    before = _disk(spark)[0]
    t = durable.table(spark.range(100_000).withColumn("k", F.xxhash64("id")).repartition(4, "k"), "shuffled")
    assert t.count() == 100_000 and _settled(spark, before + 10_000) <= before + 10_000


def test_rewrite_of_large_parts(spark, duck, monkeypatch):
    """Parts dealt by ranges: the rows of the SQL, with few values written and no shuffle files left by the way."""
    from conftest import DATA, same
    from lodestone.operators import ranges
    from lodestone.plans import linked

    monkeypatch.setattr(ranges, "TASK_ROWS", 50)
    linked._small.cache_clear()
    before = _disk(spark)
    try:
        assert not linked.fit(spark, DATA)
        q = linked.rewrite_tables(spark, DATA)
        left = _settled(spark, before[0] + 20_000)
        written = _disk(spark)[1] - before[1]
        same(q.toPandas(), duck.execute(linked.SQL["rewrite_tables"]).df())
    finally:
        linked._small.cache_clear()
    assert left <= before[0] + 20_000
    assert written < 35 * 6_000


def test_lines_of_repeated_and_missing_orders(spark, tmp_path, monkeypatch):
    """Orders of equal keys in two parts and in one, orders without lines, lines without orders, and an order too large for a task."""
    import duckdb
    from conftest import DATA, same
    from lodestone.operators import ranges
    from lodestone.plans import linked

    con = duckdb.connect()
    con.execute(f"copy (select * from '{DATA}/orders.parquet' where o_orderkey % 5 > 0 union all select * replace (o_custkey + 1 as o_custkey) from '{DATA}/orders.parquet' where o_orderkey % 7 = 0) to '{tmp_path}/orders.parquet'")
    con.execute(f"copy (select * from '{DATA}/lineitem.parquet' where l_orderkey % 4 > 0 union all select * replace (11 as l_orderkey) from '{DATA}/lineitem.parquet' where l_orderkey < 20) to '{tmp_path}/lineitem.parquet'")
    for t in ("orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    want = con.execute(f"with {linked.BASE} select df_id::int as df_id, row_id, order_row, l_orderkey, l_linenumber, l_partkey, l_extendedprice from l").df()
    for rows in (100, 10):
        monkeypatch.setattr(ranges, "TASK_ROWS", rows)
        linked._small.cache_clear()
        same(linked.lines(spark, str(tmp_path)).select(*want.columns).toPandas(), want)
    linked._small.cache_clear()
