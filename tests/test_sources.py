"""Sources and sinks on real files."""

from __future__ import annotations

import json

from lodestone.operators import catalog
from lodestone.sources import footers, logs, sinks, tables


def test_metric_log(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "2024-05-01 10:00:00,250 INFO {'cpu_limit': 8, 'mem_limit': 16000, 'ns': 5}\n2024-05-01 10:00:01,000 INFO {'iter': 1, 'name': 'sim_1', 'cpu': -3.0, 'pss': 12.5, 'time': None}\n"
        "not a row\n2024-05-01 10:00:02,000 INFO {'iter': 1, 'name'\n2024-05-01 10:00:03,000 INFO {'iter': 2, 'name': '__cgroup_global__', 'cpu': 50.0}\n"
    )
    got = logs.read_metric_log(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["is_meta"], r["name"], r["cpu"], r["pss"]) for r in got] == [(0, True, None, None, None), (1, False, "sim_1", -3.0, 12.5), (4, False, "__cgroup_global__", 50.0, None)]


def test_time_log(spark, tmp_path):
    (tmp_path / "x.log_time").write_text("#walltime 0.00\n#usertime 0.5\n#CPU 250%\n#maxmem 2048\n")
    (tmp_path / "y.log_time").write_text("usertime 3\n")
    got = logs.read_time_log(spark, str(tmp_path)).collect()
    assert [(r["walltime"], r["cpu"], r["maxmem_mb"]) for r in got] == [(0.5, 2.5, 2.0)]


def test_trace(spark, tmp_path):
    (tmp_path / "trace_1_t.log").write_text(
        '10 openat(AT_FDCWD, "a", O_RDONLY) = 3</w/a>\n11 openat(AT_FDCWD, "b", O_WRONLY|O_CREAT <unfinished ...>\n10 openat(AT_FDCWD, "d", O_RDONLY|O_DIRECTORY) = 4</w/d>\n'
        '11 <... openat resumed>, 0666) = 5</w/b>\n10 rename("/w/x", "/w/y") = 0\n10 openat(AT_FDCWD, "n", O_RDONLY) = -1 ENOENT\n10 openat(AT_FDCWD, "a", O_RDONLY) = 3</w/a>\n'
    )
    assert {(r["path"], r["kind"]) for r in logs.read_trace(spark, str(tmp_path)).collect()} == {("/w/a", "read"), ("/w/b", "write"), ("/w/y", "write")}


def test_stages(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"stages": [{"name": "b", "needs": ["a"], "timeframe": 1, "resources": {"cpu": 1, "mem": 2}}, {"name": "a", "needs": []}]}, indent=1))
    s = logs.read_stages(spark, str(tmp_path))
    assert s.count() == 2 and [tuple(r) for r in logs.need_edges(s).collect()] == [("b", "a")]


def test_results_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("h", "chi2", 1.5), ("g", "ks", None)], "object string, metric string, value double")
    sinks.write_results(df, str(tmp_path / "r"), {"tag": "t"})
    back = sinks.read_results(spark, str(tmp_path / "r"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    sinks.write_line_protocol(df, str(tmp_path / "l"), "t a", ["object"], ["value"])
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "l")).collect()) == ["t a,object=g ", "t a,object=h value=1.5"]
    sinks.write_manifest(df, str(tmp_path / "m"), ["object"], "metric")
    assert spark.read.csv(str(tmp_path / "m"), sep="\t").count() == 2
    sinks.write_frame(str(tmp_path / "f"), df, df.select("object"))
    assert spark.read.json(str(tmp_path / "f")).count() == 4


def test_scan_and_versions(spark, tmp_path):
    spark.range(3).selectExpr("id", "id % 2 as df_id", "id * 2 as x").write.partitionBy("df_id").parquet(str(tmp_path / "t"))
    got = tables.scan(spark, str(tmp_path), ["t"], {"t": ["df_id", "x"]})["t"]
    assert got.columns == ["df_id", "x"] and catalog.thinned(got, "df_id").count() == 2
    assert tables.versioned(["P_002", "P_001", "PX"], "P") == "P_001" and tables.versioned(["Q"], "P") is None


def test_footers_are_those_that_duckdb_reads(spark, tmp_path):
    """Files of several row groups, nested columns, nulls, an empty file, and a folder of files."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pa.table({"a": list(range(1000)), "b": [None if i % 3 else f"text {i % 7}" for i in range(1000)], "c": [{"x": i, "y": [1.5] * (i % 3)} for i in range(1000)]})
    pq.write_table(t, tmp_path / "one.parquet", row_group_size=300, compression="zstd")
    (tmp_path / "many.parquet").mkdir()
    for k in range(3):
        pq.write_table(t.slice(k * 100, 90), tmp_path / "many.parquet" / f"part-{k}.parquet")
    pq.write_table(t.slice(0, 0), tmp_path / "none.parquet", store_schema=False)
    (tmp_path / "note.txt").write_text("no table")
    for whole in (None, True):
        got = footers.footers(spark, str(tmp_path), whole)
        mine = sorted((r["file"].split("/")[-1], r["row_group"], r["path"], r["rows"], r["values"], r["raw_bytes"], r["stored_bytes"]) for r in got.where("column is not null").collect())
        theirs = duckdb.sql(f"select file_name, row_group_id, path_in_schema, row_group_num_rows, num_values, total_uncompressed_size, total_compressed_size from parquet_metadata('{tmp_path}/**/*.parquet')").fetchall()
        assert mine == sorted((f.split("/")[-1], g, p.replace(", ", "."), *r) for f, g, p, *r in theirs) and len(mine) > 20
    profile = {(r["table"], r["group"]): (r["raw_bytes"], r["stored_bytes"], r["ratio"]) for r in footers.stored_profile(got, {"text": ["b"], "both": ["a", "b"]}).collect()}
    raw, stored = (sum(r[k] for r in mine if r[0] == "one.parquet" and r[2] in "ab") for k in (5, 6))
    assert profile["one", "both"] == (raw, stored, raw / stored) and profile["one", "text"][0] < raw
    assert profile[None, None][:2] == tuple(sum(r[k] for r in mine) for k in (5, 6))
    assert profile["many", None][:2] == tuple(sum(r[k] for r in mine if r[0].startswith("part")) for k in (5, 6))
    counts = {(r["file"], r["table"]): r["rows"] for r in footers.file_counts(got).collect()}
    assert counts == {("one.parquet", "one"): 1000, **{(f"many.parquet/part-{k}.parquet", "many"): 90 for k in range(3)}, ("none.parquet", "none"): 0, (None, "one"): 1000, (None, "many"): 270, (None, "none"): 0, (None, None): 1270}


def test_stored_profile_of_the_tables(spark, duck):
    from conftest import DATA

    from lodestone import plans

    got = {(r["table"], r["group"]): (r["raw_bytes"], r["stored_bytes"]) for r in plans.queries()["stored_profile"](spark, DATA).collect()}
    want = duck.execute(f"select sum(total_uncompressed_size)::bigint, sum(total_compressed_size)::bigint from parquet_metadata('{DATA}/lineitem.parquet') where path_in_schema in ('l_orderkey', 'l_partkey', 'l_suppkey')").fetchone()
    assert got["lineitem", "keys"] == want and got["orders", "flags"][0] > 0 and got[None, None] == tuple(sum(v[i] for (t, g), v in got.items() if t and not g) for i in (0, 1))


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """Blocks that cut lines anywhere, empty lines, a long line over several blocks, no last line feed, an empty file."""
    import random

    rng = random.Random(2)
    want = {}
    for k in range(4):
        lines = ["x" * rng.choice([0, 1, 5, 40, 90]) + f" {k}:{i}" for i in range(400)] + ["", "y" * 3000, "", "end\r"]
        (tmp_path / f"log{k}.txt").write_bytes("\n".join(lines).encode() + (b"\n" if k % 2 else b""))
        want |= {(f"log{k}.txt", i): v for i, v in enumerate(lines)}
    (tmp_path / "log9.txt").write_text("")
    for size in (700, None):
        got = logs.numbered_lines(spark, str(tmp_path), size)
        assert {(r["file"].split("/")[-1], r["line_no"]): r["value"] for r in got.collect()} == want
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"
