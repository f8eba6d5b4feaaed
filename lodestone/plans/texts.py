"""Text-source queries: the driver tables' rows written as log lines by Spark, then parsed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.durable import folder
from ..sources import logs as G
from ..sources import sinks
from .tables import read

S = lambda c: F.col(c).cast("string")
CC = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) and not v.startswith("$") else S(v[1:]) if isinstance(v, str) else v for v in x])


def metric_log(spark, d):
    e = read(spark, d, "events").withColumn("at", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS"))
    row = CC("$at", " INFO {'iter': ", "$event_id", ", 'name': '", "$event_type", "', 'cpu': None, 'pss': ", "$value", ", 'timeframe': ", "$user_id", "}")
    line = F.when(F.col("event_id") % 50 == 7, CC("$at", " INFO {'cpu_limit': ", "$user_id", ", 'ns': 5}")).when(F.col("event_id") % 50 == 9, "broken {").when(F.col("event_id") % 50 == 11, CC("$at", " INFO {'iter': ")).otherwise(row)
    return G.parse_metric_log(e.select("event_id", line.alias("value"))).select("event_id", "iter", "name", "cpu", "pss", "timeframe", "cpu_limit", "ns", "is_meta")


def time_log(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", F.explode(F.array(
        F.when(F.col("o_custkey") % 9 > 0, CC("walltime ", F.when(F.col("o_custkey") % 4 == 0, "0.00").otherwise(S("o_totalprice")))), CC("#usertime ", "$o_custkey"), CC("CPU ", "$o_custkey", "%"), CC("maxmem ", "$o_orderkey"), F.lit("junk"))).alias("value"))
    return G.parse_time_log(o, "o_orderkey").withColumns({c: F.round(c, 6) for c in ("cpu", "maxmem_mb")})


def trace_log(spark, d):
    x = read(spark, d, "orders").select(S("o_custkey").alias("file"), (F.col("o_orderkey") * 3).alias("line_no"), "o_orderkey")
    flag = F.when(F.col("o_orderkey") % 3 == 0, "O_RDONLY|O_DIRECTORY").when(F.col("o_orderkey") % 3 == 1, "O_RDONLY").otherwise("O_WRONLY|O_CREAT")
    path = CC("/a/f", (F.col("o_orderkey") % 17).cast("string"))
    pid = (F.col("o_orderkey") % 4 + 10).cast("string")
    whole = CC(pid, " openat(AT_FDCWD, \"x\", ", flag, ") = 5<", path, ">")
    first, last = CC(pid, " openat(AT_FDCWD, \"x\", ", flag, " <unfinished ...>"), CC(pid, " <... openat resumed>) = 7<", path, ">")
    move = CC(pid, " rename(\"/a/old\", \"/a/new", (F.col("o_orderkey") % 5).cast("string"), "\") = 0")
    lines = F.when(F.col("o_orderkey") % 7 == 0, F.array(first, F.lit("99 close(3) = 0"), last)).when(F.col("o_orderkey") % 7 == 1, F.array(move)).otherwise(F.array(whole))
    y = x.select("file", "line_no", F.posexplode(lines).alias("k", "value")).select("file", (F.col("line_no") + F.col("k")).alias("line_no"), "value")
    return G.parse_trace(y)


def _files(spark, lines, part: str, order: str) -> str:
    """One text file per part, its lines in order."""
    at = f"{folder(spark)}/logs-{uuid.uuid4().hex}"
    lines.repartition(part).sortWithinPartitions(part, order).select(part, "value").write.partitionBy(part).text(at)
    return at


BLOCK = 1 << 16


def numbered_log(spark, d):
    """Log files of several blocks each: the number of every line in its file."""
    o = read(spark, d, "orders").select((F.col("o_custkey") % 3).alias("part"), "o_orderkey", CC("line of ", "$o_orderkey", "\tby ", "$o_custkey").alias("value"))
    x = G.numbered_lines(spark, _files(spark, o, "part", "o_orderkey"), BLOCK)
    return x.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "line_no", "value")


def metric_files(spark, d):
    """Metric logs in files of several blocks, one per user group; meta rows and rows by iteration, with their line numbers."""
    e = read(spark, d, "events").withColumn("at", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS"))
    line = F.when(F.col("event_id") % 50 == 7, CC("$at", " INFO {'cpu_limit': ", "$user_id", "}")).when(F.col("event_id") % 50 == 9, "broken {").otherwise(CC("$at", " INFO {'iter': ", "$event_id", ", 'name': '", "$event_type", "', 'pss': ", "$value", "}"))
    x = e.select((F.col("user_id") % 2).alias("part"), "event_id", line.alias("value"))
    rows = G.parse_metric_log(G.numbered_lines(spark, _files(spark, x, "part", "event_id"), BLOCK))
    return rows.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "line_no", "iter", "name", "pss", "cpu_limit", "is_meta")


def access_log(spark, d):
    line = F.when(F.col("l_linenumber") == 5, "noise").otherwise(CC('"/w/', "$l_partkey", '",', F.when(F.col("l_returnflag") == "R", "write").otherwise("read"), ",", "$l_suppkey", ";", "$l_linenumber"))
    return G.parse_access_log(read(spark, d, "lineitem").select(line.alias("value")))


def action_log(spark, d):
    o = read(spark, d, "orders")
    rc = (F.col("o_custkey") % 2).cast("string")
    line = F.when(F.col("o_orderkey") % 2 == 0, CC("x INFO Task ", "$o_orderkey", " 7:task", "$o_custkey", " finished with status ", rc)).otherwise(CC("x INFO Task pid=", "$o_orderkey", " tid=3 task_", "$o_custkey", " finished rc=", rc))
    return G.parse_action_log(o.select(line.alias("value")))


def interval_list(spark, d):
    o = read(spark, d, "orders")
    line = F.when(F.col("o_orderkey") % 10 == 0, CC("# ", "$o_orderkey")).when(F.col("o_orderkey") % 10 == 1, CC("bad ", "$o_orderkey")).otherwise(CC("$o_custkey", ", ", "$o_orderkey", "\t", (F.col("o_orderkey") + 5).cast("string"), "; bad, very bad"))
    return G.parse_intervals(o.select(line.alias("value")))


def path_catalog(spark, d):
    o = read(spark, d, "orders")
    path = F.when(F.col("o_custkey") % 3 == 0, CC("/x/TAG/", (F.col("o_orderkey") % 10).cast("string"), "/5", "$o_custkey", "/s", "$o_orderkey", "/a.zip")).when(F.col("o_custkey") % 3 == 1, CC("/x/TAG/5", "$o_custkey", "/s", "$o_orderkey")).otherwise(CC("/y/OTHER/", "$o_orderkey"))
    return G.parse_workflow_path(o.select("o_orderkey", path.alias("path")), "path", "TAG").drop("path")


def result_paths(spark, d):
    o = read(spark, d, "orders")
    path = CC("./P", (F.col("o_custkey") % 9).cast("string"), "/pass", (F.col("o_custkey") % 4).cast("string"), "/", F.when(F.col("o_orderkey") % 6 == 0, "x").otherwise(""), "$o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "/results.dat").otherwise("/RESULTS.dat"))
    return G.parse_result_path(o.select("o_orderkey", path.alias("path")), "path", "results[.]dat").drop("path")


def file_labels(spark, d):
    o = read(spark, d, "orders")
    a = F.col("o_orderkey") + 1700000000000
    path = CC("/res/f_", a.cast("string"), F.when(F.col("o_orderkey") % 8 == 0, "_9").otherwise(CC("_", (a + 60000).cast("string"))), ".bin")
    return G.parse_labels(o.select("o_orderkey", path.alias("path")), "path").drop("path")


def command_log(spark, d):
    p = read(spark, d, "part")
    line = CC("exe", (F.col("p_partkey") % 20).cast("string"), " -b --run ", "$p_partkey", " --name \"", "$p_brand", "\" --configKeyValues \"A.x=", "$p_size", ";B.y.z=", (F.col("p_partkey") % 3).cast("string"), "\" --flag")
    return G.last_written(G.parse_commands(p.select(F.col("p_partkey").alias("line_no"), line.alias("value"))), ["--name"])


def metadata_blocks(spark, d):
    p = read(spark, d, "part")
    text = CC("head\nx = 1\nMetadata:\n  size = ", "$p_size", "\n  price = ", "$p_retailprice", "\n  none = None\n\nlost = 1\nMetadata:\n  brand = ", "$p_brand", " \n")
    return G.parse_metadata_blocks(p.select("p_partkey", text.alias("t")), "t", "p_partkey")


def batch_list(spark, d):
    o = read(spark, d, "orders")
    line = F.when(F.col("o_orderkey") % 5 == 0, CC("# ", "$o_custkey")).when(F.col("o_orderkey") % 5 == 1, "  ").otherwise(CC("$o_custkey", "  P", (F.col("o_custkey") % 7).cast("string"), " # note"))
    return G.parse_batch_list(o.select(line.alias("value"))).select("period").distinct()


def job_descriptions(spark, d):
    p = read(spark, d, "part")
    text = CC("Executable = \"", "$p_name", "\";\nArguments =\n {", "$p_size", ", ", "$p_partkey", "};\nLPMMetaData = a;b;\nTTL = ", "$p_partkey", ";")
    return G.parse_job_description(p.select("p_partkey", text.alias("t")), "t", "p_partkey")


def stage_edges(spark, d):
    doc = F.to_json(F.struct(F.array(F.struct(CC("t", "$p_partkey").alias("name"), F.array(CC("t", "$p_size"), CC("t", (F.col("p_partkey") % 10).cast("string"))).alias("needs"))).alias("stages")))
    schema = "stages array<struct<name: string, needs: array<string>>>"
    s = read(spark, d, "part").select(F.explode(F.from_json(doc, schema)["stages"]).alias("s")).select("s.*")
    return G.need_edges(s)


def line_protocol(spark, d):
    e = read(spark, d, "events").withColumn("v", F.when(F.col("event_id") % 3 > 0, F.col("user_id")))
    return e.select("event_id", sinks.line_protocol("rel val", ["event_type", "event_id"], ["v", "user_id"]).alias("line"))


def window_manifest(spark, d):
    x = read(spark, d, "lineitem").select("l_suppkey", "l_linenumber", CC("f", "$l_partkey").alias("file"))
    return sinks.manifest(x, ["l_suppkey", "l_linenumber"], "file")


SQL = {
    "metric_log": """select event_id, case when event_id % 50 <> 7 then event_id::double end as iter, case when event_id % 50 <> 7 then event_type end as name, null::double as cpu, case when event_id % 50 <> 7 then value end as pss,
        case when event_id % 50 <> 7 then user_id::int end as timeframe, case when event_id % 50 = 7 then user_id::double end as cpu_limit, case when event_id % 50 = 7 then 5 end as ns, event_id % 50 = 7 as is_meta from events where event_id % 50 not in (9, 11)""",
    "time_log": "select o_orderkey, case when o_custkey % 4 = 0 then o_custkey::double else o_totalprice end as walltime, round(o_custkey / 100, 6) as cpu, round(o_orderkey / 1024, 6) as maxmem_mb from orders where o_custkey % 9 > 0",
    "trace_log": """select distinct o_custkey::varchar as file, case when o_orderkey % 7 = 1 then '/a/new' || o_orderkey % 5 else '/a/f' || o_orderkey % 17 end as path,
        case when o_orderkey % 7 = 1 or o_orderkey % 3 = 2 then 'write' else 'read' end as kind from orders where o_orderkey % 7 = 1 or o_orderkey % 3 > 0""",
    "numbered_log": "select o_custkey % 3 as part, row_number() over (partition by o_custkey % 3 order by o_orderkey) - 1 as line_no, 'line of ' || o_orderkey || chr(9) || 'by ' || o_custkey as value from orders",
    "metric_files": """with l as (select *, user_id % 2 as part, row_number() over (partition by user_id % 2 order by event_id) - 1 as line_no, event_id % 50 = 7 as m from events)
        select part, line_no, case when not m then event_id::double end as iter, case when not m then event_type end as name, case when not m then value end as pss, case when m then user_id::double end as cpu_limit, m as is_meta from l where event_id % 50 <> 9""",
    "access_log": "select '/w/' || l_partkey as file, case when l_returnflag = 'R' then 'write' else 'read' end as mode, l_suppkey || ';' || l_linenumber as pids from lineitem where l_linenumber <> 5",
    "action_log": "select distinct o_orderkey::varchar as pid, case when o_orderkey % 2 = 0 then 'task' else 'task_' end || o_custkey as task from orders where o_custkey % 2 = 0",
    "interval_list": "select o_custkey as run, o_orderkey as lo, o_orderkey + 5 as hi, 'bad, very bad' as message from orders where o_orderkey % 10 > 1",
    "path_catalog": "select o_orderkey, case when o_custkey % 3 = 0 then (o_orderkey % 10)::int end as cycle, ('5' || o_custkey)::int as run, 's' || o_orderkey as split from orders where o_custkey % 3 < 2",
    "result_paths": "select o_orderkey, 'P' || o_custkey % 9 as period, 'pass' || o_custkey % 4 as pass, o_orderkey::int as run from orders where o_orderkey % 6 > 0",
    "file_labels": "select o_orderkey, o_orderkey + 1700000000000 as lo, o_orderkey + 1700000060000 as hi from orders where o_orderkey % 8 > 0",
    "command_log": """with l as (select p_partkey % 20 as e, max(p_partkey) as k, arg_max(p_size, p_partkey) as s, arg_max(p_partkey % 3, p_partkey) as z from part group by 1)
        select 'exe' || e as executable, unnest([null, null, null, 'A', 'B']) as "group", unnest(['-b', '--run', '--flag', 'x', 'y.z']) as key, unnest(['true', k::varchar, 'true', s::varchar, z::varchar]) as value from l""",
    "metadata_blocks": "select p_partkey, unnest([1, 1, 1, 2]) as block, unnest(['size', 'price', 'none', 'brand']) as key, unnest([p_size::varchar, p_retailprice::varchar, null, p_brand]) as value, unnest(['int', 'float', 'none', 'string']) as kind from part",
    "batch_list": "select distinct 'P' || o_custkey % 7 as period from orders where o_orderkey % 5 > 1",
    "job_descriptions": "select p_partkey, unnest(['Executable', 'TTL']) as key, unnest(['\"' || p_name || '\"', p_partkey::varchar]) as value from part union all select p_partkey, 'Arguments', '{' || p_size || ', ' || p_partkey || '}' from part",
    "stage_edges": "select 't' || p_partkey as name, unnest(['t' || p_size, 't' || p_partkey % 10]) as need from part",
    "line_protocol": "select event_id, 'rel val,event_type=' || event_type || ',event_id=' || event_id || ' ' || case when event_id % 3 > 0 then 'v=' || user_id || ',' else '' end || 'user_id=' || user_id as line from events",
    "window_manifest": "select l_suppkey, l_linenumber, string_agg('f' || l_partkey, ' ' order by 'f' || l_partkey) as files from lineitem group by all",
}
QUERIES = {name: globals()[name] for name in SQL}
