"""Lineage and graph queries: parts are files, suppliers tasks; parts form a tree by halving their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage as L
from .tables import read


def edges(spark, d):
    x = read(spark, d, "lineitem")
    file = F.concat(F.lit("/work/run/tf"), (F.col("l_partkey") % 4).cast("string"), F.lit("/f"), F.floor(F.col("l_partkey") / 50).cast("string"), F.when(F.col("l_partkey") % 9 == 0, ".log").otherwise(".dat"))
    task = F.concat(F.lit("t"), F.floor(F.col("l_suppkey") / 8).cast("string"), F.lit("_"), (F.col("l_suppkey") % 4).cast("string"))
    return x.select(file.alias("file"), F.when(F.col("l_returnflag") == "R", "write").otherwise("read").alias("kind"), task.alias("task"), "l_linestatus", "l_suppkey", "l_partkey")


ED = """ed as (
  select '/work/run/tf' || l_partkey % 4 || '/f' || l_partkey // 50 || case when l_partkey % 9 = 0 then '.log' else '.dat' end as file, case when l_returnflag = 'R' then 'write' else 'read' end as kind,
         't' || l_suppkey // 8 || '_' || l_suppkey % 4 as task, l_linestatus, l_suppkey, l_partkey from lineitem
)"""
join = lambda c: F.array_join(c, ",")


def lineage_report(spark, d):
    return L.report(edges(spark, d)).select("file", join("written_by").alias("written_by"), join("read_by").alias("read_by"))


def lineage_tasks(spark, d):
    return L.task_report(edges(spark, d)).select("task", F.size("writes").alias("writes"), F.size("reads").alias("reads"), F.get("reads", F.lit(0)).alias("first_read"))


def lineage_template(spark, d):
    return L.templates(edges(spark, d)).select("file", "kind", "task", join(F.col("timeframes").cast("array<string>")).alias("timeframes"))


def lineage_expand(spark, d):
    return L.expand(L.templates(edges(spark, d)), 3, ["f1[.]dat$"])


def lineage_filter(spark, d):
    return L.keep_files(edges(spark, d), "/work/run", ["tf2/", "f3[.]"]).groupBy("file").agg(F.count("*").alias("n"))


def lineage_verdict(spark, d):
    e = edges(spark, d)
    return L.verdict(e.where("l_linestatus = 'O' or l_partkey % 3 > 0"), e.where("l_partkey % 7 > 0 or l_linestatus = 'F'"))


def lineage_worst(spark, d):
    return L.worst(lineage_verdict(spark, d))


def pid_attribution(spark, d):
    x = read(spark, d, "lineitem")
    pids = F.concat_ws(";", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"), F.lit(""))
    access = x.select(F.col("l_partkey").cast("string").alias("file"), F.col("l_returnflag").alias("mode"), pids.alias("pids"))
    actions = read(spark, d, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").cast("string").alias("pid"), F.concat(F.lit("task"), F.col("s_nationkey").cast("string")).alias("task"))
    return L.attribute(access, actions).groupBy("kind", "task").agg(F.count("*").alias("files"))


def _stages(spark, d):
    """Part k needs parts k div 2 and k div 3; every tenth name above 1000 is undefined."""
    p = read(spark, d, "part")
    needs = p.select(F.col("p_partkey").alias("name"), F.explode(F.array_distinct(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3)))).alias("need")).where("need > 0")
    names = p.where("p_partkey % 50 <> 13").select(F.col("p_partkey").alias("name"))
    return names, needs


def stage_check(spark, d):
    n, e = _stages(spark, d)
    return L.check_stages(n.unionByName(n.where("name % 100 = 4")), e)


def closure(spark, d):
    """What the largest defined parts need."""
    n, e = _stages(spark, d)
    large = read(spark, d, "part").where("p_size = 50").select(F.col("p_partkey").alias("name"))
    return L.closure(e.toDF("src", "dst"), n.join(large, "name", "left_semi").toDF("node"))


def descendants(spark, d):
    n, e = _stages(spark, d)
    return L.closure(e.toDF("dst", "src"), n.where("name = 7").toDF("node"))


def satisfiable(spark, d):
    n, e = _stages(spark, d)
    return L.satisfiable(n, e)


def topo_level(spark, d):
    """Two of the parts also need each other: they and what is behind them have no level."""
    p = read(spark, d, "part")
    n, e = p.select(F.col("p_partkey").alias("name")), _stages(spark, d)[1]
    return L.levels(n, e.unionByName(e.where("name = 40 and need = 20").select(F.col("need").alias("name"), F.col("name").alias("need"))))


def longest_path(spark, d):
    p = read(spark, d, "part")
    e = p.where("p_partkey > 1").select(F.floor(F.col("p_partkey") / 2).alias("src"), F.col("p_partkey").alias("dst"))
    return L.longest_path(p.select(F.col("p_partkey").alias("name"), F.col("p_size").cast("long").alias("weight")), e)


def replicate(spark, d):
    p = read(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    glob = F.col("p_partkey") % 5 == 0
    s = p.select(
        F.when(glob, F.concat(F.lit("g"), k)).otherwise(F.concat(F.lit("t"), k, F.lit("_1"))).alias("name"), F.when(glob, -1).otherwise(1).alias("timeframe"),
        F.array(F.concat(F.lit("t"), (F.col("p_partkey") + 1).cast("string"), F.lit("_1")), F.concat(F.lit("g"), (F.col("p_size") * 5).cast("string"))).alias("needs"),
    )
    return L.replicate(s, 3).select("name", "timeframe", join("needs").alias("needs"))


def releasable(spark, d):
    e = edges(spark, d)
    return L.releasable(e.select("file", "task"), e.where("l_suppkey % 11 > 0").select("task"))


NEED = "nd as (select distinct p_partkey as name, unnest([p_partkey // 2, p_partkey // 3]) as need from part), ne as (select * from nd where need > 0), nm as (select p_partkey as name from part where p_partkey % 50 <> 13)"
VERDICT = f"""with {ED}, r as (select distinct file, kind, task from ed where l_linestatus = 'O' or l_partkey % 3 > 0), c as (select distinct file, kind, task from ed where l_partkey % 7 > 0 or l_linestatus = 'F'),
  j as (select file, bool_or(s = 'r') as r, bool_or(s = 'c') as c from (select *, 'r' as s from r union all select *, 'c' from c) group by file, kind, task),
  g as (select file, count(*) filter (r and c) as common, count(*) filter (not c) as missing, count(*) filter (not r) as extra from j group by 1),
  v as (select *, case when common + missing > 0 then common / (common + missing) else 1.0 end::double as recall, case when missing > 0 then 'UNSAFE' when extra > 0 then 'SAFE' else 'EXACT' end as verdict from g)"""

SQL = {
    "lineage_report": f"""with {ED} select file, coalesce(string_agg(distinct task, ',' order by task) filter (kind = 'write'), '') as written_by, coalesce(string_agg(distinct task, ',' order by task) filter (kind = 'read'), '') as read_by from ed group by 1""",
    "lineage_tasks": f"with {ED} select task, count(distinct file) filter (kind = 'write')::int as writes, count(distinct file) filter (kind = 'read')::int as reads, min(file) filter (kind = 'read') as first_read from ed group by 1",
    "lineage_template": f"""with {ED}, t as (select distinct regexp_replace(file, 'tf[0-9]+/', 'tfX/') as file, kind, regexp_replace(task, '_[0-9]+$', '_X') as task, l_partkey % 4 as tf from ed)
        select file, kind, task, string_agg(tf::varchar, ',' order by tf) as timeframes from t group by all""",
    "lineage_expand": f"""with {ED}, t as (select distinct regexp_replace(file, 'tf[0-9]+/', 'tfX/') as file, kind, regexp_replace(task, '_[0-9]+$', '_X') as task from ed)
        select replace(file, 'tfX', 'tf' || tf) as file, kind, regexp_replace(task, '_X$', '_' || tf) as task, tf::int as tf, regexp_matches(file, 'f1[.]dat$') as keep from t, (select unnest([1, 2, 3]) as tf)""",
    "lineage_filter": f"with {ED} select '.' || substr(file, 10) as file, count(*) as n from ed where not file like '%.log' and not regexp_matches(file, 'tf2/|f3[.]') group by 1",
    "lineage_verdict": VERDICT + " select * from v",
    "lineage_worst": VERDICT + " select ['EXACT', 'SAFE', 'UNSAFE'][max(case verdict when 'UNSAFE' then 3 when 'SAFE' then 2 else 1 end)] as verdict, count(*) as files from v",
    "pid_attribution": """with a as (select distinct l_partkey, l_returnflag as kind, unnest([l_suppkey, l_linenumber]) as pid from lineitem)
        select kind, 'task' || s_nationkey as task, count(distinct l_partkey) as files from a join supplier on s_suppkey = pid and s_nationkey < 12 group by all""",
    "stage_check": f"""with {NEED} select distinct need as name, 'undefined' as problem from ne where need not in (select name from nm) union all select name, 'duplicate' from nm where name % 100 = 4""",
    "closure": f"with recursive {NEED}, r as (select name as node from nm where name in (select p_partkey from part where p_size = 50) union select need from r join ne on name = node) select node from r",
    "descendants": f"with recursive {NEED}, r as (select 7::bigint as node union select name from r join ne on need = node) select node from r",
    "satisfiable": f"with recursive {NEED}, b as (select distinct name as node from ne where need not in (select name from nm) union select name from b join ne on need = node) select name from nm where name not in (select node from b)",
    "topo_level": f"""with recursive {NEED}, c as (select 20::bigint as node union select name from c join ne on need = node), e as (select * from ne where name not in (select node from c)),
        lv as (select p_partkey as name, 0 as level from part where p_partkey not in (select name from ne) union select e.name, level + 1 from lv join e on e.need = lv.name)
        select p_partkey as name, max(level)::int as level from part left join lv on name = p_partkey group by 1""",
    "longest_path": """with recursive w as (select p_partkey as leaf, p_partkey as node, p_size::bigint as length from part union all select leaf, node // 2, length + p_size from w join part on p_partkey = node // 2 where node > 1)
        select node as name, max(length) as length from w group by 1""",
    "replicate": """with s as (select p_partkey as k, p_size, p_partkey % 5 = 0 as g from part)
        select case when g then 'g' || k else 't' || k || '_' || f end as name, case when g then -1 else f end::int as timeframe,
               case when g then 't' || k + 1 || '_1,t' || k + 1 || '_2,t' || k + 1 || '_3,g' || p_size * 5 else 't' || k + 1 || '_' || f || ',g' || p_size * 5 end as needs
        from s, (select unnest([1, 2, 3]) as f) where not g or f = 1""",
    "releasable": f"with {ED} select file, bool_and(task in (select task from ed where l_suppkey % 11 > 0)) as releasable from ed group by 1",
}
QUERIES = {name: globals()[name] for name in SQL}
