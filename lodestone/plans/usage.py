"""Resource queries: events stand in for measurements (day = iteration, type = task, user = frame and pipeline)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import resources as R
from .ordered import EV, events
from .tables import read, rounded


def rows(spark, d):
    e = events(spark, d)
    u = F.col("user_id")
    return e.select(
        (u % 3).alias("pipeline"), F.floor(F.col("sec") / 86400).alias("iter"), F.when(u % 10 == 9, "__cgroup_global__").when(u % 10 == 8, "__other").otherwise(F.concat_ws("_", "event_type", (u % 8).cast("string"))).alias("raw"),
        "event_id", F.col("sec").cast("double").alias("time"), F.when(u % 7 > 0, F.col("value") - 20).alias("cpu0"), (F.col("value") * 3).alias("pss"), (F.col("value") * 2).alias("uss"),
        F.when(u % 6 == 0, 19).otherwise(0).alias("nice"), (F.col("event_id") / 4).alias("disc"),
    ).withColumns({"name": C.base_name(F.col("raw")), "timeframe": C.timeframe(F.col("raw")), "cpu": C.clean_cpu(F.col("cpu0"))}).withColumn(
        "category", C.category(F.col("name"), {"click": None, "view": None, "err": "Q", "sign": None, "c": "click"})
    )


RW = EV + """, r0 as (
  select user_id % 3 as pipeline, sec // 86400 as iter, case when user_id % 10 = 9 then '__cgroup_global__' when user_id % 10 = 8 then '__other' else event_type || '_' || user_id % 8 end as raw, event_id, sec::double as time,
         case when user_id % 7 > 0 then value - 20 end as cpu0, value * 3 as pss, value * 2 as uss, case when user_id % 6 = 0 then 19 else 0 end as nice, event_id / 4 as disc from ev
), r1 as (
  select *, regexp_replace(raw, '_[0-9]+$', '') as name, coalesce(try_cast(regexp_extract(raw, '_([0-9]+)$', 1) as int), 0) as timeframe, case when cpu0 is not null then greatest(0.0, cpu0) / 100 end as cpu from r0
), r2 as (
  select *, [x for x in [case when name ilike '%click%' then 'click' end, case when name ilike '%view%' then 'view' end, case when name ilike '%err%' and name not like '%Q%' then 'err' end,
    case when name ilike '%sign%' then 'sign' end, case when name ilike '%c%' and name not like '%click%' then 'c' end] if x is not null] as cats from r1
), rw as (
  select *, case when len(cats) = 1 then cats[1] end as category from r2
), tk as (select * from rw where name not like '\\_\\_%' escape '\\'), sl as (select * from rw where name = '__cgroup_global__')"""


def task_columns(spark, d):
    return rows(spark, d).select("event_id", "name", "timeframe", "cpu", "category")


def internal_rows(spark, d):
    t, s = R.split_internal(rows(spark, d))
    n = lambda x, k: x.groupBy().agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).withColumn("kind", F.lit(k))
    return n(t, "task").unionByName(n(s, "slice"))


def iter_dense(spark, d):
    t, _ = R.split_internal(rows(spark, d))
    return rounded(R.per_iteration(t, ["pss", "cpu"], ["category"]), pss=4, cpu=4)


def series_stats(spark, d):
    t, _ = R.split_internal(rows(spark, d))
    s = R.series_stats(R.per_iteration(t, ["pss", "cpu"]), ["pss", "cpu"], scale={"cpu": F.lit(1 / 8)})
    return s.select("pipeline", *[F.round(c, 4).alias(c) for c in s.columns[1:]])


def category_need(spark, d):
    return rounded(R.category_need(R.split_internal(rows(spark, d))[0], "pss"), pss=4)


def task_need(spark, d):
    return rounded(R.task_need(R.split_internal(rows(spark, d))[0], "pss", "view"), max=4, mean=4)


def top_peaks(spark, d):
    return rounded(R.top_peaks(R.split_internal(rows(spark, d).withColumn("name", F.col("raw")))[0], "pss"), pss=4)


def run_summary(spark, d):
    s = R.run_summary(*R.split_internal(rows(spark, d)), 8)
    return s.select("pipeline", *[F.round(c, 9).alias(c) for c in s.columns[1:]])


def task_stats(spark, d):
    return R.task_stats(R.split_internal(rows(spark, d))[0], ["pss", "uss", "cpu"])


def _deltas(spark, d):
    return R.first_delta(R.split_internal(rows(spark, d))[0], ["pipeline", "name", "timeframe"], "time", "event_id")


def first_seen_delta(spark, d):
    return _deltas(spark, d).select("event_id", "delta")


def lifetime_stats(spark, d):
    return rounded(R.lifetime_stats(_deltas(spark, d)), mean=4, std=4)


def last_seen(spark, d):
    return R.last_seen(rows(spark, d), ["pipeline", "raw"], "iter", "cpu")


def measurement_stats(spark, d):
    return rounded(R.measurement_stats(read(spark, d, "events"), "user_id", "value"), mean=6, std=6)


def _batches(spark, d):
    g = R.split_internal(rows(spark, d))[0].groupBy("name", "iter").agg(F.count("*").alias("count"), F.min("pss").alias("min"), F.max("pss").alias("max"), F.avg("pss").alias("mean"), F.stddev_pop("pss").alias("std"))
    return g.withColumn("metric", F.lit("pss"))


def merge_stats(spark, d):
    b = _batches(spark, d)
    both = R.merge_stats(b).withColumn("mode", F.lit("between")).unionByName(R.merge_stats(b, mode="full").withColumn("mode", F.lit("full")))
    return rounded(both.drop("m2"), min=3, max=3, mean=3, std=3)


def estimates(spark, d):
    r = rows(spark, d).where("not startswith(raw, '__')").select(F.col("raw").alias("name"), F.col("time").alias("walltime"), F.col("pss").alias("cpu"), (F.col("uss") * 100).alias("mem"))
    return rounded(R.estimates(r), walltime=4, cpu=4)


def feature_compare(spark, d):
    t = R.split_internal(rows(spark, d))[0]
    return rounded(R.feature_compare(t.withColumn("feature", F.concat(F.lit("p"), F.col("pipeline").cast("string"))), "feature", "pss", ["p0", "p1", "p2"]), p0=4, p1=4, p2=4)


def overlay_estimates(spark, d):
    p = read(spark, d, "part").select(F.concat_ws("_", "p_brand", (F.col("p_partkey") % 5).cast("string")).alias("name"), F.col("p_size").cast("double").alias("mem"), F.lit(1.0).alias("cpu"), F.col("p_retailprice").alias("walltime"), "p_partkey")
    p = p.withColumn("base", C.base_name(F.col("name")))
    learnt = p.where("mem > 49").groupBy("base").agg(F.max("mem").alias("mem_learnt"), F.avg("cpu").alias("cpu_learnt"), F.avg("walltime").alias("walltime_learnt"))
    return rounded(R.overlay_estimates(p, learnt), walltime=4)


def overlay_logs(spark, d):
    s = rows(spark, d).groupBy(F.col("raw").alias("name")).agg(F.max("time").alias("lifetime")).where("name <> 'view_1'")
    logs = rows(spark, d).where("pipeline = 1").groupBy(F.col("raw").alias("name")).agg(F.min("time").alias("lifetime"))
    return R.overlay_logs(s, logs)


def _usage(spark, d):
    r = rows(spark, d).where("not startswith(raw, '__')")
    samples = r.select("pipeline", "raw", F.floor(F.col("iter") / 3).alias("part"), "time", F.coalesce("cpu0", F.lit(-1.0)).alias("cpu"), F.col("pss").alias("mem"))
    assigned = samples.select("pipeline", "raw", "part").distinct().withColumns({"cpu_assigned": F.lit(2.0), "mem_assigned": F.lit(500.0)})
    return samples, assigned


def weighted_usage(spark, d):
    s, a = _usage(spark, d)
    s = s.groupBy("pipeline", "raw", "part", "time").agg(F.max("cpu").alias("cpu"), F.max("mem").alias("mem"))
    return rounded(R.weighted_usage(s, a, ["pipeline", "raw", "part"]), cpu=4, mem=4)


def sibling_usage(spark, d):
    s, a = _usage(spark, d)
    s = s.groupBy("pipeline", "raw", "part", "time").agg(F.max("cpu").alias("cpu"), F.max("mem").alias("mem"))
    u = R.weighted_usage(s, a, ["pipeline", "raw", "part"]).where("part < 5")
    group = a.groupBy("raw").agg(F.max("cpu_assigned").alias("cpu_assigned"), F.max("mem_assigned").alias("mem_assigned"))
    return rounded(R.sibling_usage(u, group, "raw"), cpu=4, mem=4)


def union_frames(spark, d):
    r = rows(spark, d)
    u = R.union(r.where("pipeline = 0").select("pipeline", "event_id", "pss"), r.where("pipeline = 1").select("pipeline", "event_id", "cpu"))
    return u.groupBy("pipeline").agg(F.count("*").alias("n"), F.count("pss").alias("pss"), F.count("cpu").alias("cpu"))


def task_filter(spark, d):
    e = events(spark, d).select("event_id", F.col("event_type").alias("name"), F.array(F.concat(F.lit("L"), (F.col("user_id") % 4).cast("string")), F.concat(F.lit("M"), (F.col("user_id") % 3).cast("string"))).alias("labels"))
    return R.by_task(e, ["c", "si.n"], ["L1", "M2"]).select("event_id", "name")


def numeric_text(spark, d):
    t = F.regexp_extract("props", r":\s*([^}]*)", 1)
    return read(spark, d, "events").select("event_id", C.coerce_numeric(t).alias("number"), C.coerce_numeric(F.col("event_type")).alias("none"))


def time_columns(spark, d):
    o = read(spark, d, "orders").withColumns({"bc": F.col("o_orderkey") * 9973 + F.col("o_custkey"), "reset": F.lit(1_700_000_000_000_000), "first": F.col("o_custkey") % 5})
    return o.select("o_orderkey", C.micros(F.col("bc"), F.col("reset")).alias("micros"), C.orbit(F.col("bc")).alias("orbit"), C.crossing_in_orbit(F.col("bc")).alias("crossing"), C.frame(F.col("bc"), F.col("first"), F.lit(32)).alias("frame"))


def interaction_rate(spark, d):
    o = read(spark, d, "orders").withColumn("system", F.get(F.array(*map(F.lit, ["pp", "PbPb", "OO", "xx"])), (F.col("o_custkey") % 4).cast("int"))).withColumn("energy", (F.col("o_custkey") % 9) * 1000.0)
    eff = C.efficiency(F.col("system"), F.col("energy"))
    return o.select("o_orderkey", eff.alias("efficiency"), F.round(C.true_rate(F.col("o_totalprice") * 10, eff, F.col("o_custkey") % 300 + 50), 2).alias("rate"))


def production_slots(spark, d):
    """One row per customer as job: an hour-long run, 100 frames a job."""
    c = read(spark, d, "customer").withColumns({"start": F.lit(1_700_000_000_000), "job": F.col("c_custkey") % 40, "cycle": F.col("c_custkey") % 7})
    at, slot, ok = C.production_slot(F.col("start"), F.col("start") + 3_600_000, F.col("job"), F.lit(40), F.col("cycle"), F.lit(100))
    return c.select("c_custkey", at.alias("at"), slot.alias("slot"), ok.alias("in_range"))


def amdahl_split(spark, d):
    x = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.concat(F.lit("run -x 1 -j "), F.col("l_linenumber").cast("string")).alias("cmd"))
    n = C.workers(F.when(F.col("l_linenumber") == 3, "run --tpc-lanes 8").when(F.col("l_linenumber") == 4, "none").otherwise(F.col("cmd")))
    s, p = C.amdahl(F.col("l_extendedprice"), F.col("l_quantity") / 10, n)
    return x.select("l_orderkey", "l_linenumber", n.alias("n"), F.round(s, 6).alias("serial"), F.round(p, 6).alias("parallel"))


K = "10 * 1e6::double / 400789598.0::double"
US = f"(3564::double * ({K}))"
WU = RW + """, s0 as (
  select pipeline, raw, iter // 3 as part, time, max(coalesce(cpu0, -1.0)) as cpu, max(pss) as mem from rw where raw not like '\\_\\_%' escape '\\' group by all
), s1 as (select *, time - lag(time) over (partition by pipeline, raw, part order by time) as dt from s0
), wu as (select pipeline, raw, part, case when count(*) < 3 then 2.0 else coalesce(sum(cpu * dt) filter (cpu >= 0), 0) / case when sum(dt) <> 0 then sum(dt) else 1.0 end end as cpu,
  case when count(*) < 3 then 500.0 else max(mem) end as mem from s1 group by all)"""

SQL = {
    "task_columns": f"with {RW} select event_id, name, timeframe, cpu, category from rw",
    "internal_rows": f"with {RW} select 'task' as kind, count(*) as n, sum(event_id)::bigint as ids from tk union all select 'slice', count(*), sum(event_id)::bigint from sl",
    "iter_dense": f"""with {RW}, g as (select pipeline, category, unnest(range(a, z + 1)) as iter from (select distinct pipeline, category from tk) join (select pipeline, min(iter) as a, max(iter) as z from tk group by 1) using (pipeline))
        select g.pipeline, g.iter, g.category, round(coalesce(sum(pss), 0), 4) as pss, round(coalesce(sum(cpu), 0), 4) as cpu from g left join tk on tk.pipeline = g.pipeline and tk.iter = g.iter and tk.category = g.category group by all""",
    "series_stats": f"""with {RW}, g as (select pipeline, unnest(range(min(iter), max(iter) + 1)) as iter from tk group by 1), s as (select g.pipeline, g.iter, coalesce(sum(pss), 0) as pss, coalesce(sum(cpu), 0) * 0.125 as cpu from g left join tk using (pipeline, iter) group by all)
        select pipeline, round(min(pss), 4) as pss_min, round(avg(pss), 4) as pss_mean, round(max(pss), 4) as pss_max, round(min(cpu), 4) as cpu_min, round(avg(cpu), 4) as cpu_mean, round(max(cpu), 4) as cpu_max from s group by 1""",
    "category_need": f"with {RW}, t as (select category, name, max(pss) as v from tk group by all) select category, round(sum(v), 4) as pss, count(*) as tasks from t group by 1",
    "task_need": f"with {RW} select name, round(max(pss), 4) as max, round(avg(pss), 4) as mean from tk where category = 'view' group by 1",
    "top_peaks": f"with {RW} select raw as name, round(max(pss), 4) as pss from rw where raw not like '\\_\\_%' escape '\\' group by raw order by max(pss) desc, raw limit 5",
    "run_summary": f"""with {RW}, t as (select pipeline, iter, sum(pss) as pss, sum(cpu) as cpu, max(time) as time, max(disc) as disc from tk group by all), s as (select pipeline, iter, max(cpu) as c from sl group by all),
        j as (select *, coalesce(c, cpu) as used from t left join s using (pipeline, iter))
        select pipeline, round(avg(pss), 9) as pss_mean, round(max(pss), 9) as pss_max, round(avg(used), 9) as cpu_mean, round(max(used), 9) as cpu_max, round(avg(used) / 8, 9) as efficiency, max(time) - min(time) as wall, round(max(disc) - min(disc), 9) as disc from j group by 1""",
    "task_stats": f"""with {RW} select name, round(min(pss), 3) as pss_min, round(max(pss), 3) as pss_max, round(avg(pss), 3) as pss_mean, round(min(uss), 3) as uss_min, round(max(uss), 3) as uss_max, round(avg(uss), 3) as uss_mean,
        round(min(cpu), 3) as cpu_min, round(max(cpu), 3) as cpu_max, round(avg(cpu), 3) as cpu_mean from tk group by 1""",
    "first_seen_delta": f"with {RW} select event_id, time - first_value(time) over (partition by pipeline, name, timeframe order by event_id) as delta from tk",
    "lifetime_stats": f"""with {RW}, dl as (select *, time - first_value(time) over (partition by pipeline, name, timeframe order by event_id) as delta from tk), l as (select name, timeframe, max(delta) as t from dl where nice <> 19 group by all)
        select name, min(t) as min, max(t) as max, round(avg(t), 4) as mean, round(stddev_samp(t), 4) as std, count(*) as n from l group by 1""",
    "last_seen": f"with {RW} select pipeline, raw, max(iter) filter (cpu <> 0) as last_iter from rw group by all",
    "measurement_stats": "select user_id, min(value) as min, max(value) as max, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std from events group by 1",
    "merge_stats": f"""with {RW}, b as (select name, iter, count(*) as c, min(pss) as lo, max(pss) as hi, avg(pss) as m, stddev_pop(pss) as s from tk group by all), g as (select name, sum(c) as n, sum(c * m) / sum(c) as m from b group by 1)
        select name, 'pss' as metric, u.mode, any_value(n)::bigint as count, round(min(lo), 3) as min, round(max(hi), 3) as max, round(any_value(g.m), 3) as mean,
               round(sqrt(sum(c * (b.m - g.m) ^ 2 + case when u.mode = 'full' then c * s * s else 0 end) / any_value(n)), 3) as std
        from b join g using (name), (select unnest(['between', 'full']) as mode) u group by name, u.mode""",
    "estimates": f"""with {RW} select split_part(raw, '_', 1) as task, round(avg(time), 4) as walltime, round(avg(pss) / 100, 4) as cpu, ceil(max(uss * 100) / 1024)::bigint as mem from rw where raw not like '\\_\\_%' escape '\\' group by 1""",
    "feature_compare": f"with {RW} select name, round(max(pss) filter (pipeline = 0), 4) as p0, round(max(pss) filter (pipeline = 1), 4) as p1, round(max(pss) filter (pipeline = 2), 4) as p2 from tk group by 1",
    "overlay_estimates": """with p as (select *, p_brand || '_' || p_partkey % 5 as name from part), l as (select p_brand, max(p_size)::double as m, avg(p_retailprice) as w from part where p_size > 49 group by 1)
        select name, p_brand as base, coalesce(m, p_size::double) as mem, 1.0::double as cpu, round(coalesce(w, p_retailprice), 4) as walltime from p left join l using (p_brand)""",
    "overlay_logs": f"""with {RW}, s as (select raw as name, max(time) as a from rw where raw <> 'view_1' group by 1), l as (select raw as name, min(time) as b from rw where pipeline = 1 group by 1)
        select name, coalesce(b, a) as lifetime from s full join l using (name)""",
    "weighted_usage": f"with {WU} select pipeline, raw, part, round(cpu, 4) as cpu, round(mem, 4) as mem from wu",
    "sibling_usage": f"""with {WU}, g as (select raw, avg(cpu) as c, max(mem) as m from wu where part < 5 group by 1)
        select raw, round(case when c > 0 then c else 2.0 end, 4)::double as cpu, round(case when m > 0 then m else 500.0 end, 4)::double as mem from (select distinct raw from wu) left join g using (raw)""",
    "union_frames": f"with {RW} select pipeline, count(*) as n, count(case when pipeline = 0 then pss end) as pss, count(case when pipeline = 1 then cpu end) as cpu from rw where pipeline < 2 group by 1",
    "task_filter": "select event_id, event_type as name from events where regexp_matches(event_type, '^(c|si.n)') and (user_id % 4 = 1 or user_id % 3 = 2)",
    "numeric_text": "select event_id, try_cast(regexp_extract(props, ':\\s*([^}]*)', 1) as double) as number, try_cast(event_type as double) as none from events",
    "time_columns": f"""with x as (select *, o_orderkey * 9973 + o_custkey as bc from orders)
        select o_orderkey, 1700000000000000 + trunc(bc * ({K}))::bigint as micros, bc // 3564 as orbit, bc % 3564 as crossing, trunc((bc - o_custkey % 5 * 3564) / (32 * 3564))::bigint as frame from x""",
    "interaction_rate": """with x as (select *, ['pp', 'PbPb', 'OO', 'xx'][o_custkey % 4 + 1] as s, o_custkey % 9 * 1000.0 as e, o_custkey % 300 + 50 as b from orders),
        y as (select *, (case when s = 'pp' then case when e < 1000 then 0.68 when e < 6000 then 0.737 else 0.759 end when s = 'PbPb' then 28.0 when s = 'OO' then 0.8677 else 0.759 end)::double as f, o_totalprice * 10 / 11245.0::double / b as share from x)
        select o_orderkey, f as efficiency, round(case when share < 1 then b * (-ln(1 - share) / f) * 11245.0::double end, 2) as rate from y""",
    "production_slots": f"""with x as (select *, 3600000 * 1000::bigint / (256 * {US}) / 40 as per, c_custkey % 40 as job, c_custkey % 7 as cycle from customer),
        y as (select *, trunc(job * (per / 100))::bigint + cycle as slot from x), z as (select *, 1700000000000 + slot * 100 * (256 * {US}) / 1000 as at0 from y)
        select c_custkey, trunc(at0)::bigint as at, slot, 100 <= per and at0 between 1700000000000 and 1700003600000 as in_range from z""",
    "amdahl_split": """with x as (select *, case when l_linenumber = 3 then 8 when l_linenumber <> 4 then l_linenumber end as n, l_quantity / 10 as c from lineitem),
        y as (select *, n > 1 and l_extendedprice > 0 and c >= 1 and c <= n as ok from x)
        select l_orderkey, l_linenumber, n, case when ok then round(l_extendedprice * (n - c) / (n - 1), 6) end as serial, case when ok then round(l_extendedprice * n * (c - 1) / (n - 1), 6) end as parallel from y""",
}
QUERIES = {name: globals()[name] for name in SQL}
