"""As-of, sliding and interval queries over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, intervals, predicates
from .tables import read, rounded


def events(spark, d):
    """Events with whole seconds since 2024 began."""
    return read(spark, d, "events").withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200)


EV = "ev as (select *, epoch_us(ts) // 1000000 - 1704067200 as sec from events)"


def _two(spark, d):
    e = events(spark, d)
    return e.select("event_id", "user_id", "sec"), e.where("event_type = 'click'").select("user_id", "sec", F.col("event_id").alias("other"))


def asof_1d(spark, d):
    a, b = _two(spark, d)
    return asof.nearest(a.drop("user_id"), b, "sec", "other")


def asof_nd(spark, d):
    a, b = _two(spark, d)
    asof.register_lookup("by_user", b, "sec", "other", ["user_id"])
    try:
        return asof.lookup(a, "by_user", "nearest")
    finally:
        asof.unregister_lookup(b, "by_user")


def _asof_sql(on: str) -> str:
    return f"""with {EV}, a as (select event_id, user_id, sec from ev),
      b as (select {'user_id, ' if on else ''}sec, max(event_id) as other from ev where event_type = 'click' group by all),
      lo as (select a.event_id, b.sec as x, b.other as v from a asof left join b on {on} a.sec >= b.sec),
      hi as (select a.event_id, b.sec as x, b.other as v from a asof left join b on {on} a.sec <= b.sec)
      select a.event_id, {'a.user_id, ' if on else ''}a.sec, case when hi.x is null or a.sec - lo.x < hi.x - a.sec then lo.v else hi.v end as nearest
      from a join lo using (event_id) join hi using (event_id)"""


def sliding_stats(spark, d):
    e = events(spark, d).select("event_id", "event_type", "sec", "value")
    return rounded(asof.sliding(e, "sec", "value", 86400, ["event_type"], order="event_id").drop("sec", "value"), mean=6, std=6)


def sliding_median(spark, d):
    e = events(spark, d).select("event_id", "event_type", "sec", "value")
    return asof.sliding(e, "sec", "value", 3600, ["event_type"], ("median",), "event_id").drop("sec", "value")


def sliding_median_wide(spark, d):
    """Medians over ten days around each event: spans of far more points than are gathered."""
    e = events(spark, d).select("event_id", "event_type", "sec", "value")
    return asof.sliding(e, "sec", "value", 432000, ["event_type"], ("median",), "event_id").drop("sec", "value")


STEP, MARGIN = 86400, 3600


def _labels(spark, d):
    """A label per user and day with activity."""
    e = events(spark, d)
    return e.groupBy((F.col("user_id") % 10).alias("run"), "user_id", F.floor(F.col("sec") / 43200).alias("half")).agg(F.min("sec").alias("lo"), F.max("sec").alias("hi"))


LB = EV + ", lb as (select user_id % 10 as run, user_id, sec // 43200 as half, min(sec) as lo, max(sec) as hi from ev group by all)"
PW = (
    LB
    + f""", r as (select run, min(lo) as first, max(hi) as last from lb group by run), nn as (
  select *, case when last <= first then 1 else greatest(1, (last - first) // {STEP}) + case when (last - first - greatest(1, (last - first) // {STEP}) * {STEP}) * 2 >= {STEP} then 1 else 0 end end as n from r
), w0 as (select *, unnest(range(n)) as "window" from nn), w1 as (
  select run, "window", first + "window" * {STEP} as ws, case when "window" + 1 = n then last else first + ("window" + 1) * {STEP} - 1 end as we from w0
), pw as (select *, least({MARGIN}, (we - ws) // 10) as margin from w1)"""
)


def window_plan(spark, d):
    return intervals.plan_windows(_labels(spark, d), STEP, MARGIN)


def overlap_assign(spark, d):
    w = intervals.plan_windows(_labels(spark, d), STEP, MARGIN)
    return intervals.overlap(_labels(spark, d), w, ["run"], "margin").select("run", "user_id", "half", "window")


def overlap_grazed(spark, d):
    """Labels per window that touch it, and those whose overlap is within its margin."""
    w = intervals.plan_windows(_labels(spark, d), STEP, MARGIN)
    j = intervals.overlap(_labels(spark, d), w, ["run"], inclusive=True)
    grazed = F.least("hi", "we") - F.greatest("lo", "ws") <= F.col("margin")
    return j.groupBy("run", "window").agg(F.count("*").alias("touching"), F.count_if(grazed).alias("grazed"))


def exclude_intervals(spark, d):
    lb = _labels(spark, d).where("half % 5 = 0").select("run", "lo", "hi")
    e = events(spark, d).select("event_id", (F.col("user_id") % 10).alias("run"), "sec")
    return intervals.exclude_points(e, lb, "sec", "run")


BANDS = [(0.0, 100000.0, 32), (100000.0, 200000.0, 16), (150000.0, 400000.0, 8)]


def range_lookup(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return intervals.range_lookup(intervals.range_lookup(o, BANDS, "o_totalprice", "orbits"), 128, "o_totalprice", "fixed").drop("o_totalprice")


def run_lookup(spark, d):
    s = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("lo"), (F.col("c_custkey") + 59).alias("hi"), F.col("c_mktsegment").alias("setting"))
    return intervals.run_lookup(read(spark, d, "orders").select("o_orderkey", "o_custkey"), s, "o_custkey")


def run_lookup_repeated(spark, d):
    """As ``run_lookup`` on rows most of which are repeated, with ranges of very different lengths."""
    c = F.col("c_custkey")
    s = read(spark, d, "customer").where("c_custkey % 3 > 0").select(c.alias("lo"), (c + F.when(c % 10 == 1, 1_000_000_000).otherwise(c % 7)).alias("hi"), F.concat(F.lit("s"), c.cast("string")).alias("setting"))
    return intervals.run_lookup(read(spark, d, "lineitem").select("l_returnflag", "l_suppkey"), s, "l_suppkey")


def skim(spark, d):
    e = events(spark, d)
    f = e.where("event_type = 'signup'").select(F.col("sec").alias("lo"), (F.col("sec") + F.col("user_id") % 20).alias("hi"))
    return intervals.skim(e.select("event_id", "sec"), f, "sec")


def interval_units(spark, d):
    p = _labels(spark, d).withColumns({"start": F.lit(1000), "lo": F.when(F.col("run") < 5, F.col("lo")).otherwise(F.col("lo") + 5_000_000), "hi": F.col("hi") + 5_000_000})
    return intervals.to_orbits(p, 3_000_000, "start", 11.245).select("run", "user_id", "half", "lo", "hi")


def distance_order(spark, d):
    o = read(spark, d, "orders").withColumn("at", (F.col("o_custkey") % 100) / 40 - 0.5).withColumn("value", F.when(F.col("o_custkey") % 17 > 0, F.col("o_orderkey")))
    return rounded(intervals.order_by_distance(o.select("o_custkey", "at", "value"), "at", "value", "o_custkey").select("o_custkey", "value", "distance", "rank"), distance=4)


def consecutive_runs(spark, d):
    o = read(spark, d, "orders").withColumn("blocks", F.col("o_custkey") % 3)
    return intervals.consecutive(o.select("o_orderkey", "o_custkey", "blocks"), "o_orderkey", 100, 25, "blocks", 1)


def events_before(spark, d):
    """Events before each frame and the offset of the file: a running sum that ends one frame earlier."""
    g = events(spark, d).groupBy((F.col("user_id") % 10).alias("run"), F.floor(F.col("sec") / 86400).alias("frame")).agg(F.count("*").alias("n"))
    return predicates.events_before(g, "run", "frame", "n", 7)


SQL = {
    "asof_1d": _asof_sql(""),
    "asof_nd": _asof_sql("a.user_id = b.user_id and"),
    "sliding_stats": f"""with {EV}, p as (select event_type, sec, arg_max(value, event_id) as v from ev group by all),
        s as (select event_type, sec, round(avg(v) over w, 6) as mean, round(stddev_samp(v) over w, 6) as std from p
              window w as (partition by event_type order by sec range between 86400 preceding and 86400 following))
        select event_id, event_type, mean, std from ev join s using (event_type, sec)""",
    "sliding_median": f"""with {EV}, p as (select event_type, sec, arg_max(value, event_id) as v from ev group by all),
        x as (select event_type, sec, list_sort(list(v) over (partition by event_type order by sec range between 3600 preceding and 3600 following)) as l from p)
        select event_id, event_type, l[len(l) // 2 + 1] as median from ev join x using (event_type, sec)""",
    "sliding_median_wide": f"""with {EV}, p as (select event_type, sec, arg_max(value, event_id) as v from ev group by all),
        x as (select event_type, sec, list_sort(list(v) over (partition by event_type order by sec range between 432000 preceding and 432000 following)) as l from p)
        select event_id, event_type, l[len(l) // 2 + 1] as median from ev join x using (event_type, sec)""",
    "window_plan": f"with {PW} select * from pw",
    "overlap_assign": f"""with {PW} select run, user_id, half, "window" from lb join pw using (run) where hi >= ws and lo <= we and least(hi, we) - greatest(lo, ws) > margin""",
    "overlap_grazed": f"""with {PW} select run, "window", count(*) as touching, count(*) filter (least(hi, we) - greatest(lo, ws) <= margin) as grazed from lb join pw using (run) where hi >= ws and lo <= we group by all""",
    "exclude_intervals": f"""with {LB} select event_id, user_id % 10 as run, sec from ev where not exists (select 1 from lb where half % 5 = 0 and lb.run = ev.user_id % 10 and ev.sec between lb.lo and lb.hi)""",
    "range_lookup": "select o_orderkey, (case when o_totalprice >= 0 and o_totalprice < 100000 then 32 when o_totalprice < 200000 then 16 when o_totalprice < 400000 then 8 else -1 end)::int as orbits, 128 as fixed from orders",
    "run_lookup": "select o_orderkey, o_custkey, arg_max(c_mktsegment, c_custkey) as setting from orders left join customer on c_mktsegment = 'BUILDING' and o_custkey between c_custkey and c_custkey + 59 group by all",
    "run_lookup_repeated": """with l as (select row_number() over () as r, l_returnflag, l_suppkey from lineitem), s as (select c_custkey as lo, c_custkey + case when c_custkey % 10 = 1 then 1000000000 else c_custkey % 7 end as hi from customer where c_custkey % 3 > 0),
        k as (select l_suppkey, max(lo) as lo from (select distinct l_suppkey from l) join s on l_suppkey between lo and hi group by 1) select l_returnflag, l_suppkey, 's' || lo as setting from l left join k using (l_suppkey)""",
    "skim": f"with {EV} select distinct a.event_id, a.sec from ev a join ev f on f.event_type = 'signup' and a.sec between f.sec - 55 and f.sec + f.user_id % 20 + 55",
    "interval_units": f"""with {LB}, p as (select run, user_id, half, case when run < 5 then lo else lo + 5000000 end as lo, hi + 5000000 as hi from lb)
        select run, user_id, half, case when lo > 3000000 then floor((lo - 1000) * 11.245::double)::bigint else lo end as lo, floor((hi - 1000) * 11.245::double)::bigint as hi from p""",
    "distance_order": """with o as (select o_custkey, (o_custkey % 100) / 40 - 0.5 as pos, case when o_custkey % 17 > 0 then o_orderkey end as value from orders),
        g as (select o_custkey, min(value) as lo, max(value) as hi from o group by 1 having count(*) = count(value)),
        j as (select o_custkey, value, abs(value - (lo + least(1.0, greatest(0.0, pos)) * (hi - lo)))::double as distance from o join g using (o_custkey))
        select o_custkey, value, round(distance, 4) as distance, row_number() over (partition by o_custkey order by distance, value)::int as rank from j""",
    "consecutive_runs": "select o_orderkey, o_custkey, o_custkey % 3 as blocks from orders where o_orderkey >= 100 and o_custkey % 3 = 1 order by 1 limit 25",
    "events_before": f"""with {EV}, g as (select user_id % 10 as run, sec // 86400 as frame, count(*) as n from ev group by all)
        select run, frame, n, (7 + coalesce(sum(n) over (partition by run order by frame rows between unbounded preceding and 1 preceding), 0))::bigint as before from g""",
}
QUERIES = {name: globals()[name] for name in SQL}
