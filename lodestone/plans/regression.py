"""Histogram regression queries: two samples of lineitem compared, and metrics over months of orders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import durable, hist, relval
from ..sources import sinks
from .tables import read, rounded

COLS = ["l_quantity", "l_extendedprice", "l_discount"]
BINS = 50


def _values(spark, d, keys=("l_returnflag",)):
    return hist.long_form(read(spark, d, "lineitem").select(*keys, *COLS), COLS, list(keys))


def _axes(spark, d):
    return hist.axes_from(_values(spark, d, ()), BINS)


def _hist(spark, d, flag: str) -> DataFrame:
    return hist.fill(_values(spark, d).where(F.col("l_returnflag") == flag).select("object", "x"), _axes(spark, d))


def _metrics(spark, d) -> DataFrame:
    return hist.compare(_hist(spark, d, "A"), _hist(spark, d, "N"))


VALS = """
vals as (
  select l_returnflag, l_linestatus, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) as object, unnest([l_quantity, l_extendedprice, l_discount]) as x from lineitem
), axes as (
  select object, min(x) as lo, min(x) + (max(x) - min(x)) * (1 + 0.1 / 50) as hi from vals where x is not null group by object
), binned as (
  select l_returnflag, l_linestatus, object, lo, hi,
         case when x < lo then 0 when x >= hi then 51 else least(floor((x - lo) / (hi - lo) * 50)::int + 1, 50) end as bin
  from vals join axes using (object) where x is not null
)"""
PAIR = (
    VALS
    + """, ha as (
  select object, bin, count(*)::double as c from binned where l_returnflag = 'A' group by all
), hb as (
  select object, bin, count(*)::double as c from binned where l_returnflag = 'N' group by all
), pairs as (
  select object, bin, coalesce(ha.c, 0) as n, coalesce(hb.c, 0) as m from ha full join hb using (object, bin)
), sums as (
  select object, sum(n) as sa, sum(m) as sb, max(abs(n - m)) as max_diff from pairs group by object
), chi as (
  select object, case when count(*) > 1 then sum((sb * n - sa * m) ^ 2 / (n + m)) / (any_value(sa) * any_value(sb)) / (count(*) - 1) end as value
  from pairs join sums using (object) group by object
), gaps as (
  select object, abs(sum(n) over w / sa - sum(m) over w / sb) as gap, sa * sb / (sa + sb) as size from pairs join sums using (object) window w as (partition by object order by bin)
), ks0 as (
  select object, max(gap) as distance, max(gap) * sqrt(any_value(size)) as z from gaps group by object
), ks as (
  select object, distance, case when z < 0.2 then 1
    when z < 0.755 then 1 - sqrt(2 * pi()) / z * (exp(-(pi() ^ 2) / (8 * z * z)) + exp(-9 * (pi() ^ 2) / (8 * z * z)) + exp(-25 * (pi() ^ 2) / (8 * z * z)))
    when z > 6.8116 then 0
    else 2 * exp(-2 * z * z) - 2 * exp(-8 * z * z) + 2 * exp(-18 * z * z) - 2 * exp(-32 * z * z) end as value
  from ks0
), met as (
  select object, 'test_chi2' as metric, value, 1.5 as threshold, true as lower_is_better from chi
  union all select object, 'test_kolmogorov', value, 0.5, false from ks
  union all select object, 'test_num_entries', abs(sa - sb) / ((sa + sb) / 2), 0.1, true from sums
), res as (
  select *, case when lower_is_better then value <= threshold else value >= threshold end as passed from met
), verd as (
  select *, case when passed then 'GOOD' else 'BAD' end as verdict from res
)"""
)


def hist_fill(spark, d):
    return hist.fill(_values(spark, d), _axes(spark, d), ["l_returnflag"]).select("l_returnflag", "object", "bin", "content")


def hist_merge(spark, d):
    h = [hist.fill(_values(spark, d, ("l_linestatus",)).where(F.col("l_linestatus") == s).select("object", "x"), _axes(spark, d)) for s in ("O", "F")]
    return hist.merge(*h).select("object", "bin", "content", "sumw2")


def hist_efficiency(spark, d):
    v = _values(spark, d, ("l_linestatus",))
    passed = hist.fill(v.where("l_linestatus = 'F'").select("object", "x"), _axes(spark, d))
    return rounded(hist.efficiency(passed, hist.fill(v.select("object", "x"), _axes(spark, d))), ratio=6, error=6)


def hist_compare(spark, d):
    a, b = _hist(spark, d, "A"), _hist(spark, d, "N")
    t = hist.identical(hist.comparable(hist.totals(hist.pair(a, b))))
    return t.select("object", "code", "sum_a", "sum_b", "max_diff", "identical")


def hist_presence(spark, d):
    a = _hist(spark, d, "A").where("object <> 'l_discount'")
    return hist.presence(a, _hist(spark, d, "N").where("object <> 'l_quantity'"))


def hist_metrics(spark, d):
    return rounded(_metrics(spark, d).select("object", "metric", "value", "comparable", "threshold", "lower_is_better"), value=6)


def hist_ks(spark, d):
    a, b = _hist(spark, d, "A"), _hist(spark, d, "N")
    p = hist.pair(a, b)
    return rounded(hist.kolmogorov(p, hist.totals(p)), distance=6, value=6)


def hist_flat_names(spark, d):
    path = F.concat_ws("/", F.lit("top"), F.concat(F.lit("DF_"), F.col("o_orderkey").cast("string")), F.col("o_orderpriority"), F.lit("pt.eta"))
    return read(spark, d, "orders").groupBy(hist.flat_name(path).alias("name")).agg(F.count("*").alias("n"))


def relval_verdict(spark, d):
    m = _metrics(spark, d)
    r = relval.interpret(relval.test(m))
    return rounded(relval.ordered(r.select("object", "metric", "test", "value", "mean", "n_sigmas", "passed", "verdict")), value=6)


def result_rows(spark, d):
    """The verdicts written as annotated result objects and read back."""
    m = _metrics(spark, d)
    r = relval.interpret(relval.test(m)).select("object", "metric", "verdict")
    path = f"{durable.folder(spark)}/results-{uuid.uuid4().hex}"
    sinks.write_results(r, path, {"release": "next"})
    return sinks.read_results(spark, path, "object string, metric string, verdict string, release string")


def relval_registered(spark, d):
    """A metric of one's own beside a built-in one."""
    hist.register_metric("all_entries", lambda p, t, key: t.select(*key, (F.col("sum_a") + F.col("sum_b")).alias("value")), 1000.0, False)
    try:
        m = hist.compare(_hist(spark, d, "A"), _hist(spark, d, "N"), ["all_entries", "test_num_entries"])
    finally:
        hist.unregister_metric("all_entries")
    return rounded(m.select("object", "metric", "value", "threshold", "lower_is_better"), value=6)


def relval_callbacks(spark, d):
    """Verdicts by a function of one's own, and the rows that a condition picks."""
    m = _metrics(spark, d)
    own = relval.interpret(relval.test(m), function=lambda r: F.when(r["passed"], F.lit("SAME")).otherwise(F.lit("DIFFERENT")))
    return relval.query(own, lambda r: r["metric"] != "test_chi2").select("object", "metric", "verdict")


def relval_noncritical(spark, d):
    m = _metrics(spark, d)
    r = relval.interpret(relval.test(m, {"test_num_entries": 0.001}), ["test_chi2"])
    return r.select("object", "metric", "mean", "passed", "verdict")


def relval_summary(spark, d):
    m = _metrics(spark, d)
    return rounded(relval.summary(relval.interpret(relval.test(m))), percent=4)


def relval_matrix(spark, d):
    m = _metrics(spark, d)
    r = relval.interpret(relval.test(m))
    return relval.matrix(r, "threshold_default", ["test_chi2", "test_kolmogorov", "test_num_entries"])


def _order_metrics(spark, d) -> DataFrame:
    """A metric per priority and month: the mean price against the overall mean; lower is better."""
    o = read(spark, d, "orders").select(F.col("o_orderpriority").alias("object"), F.date_trunc("month", "o_orderdate").alias("month"), "o_totalprice")
    g = o.groupBy("object", "month").agg(F.avg("o_totalprice").alias("m"), F.count("*").alias("n"))
    value = F.array(F.struct(F.lit("mean_price").alias("metric"), (F.col("m") / 100000).alias("value")), F.struct(F.lit("entries").alias("metric"), (F.col("n") / 10.0).alias("value")))
    out = g.select("object", "month", F.explode(value).alias("v")).select("object", "month", "v.metric", "v.value")
    return out.select("*", (F.col("value") > 0).alias("comparable"), F.lit(0.02).alias("threshold"), F.lit(True).alias("lower_is_better"), F.lit(None).cast("string").alias("note"))


ORDER_METRICS = """
om as (
  select o_orderpriority as object, date_trunc('month', o_orderdate) as month, avg(o_totalprice) / 100000 as mp, count(*) / 10.0 as en from orders group by all
), metrics as (
  select object, month, unnest(['mean_price', 'entries']) as metric, unnest([mp::double, en::double]) as value, 0.02 as threshold from om
)"""


def relval_user_limits(spark, d):
    m = _order_metrics(spark, d)
    both = relval.user_limits(m, "mean", 0.1).withColumn("combine", F.lit("mean")).unionByName(relval.user_limits(m, "extreme", 0.2).withColumn("combine", F.lit("extreme")))
    return rounded(both.drop("test"), mean=5, low=5, high=5)


def relval_regions(spark, d):
    return rounded(relval.region_limits(_order_metrics(spark, d)), mean=5, low=5, high=5)


def relval_sigmas(spark, d):
    m = _order_metrics(spark, d)
    r = relval.test(m, relval.region_limits(m).where("test = 'regions_loose'"))
    return rounded(r.select("object", F.date_format("month", "yyyy-MM").alias("month"), "metric", "passed", "n_sigmas"), n_sigmas=4)


def relval_value_histogram(spark, d):
    return relval.value_histogram(_order_metrics(spark, d), 100)


def relval_side_by_side(spark, d):
    m = _order_metrics(spark, d)
    year = lambda y: m.where(F.year("month") == y).groupBy("object", "metric").agg(F.avg("value").alias("value"))
    return rounded(relval.side_by_side({"y1996": year(1996), "y1997": year(1997)}), y1996=5, y1997=5)


def relval_dedup(spark, d):
    return rounded(relval.dedup(_order_metrics(spark, d), "month").select("object", "metric", "value"), value=5)


def _year_results(spark, d, year: int) -> DataFrame:
    m = _order_metrics(spark, d).where(F.year("month") == year)
    m = m.groupBy("object", "metric").agg(F.avg("value").alias("value")).withColumn("object", F.concat_ws("/", "object", F.floor(F.round(F.col("value") * 40, 6) % 4).cast("string")))
    m = m.select("*", F.lit(True).alias("comparable"), F.lit(1.5).alias("threshold"), F.lit(True).alias("lower_is_better"), F.lit(None).cast("string").alias("note"))
    return relval.interpret(relval.test(m))


def relval_diff(spark, d):
    return relval.diff(_year_results(spark, d, 1996), _year_results(spark, d, 1997))


def relval_common_names(spark, d):
    return relval.common_names(_year_results(spark, d, 1996), _year_results(spark, d, 1997), "object")


def pattern_filter(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.col("p_type").alias("object"), F.col("p_brand").alias("metric"))
    kept = relval.by_pattern(p, "object", include=["^STAND", "BRASS$"])
    dropped = relval.by_pattern(p, "object", exclude=["^STAND", "TIN"])
    named = relval.by_metric(p, enable=["Brand#1", "Brand#12", "Brand#13"], disable=["Brand#13"])
    parts = [x.groupBy().agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys")).withColumn("rule", F.lit(r)) for r, x in (("include", kept), ("exclude", dropped), ("metric", named))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


YEAR = ORDER_METRICS + """, yr as (
  select object || '/' || floor(round(avg(value) * 40, 6) % 4)::int as object, metric, avg(value) as value, year(month) as y from metrics where year(month) in (1996, 1997) group by metrics.object, metric, year(month)
), yres as (
  select distinct y, object, metric, 'threshold_default' as test, case when value <= 1.5 then 'GOOD' else 'BAD' end as verdict from yr
)"""

SQL = {
    "hist_fill": f"with {VALS} select l_returnflag, object, bin, count(*)::double as content from binned group by all",
    "hist_merge": f"with {VALS} select object, bin, count(*)::double as content, count(*)::double as sumw2 from binned where l_linestatus in ('O', 'F') group by all",
    "hist_efficiency": f"""with {VALS}, h as (select object, bin, count(*) filter (l_linestatus = 'F')::double as num, count(*)::double as den from binned group by all)
        select object, bin, num, den, round(num / den, 6) as ratio, round(sqrt(num / den * (1 - num / den) / den), 6) as error from h""",
    "hist_compare": f"with {PAIR} select object, 'ok' as code, sa as sum_a, sb as sum_b, max_diff, sa = sb and max_diff <= 1e-5 as identical from sums",
    "hist_presence": "select unnest(['l_discount', 'l_extendedprice', 'l_quantity']) as object, unnest(['only_second', 'both', 'only_first']) as status",
    "hist_metrics": f"with {PAIR} select object, metric, round(value, 6) as value, true as comparable, threshold::double as threshold, lower_is_better from met",
    "hist_ks": f"with {PAIR} select object, round(distance, 6) as distance, round(value, 6) as value from ks",
    "hist_flat_names": "select 'top_DF_' || o_orderpriority || '_pt_eta' as name, count(*) as n from orders group by 1",
    "relval_verdict": f"""with {PAIR} select object, metric, 'threshold_default' as test, round(value, 6) as value, threshold::double as mean, null::double as n_sigmas, passed, verdict from verd""",
    "result_rows": f"with {PAIR} select object, metric, verdict, 'next' as release from verd",
    "relval_registered": f"""with {PAIR} select object, metric, round(value, 6) as value, threshold::double as threshold, lower_is_better from met where metric = 'test_num_entries'
        union all select object, 'all_entries', (sa + sb)::double, 1000.0::double, false from sums""",
    "relval_callbacks": f"with {PAIR} select object, metric, case when passed then 'SAME' else 'DIFFERENT' end as verdict from verd where metric <> 'test_chi2'",
    "relval_noncritical": f"""with {PAIR}, t as (select *, case when metric = 'test_num_entries' then 0.001 else threshold end as mean from met),
        p as (select object, metric, mean::double as mean, case when lower_is_better then value <= mean else value >= mean end as passed from t)
        select *, case when passed then 'GOOD' when metric = 'test_chi2' then 'BAD' else 'WARNING' end as verdict from p""",
    "relval_summary": f"""with {PAIR}, g as (select metric, 'threshold_default' as test, verdict from (select distinct metric from verd),
        (select unnest(['GOOD', 'WARNING', 'NONCRIT_NC', 'CRIT_NC', 'BAD', 'UNKNOWN']) as verdict))
        select metric, test, g.verdict, count(v.object) as n, round(100.0 * count(v.object) / (select count(distinct object) from verd), 4)::double as percent
        from g left join verd v using (metric, verdict) group by all""",
    "relval_matrix": f"""with {PAIR} select object, max(verdict) filter (metric = 'test_chi2') as test_chi2, max(verdict) filter (metric = 'test_kolmogorov') as test_kolmogorov,
        max(verdict) filter (metric = 'test_num_entries') as test_num_entries from verd group by object""",
    "relval_user_limits": f"""with {ORDER_METRICS}, g as (select object, metric, avg(value) filter (value > 0) as a, max(value) filter (value > 0) as w from metrics group by all)
        select object, metric, 'mean' as combine, round(a, 5) as mean, null::double as low, round(a * 0.1, 5) as high from g
        union all select object, metric, 'extreme', round(w, 5), null, round(w * 0.2, 5) from g""",
    "relval_regions": f"""with {ORDER_METRICS}, o as (select *, value > threshold and abs(threshold / (value - threshold)) < 0.1 as o, value > 0 as ok from metrics),
        g as (select object, metric, avg(value) filter (ok and not o) as mc, stddev_pop(value) filter (ok and not o) as sc, avg(value) filter (ok and o) as mo, stddev_pop(value) filter (ok and o) as so from o group by all)
        select object, metric, 'regions_tight' as test, round(mc, 5) as mean, round(sc, 5) as low, round(sc, 5) as high from g
        union all select object, metric, 'regions_loose', round(mo, 5), round(so, 5), round(so, 5) from g""",
    "relval_sigmas": f"""with {ORDER_METRICS}, o as (select *, value > threshold and abs(threshold / (value - threshold)) < 0.1 and value > 0 as o from metrics),
        g as (select object, metric, avg(value) filter (o) as mo, stddev_pop(value) filter (o) as so from o group by all)
        select object, strftime(month, '%Y-%m') as month, metric, case when mo is not null then value between mo - so and mo + so end as passed,
               round(case when so <> 0 then abs(mo - value) / so end, 4) as n_sigmas from metrics join g using (object, metric)""",
    "relval_value_histogram": f"""with {ORDER_METRICS}, s as (select metric, min(value) as lo, max(value) as hi from metrics where value > 0 group by metric)
        select metric, least(floor((value - lo) / (hi - lo) * 100), 99)::int as bin, count(*) as n from metrics join s using (metric) where value > 0 group by all""",
    "relval_side_by_side": f"""with {ORDER_METRICS} select object, metric, round(avg(value) filter (year(month) = 1996), 5) as y1996, round(avg(value) filter (year(month) = 1997), 5) as y1997
        from metrics where year(month) in (1996, 1997) group by all""",
    "relval_dedup": f"with {ORDER_METRICS} select object, metric, round(arg_min(value, month), 5) as value from metrics group by all",
    "relval_diff": f"""with {YEAR}, j as (select metric, test, verdict, object, bool_or(y = 1996) as x, bool_or(y = 1997) as z from yres group by all)
        select metric, test, verdict, count(*) filter (x and z) as common, count(*) filter (not z) as only_first, count(*) filter (not x) as only_second from j group by all""",
    "relval_common_names": f"with {YEAR} select object from yres where y = 1996 intersect select object from yres where y = 1997",
    "pattern_filter": """select 'include' as rule, count(*) as n, sum(p_partkey)::bigint as keys from part where regexp_matches(p_type, '^STAND|BRASS$')
        union all select 'exclude', count(*), sum(p_partkey)::bigint from part where not regexp_matches(p_type, '^STAND|TIN')
        union all select 'metric', count(*), sum(p_partkey)::bigint from part where p_brand in ('Brand#1', 'Brand#12')""",
}
QUERIES = {name: globals()[name] for name in SQL}
