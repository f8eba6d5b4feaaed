"""Histograms as rows: (object, bin, lo, hi, content, sumw2).  Bin 0 is underflow, bin n + 1 overflow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import table

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean")
EPSILON = 1e-5


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that histograms can be filled from: numeric type, name not ending in an underscore."""
    return [c for c, t in df.dtypes if t.startswith(NUMERIC) and not c.endswith("_")]


def long_form(df: DataFrame, cols: list[str] | None = None, keys: list[str] = ()) -> DataFrame:
    """One row (keys…, object, x) per value, NULLs left out.  A single scan, whatever the number of columns."""
    cols = cols or [c for c in numeric_columns(df) if c not in keys]
    pairs = F.array(*[F.struct(F.lit(c).alias("object"), F.col(c).cast("double").alias("x")) for c in cols])
    return df.select(*keys, F.explode(pairs).alias("v")).select(*keys, "v.object", "v.x").where("x is not null")


def axes_from(values: DataFrame, bins: int) -> DataFrame:
    """An axis per object from the range of a reference sample; the upper edge lies a tenth of a bin above the largest value."""
    span = values.where(~F.isnan("x")).groupBy("object").agg(F.min("x").alias("lo"), F.max("x").alias("top"))
    width = F.when(F.col("top") > F.col("lo"), F.col("top") - F.col("lo")).otherwise(F.lit(1.0))
    return span.select("object", F.lit(bins).alias("bins"), "lo", (F.col("lo") + width * (1 + 0.1 / bins)).alias("hi"))


def fill(values: DataFrame, axes: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Counts per (keys…, object, bin); each value weighs one.  ``axes`` has a row per object; Spark broadcasts it where it is small."""
    x = values.join(axes, "object")
    inner = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")).cast("int") + 1
    place = F.when(F.col("x") < F.col("lo"), 0).when(F.col("x") >= F.col("hi"), F.col("bins") + 1).otherwise(F.least(inner, F.col("bins")))
    counted = x.groupBy(*keys, "object", "bins", "lo", "hi", place.alias("bin")).agg(F.count("*").cast("double").alias("content"))
    return counted.withColumn("sumw2", F.col("content"))


def merge(*hists: DataFrame) -> DataFrame:
    """Histograms of equal object and axis added bin by bin."""
    both = hists[0]
    for h in hists[1:]:
        both = both.unionByName(h)
    keys = [c for c in both.columns if c not in ("content", "sumw2")]
    return both.groupBy(*keys).agg(F.sum("content").alias("content"), F.sum("sumw2").alias("sumw2"))


def flat_name(path: Column) -> Column:
    """A nested path as one name: folders ``DF_<n>`` share one prefix, separators and dots become underscores."""
    return F.regexp_replace(F.regexp_replace(path, "(^|/)DF_[0-9]+", "$1DF"), "[/.]+", "_")


def efficiency(passed: DataFrame, total: DataFrame) -> DataFrame:
    """Ratio per bin with its binomial error; bins without entries are NULL."""
    p = passed.select("object", "bin", F.col("content").alias("num"))
    t = total.select("object", "bin", F.col("content").alias("den"))
    num = F.coalesce("num", F.lit(0.0))
    ratio = F.when(F.col("den") > 0, num / F.col("den"))
    out = t.join(p, ["object", "bin"], "left").select("object", "bin", num.alias("num"), "den", ratio.alias("ratio"))
    return out.withColumn("error", F.sqrt(F.col("ratio") * (1 - F.col("ratio")) / F.col("den")))


def pair(a: DataFrame, b: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    """Two histogram sets bin by bin; ``in_a``, ``in_b`` say where the bin is."""
    key = list(key)
    a = a.select(*key, "bin", "bins", "lo", "hi", F.col("content").alias("ca"), F.col("sumw2").alias("wa"), F.lit(True).alias("in_a"))
    b = b.select(*key, "bin", F.col("bins").alias("bins_b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), F.col("content").alias("cb"), F.col("sumw2").alias("wb"), F.lit(True).alias("in_b"))
    return a.join(b, [*key, "bin"], "full")


def presence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each object's name with ``both``, ``only_first`` or ``only_second``."""
    x, y = a.select("object").distinct().withColumn("x", F.lit(1)), b.select("object").distinct().withColumn("y", F.lit(1))
    status = F.when(F.col("x").isNull(), "only_second").when(F.col("y").isNull(), "only_first").otherwise("both")
    return x.join(y, "object", "full").select("object", status.alias("status"))


def totals(pairs: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    """What the comparability code and the entry metrics need, in one aggregation per object."""
    inner = lambda v, bins: F.when((F.col("bin") > 0) & (F.col("bin") <= F.coalesce("bins", "bins_b")), F.coalesce(v, F.lit(0.0))).otherwise(0.0)
    gap = lambda x, y: F.abs(F.max(x) - F.max(y))
    return pairs.groupBy(*key).agg(
        F.sum(inner("ca", "bins")).alias("sum_a"), F.sum(inner("cb", "bins_b")).alias("sum_b"),
        ((gap("bins", "bins_b") > 0) | (gap("lo", "lo_b") > EPSILON) | (gap("hi", "hi_b") > EPSILON)).alias("axes_differ"),
        F.max(F.abs(F.coalesce("ca", F.lit(0.0)) - F.coalesce("cb", F.lit(0.0)))).alias("max_diff"),
        F.sum(F.coalesce("wa", F.lit(0.0))).alias("w_a"), F.sum(F.coalesce("wb", F.lit(0.0))).alias("w_b"),
    )


def comparable(t: DataFrame) -> DataFrame:
    """The first of: axes differ, an empty histogram, an integral that isn't finite, or sane."""
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    code = (
        F.when(F.coalesce("axes_differ", F.lit(True)), "axes").when((F.col("sum_a") == 0) | (F.col("sum_b") == 0), "empty").when(bad("sum_a") | bad("sum_b"), "not_finite").otherwise("ok")
    )
    return t.withColumn("code", code)


def identical(t: DataFrame) -> DataFrame:
    same = ~F.coalesce("axes_differ", F.lit(True)) & (F.col("sum_a") == F.col("sum_b")) & (F.col("max_diff") <= EPSILON)
    return t.withColumn("identical", same)


def chi2(pairs: DataFrame, t: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    """Unweighted two-sample chi-square over its degrees of freedom: sum (M n - N m)^2 / (n + m) / (N M), non-empty bins less one."""
    both = pairs.where((F.col("bin") > 0) & (F.col("bin") <= F.coalesce("bins", "bins_b"))).join(t.select(*key, "sum_a", "sum_b"), list(key))
    n, m = F.coalesce("ca", F.lit(0.0)), F.coalesce("cb", F.lit(0.0))
    term = F.when(n + m > 0, F.pow(F.col("sum_b") * n - F.col("sum_a") * m, 2) / (n + m))
    out = both.groupBy(*key, "sum_a", "sum_b").agg(F.sum(term).alias("s"), F.count(term).alias("filled"))
    scale = F.col("sum_a") * F.col("sum_b")
    return out.select(*key, F.when((scale > 0) & (F.col("filled") > 1), F.try_divide(F.col("s"), scale * (F.col("filled") - 1))).alias("value"))


def kolmogorov_probability(z: Column) -> Column:
    """The Kolmogorov distribution's tail, by the alternating series, and by its dual series for small z."""
    tail = sum((2.0 if j % 2 else -2.0) * F.exp(-2.0 * j * j * z * z) for j in range(1, 5))
    dual = 1 - F.try_divide(F.sqrt(F.lit(2) * F.pi()), z) * sum(F.exp(F.try_divide(-((2 * k - 1) ** 2) * F.pi() * F.pi(), 8 * z * z)) for k in range(1, 4))
    return F.when(z < 0.2, 1.0).when(z < 0.755, dual).when(z > 6.8116, 0.0).otherwise(tail)


def kolmogorov(pairs: DataFrame, t: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    """Largest distance of the cumulative contents and its probability; NULL if neither histogram has errors."""
    both = pairs.where((F.col("bin") > 0) & (F.col("bin") <= F.coalesce("bins", "bins_b"))).join(t.select(*key, "sum_a", "sum_b", "w_a", "w_b"), list(key))
    run = Window.partitionBy(*key).orderBy("bin")
    share = lambda c, total: F.try_divide(F.sum(F.coalesce(c, F.lit(0.0))).over(run), F.col(total))
    gap = F.abs(share("ca", "sum_a") - share("cb", "sum_b"))
    out = both.withColumn("gap", gap).groupBy(*key, "sum_a", "sum_b", "w_a", "w_b").agg(F.max("gap").alias("distance"))
    na, nb = (F.try_divide(F.col(f"sum_{v}") * F.col(f"sum_{v}"), F.col(f"w_{v}")) for v in "ab")
    size = F.when((F.col("w_a") > 0) & (F.col("w_b") > 0), F.try_divide(na * nb, na + nb)).when(F.col("w_a") > 0, na).when(F.col("w_b") > 0, nb)
    return out.select(*key, "distance", kolmogorov_probability(F.col("distance") * F.sqrt(size)).alias("value"))


def entry_difference(t: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    return t.select(*key, F.try_divide(F.abs(F.col("sum_a") - F.col("sum_b")), (F.col("sum_a") + F.col("sum_b")) / 2).alias("value"))


#: name: (function of bin pairs, totals and key, threshold, lower is better).  Thresholds and directions are fixed values.
_metrics: dict[str, tuple[Callable, float, bool]] = {
    "test_chi2": (chi2, 1.5, True),
    "test_kolmogorov": (lambda p, t, key: kolmogorov(p, t, key).drop("distance"), 0.5, False),
    "test_num_entries": (lambda p, t, key: entry_difference(t, key), 0.1, True),
}


def register_metric(name: str, function: Callable, threshold: float, lower_is_better: bool) -> None:
    """Add a metric: ``function(pairs, totals, key)`` returns key columns and ``value``."""
    _metrics[name] = (function, threshold, lower_is_better)


def unregister_metric(name: str) -> None:
    _metrics.pop(name, None)


def metrics() -> dict[str, tuple[Callable, float, bool]]:
    return dict(_metrics)


def compare(a: DataFrame, b: DataFrame, names: list[str] | None = None, key: list[str] = ("object",)) -> DataFrame:
    """One row per object and metric: object, metric, value, comparable, threshold, lower_is_better, note.

    Objects in only one set are left out (see ``presence``).  A value that isn't a number makes the row not comparable.  The bin
    pairs and the totals, which all metrics share, are written out once, so that the data behind the histograms are read once; they
    are as many as there are bins and objects.
    """
    key = list(key)
    pairs = table(pair(a, b, key), "pairs")
    t = table(comparable(totals(pairs, key)).where(F.col("axes_differ").isNotNull()), "totals")
    out = None
    for name in names or list(_metrics):
        function, threshold, lower = _metrics[name]
        v = t.select(*key, "code").join(function(pairs, t, key), key, "left")
        ok = (F.col("code") == "ok") & F.col("value").isNotNull() & ~F.isnan("value")
        note = F.when(F.col("code") != "ok", F.col("code")).when(~ok, "not_a_number")
        v = v.select(
            *key, F.lit(name).alias("metric"), F.when(ok, F.col("value")).alias("value"), F.coalesce(ok, F.lit(False)).alias("comparable"),
            F.lit(threshold).alias("threshold"), F.lit(lower).alias("lower_is_better"), note.alias("note"),
        )
        out = v if out is None else out.unionByName(v)
    return out
