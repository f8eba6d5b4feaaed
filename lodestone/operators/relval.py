"""Release validation: limits, tests, verdicts and summaries over metric rows.

Metric rows: object, metric, value, comparable, threshold, lower_is_better, note.  Limit rows: object, metric, test, mean, low, high (the
allowed distances below and above the mean, NULL for none).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERDICTS = ("GOOD", "WARNING", "NONCRIT_NC", "CRIT_NC", "BAD", "UNKNOWN")


def dedup(metrics: DataFrame, order: str) -> DataFrame:
    """The first row per object and metric in load order."""
    w = Window.partitionBy("object", "metric").orderBy(order)
    return metrics.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_default_limits(metrics: DataFrame, overrides: dict[str, float] | None = None) -> DataFrame:
    """Each metric row with its own threshold as an upper or lower bound, by its direction: adds test, mean, low, high."""
    bound = F.col("threshold")
    for name, value in (overrides or {}).items():
        bound = F.when(F.col("metric") == name, F.lit(value)).otherwise(bound)
    zero, lower = F.lit(0.0), F.col("lower_is_better")
    return metrics.withColumns({"test": F.lit("threshold_default"), "mean": bound, "low": F.when(~lower, zero), "high": F.when(lower, zero)})


def default_limits(metrics: DataFrame, overrides: dict[str, float] | None = None) -> DataFrame:
    """The default limits as rows of their own, one per object and metric, to be united with other limits."""
    return with_default_limits(metrics, overrides).select("object", "metric", "test", "mean", "low", "high").distinct()


def user_limits(metrics: DataFrame, combine: str = "mean", margin: float = 0.0) -> DataFrame:
    """Mean or worst comparable value per object and metric, with a margin as a fraction of it.

    Where no value is comparable the limits are NULL, so that the object stays and can be judged not comparable.
    """
    ok = F.when(F.col("comparable"), F.col("value"))
    worst = F.when(F.first("lower_is_better"), F.max(ok)).otherwise(F.min(ok))
    g = metrics.groupBy("object", "metric").agg((F.avg(ok) if combine == "mean" else worst).alias("mean"), F.first("lower_is_better").alias("lower"))
    room = F.col("mean") * margin
    return g.select("object", "metric", F.lit("threshold_user").alias("test"), "mean", F.when(~F.col("lower"), room).alias("low"), F.when(F.col("lower"), room).alias("high"))


def region_limits(metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of central values (tight) and of outliers (loose).

    A value is an outlier if it is worse than its threshold and the threshold is less than a tenth of the excess.  Objects without
    a comparable value keep their rows, with NULL limits.
    """
    diff = F.col("value") - F.col("threshold")
    better = F.when(F.col("lower_is_better"), diff < 0).otherwise(diff > 0)
    outlier = ~better & (diff != 0) & (F.abs(F.try_divide(F.col("threshold"), diff)) < 0.1)
    g = metrics.withColumn("o", F.coalesce(outlier, F.lit(False))).groupBy("object", "metric")
    one = lambda f, c: f(F.when(F.col("comparable") & c, F.col("value")))
    g = g.agg(one(F.avg, ~F.col("o")).alias("mc"), one(F.stddev_pop, ~F.col("o")).alias("sc"), one(F.avg, F.col("o")).alias("mo"), one(F.stddev_pop, F.col("o")).alias("so"))
    rows = [F.struct(F.lit(t).alias("test"), F.col(m).alias("mean"), F.col(s).alias("dev")) for t, m, s in (("regions_tight", "mc", "sc"), ("regions_loose", "mo", "so"))]
    out = g.select("object", "metric", F.explode(F.array(*rows)).alias("r"))
    return out.select("object", "metric", "r.test", "r.mean", F.col("r.dev").alias("low"), F.col("r.dev").alias("high"))


def within(value: Column, lo: Column, hi: Column) -> Column:
    """The default test: closed bounds, NULL if there are none."""
    return F.when(lo.isNull() & hi.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(value >= lo, F.lit(True)) & F.coalesce(value <= hi, F.lit(True)))


def test(metrics: DataFrame, limits: DataFrame | dict[str, float] | None = None, function: Callable[[Column, Column, Column], Column] = within) -> DataFrame:
    """Each metric against all limits of its object and name: adds test, mean, passed, n_sigmas.

    Without limits, or with overrides {metric: threshold} alone, a row is tested against its own default limits, which takes no join.
    """
    j = metrics.join(limits, ["object", "metric"]) if isinstance(limits, DataFrame) else with_default_limits(metrics, limits)
    known = F.col("value").isNotNull() & F.col("mean").isNotNull()
    passed = F.when(known, function(F.col("value"), F.col("mean") - F.col("low"), F.col("mean") + F.col("high")))
    side = F.when(F.col("value") > F.col("mean"), F.col("high")).otherwise(F.col("low"))
    sigmas = F.when(known & (side != 0), F.abs(F.col("mean") - F.col("value")) / side)
    return j.withColumn("passed", passed).withColumn("n_sigmas", sigmas).drop("low", "high")


def interpret(results: DataFrame, critical: list[str] | None = None, function: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Adds ``verdict``.  Without a list all metrics are critical.  ``function`` may give the verdict's column instead."""
    if function is not None:
        return results.withColumn("verdict", function(results))
    crit = F.lit(True) if critical is None else F.col("metric").isin(critical)
    verdict = (
        F.when(~F.col("comparable") & crit, "CRIT_NC").when(~F.col("comparable"), "NONCRIT_NC").when(F.col("passed").isNull(), "UNKNOWN")
        .when(F.col("passed"), "GOOD").when(crit, "BAD").otherwise("WARNING")
    )
    return results.withColumn("verdict", verdict)


def summary(results: DataFrame) -> DataFrame:
    """Counts per metric, test and verdict, zeros included, with the percentage of all known objects."""
    objects = results.agg(F.countDistinct("object").alias("objects"))
    grid = results.select("metric", "test").distinct().withColumn("verdict", F.explode(F.array(*map(F.lit, VERDICTS))))
    counts = results.groupBy("metric", "test", "verdict").agg(F.count("*").alias("n"))
    out = grid.join(counts, ["metric", "test", "verdict"], "left").join(F.broadcast(objects))  # a single row
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select("metric", "test", "verdict", n.alias("n"), (100.0 * n / F.col("objects")).alias("percent"))


def matrix(results: DataFrame, test_name: str, metrics: list[str]) -> DataFrame:
    """Objects by metrics with the verdicts of one test."""
    return results.where(F.col("test") == test_name).groupBy("object").pivot("metric", metrics).agg(F.first("verdict"))


def value_histogram(metrics: DataFrame, bins: int = 100) -> DataFrame:
    """Counts of the comparable values of each metric in equal bins over their range."""
    ok = metrics.where("comparable")
    span = ok.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)
    place = F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1)).cast("int")
    return ok.join(span, "metric").groupBy("metric", place.alias("bin")).agg(F.count("*").alias("n"))


def side_by_side(labelled: dict[str, DataFrame]) -> DataFrame:
    """Values of several metric sets, one column per label."""
    both = None
    for label, m in labelled.items():
        m = m.select("object", "metric", "value", F.lit(label).alias("label"))
        both = m if both is None else both.unionByName(m)
    return both.groupBy("object", "metric").pivot("label", list(labelled)).agg(F.first("value"))


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per metric, test and verdict: objects in both result sets and in only one of them."""
    key = ["metric", "test", "verdict", "object"]
    x, y = a.select(*key).distinct().withColumn("x", F.lit(1)), b.select(*key).distinct().withColumn("y", F.lit(1))
    j = x.join(y, key, "full")
    n = lambda c: F.count_if(c).alias
    return j.groupBy("metric", "test", "verdict").agg(
        n(F.col("x").isNotNull() & F.col("y").isNotNull())("common"), n(F.col("y").isNull())("only_first"), n(F.col("x").isNull())("only_second")
    )


def common_names(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))


def ordered(results: DataFrame) -> DataFrame:
    return results.orderBy("object", "metric")


def query(results: DataFrame, condition: Callable[[DataFrame], Column]) -> DataFrame:
    """Rows for which a function of the frame gives true."""
    return results.where(condition(results))


def patterns_in(lines: list[str]) -> list[str]:
    """The patterns of a file's lines: empty lines and those that begin with # are left out, as is what follows a # elsewhere."""
    return [p for line in lines if (p := line.split("#", 1)[0].strip())]


def by_pattern(df: DataFrame, column: str, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Rows whose name some pattern finds; without include patterns, rows that no exclude pattern finds."""
    if include:
        return df.where(F.col(column).rlike("|".join(f"(?:{p})" for p in include)))
    return df.where(~F.col(column).rlike("|".join(f"(?:{p})" for p in exclude))) if exclude else df


def by_metric(df: DataFrame, enable: list[str] = (), disable: list[str] = ()) -> DataFrame:
    """Disabled names go; of the rest, the enabled ones stay, or all if none are named."""
    if disable:
        df = df.where(~F.col("metric").isin(list(disable)))
    return df.where(F.col("metric").isin(list(enable))) if enable else df
