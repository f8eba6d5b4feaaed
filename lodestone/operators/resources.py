"""Resource time series of task pipelines: cleaning, statistics, merging and overlays.

Rows: pipeline, iter, name, timeframe, category, and measured fields (cpu, pss, uss, nice, time …).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_internal(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Task rows and slice-global rows; other names that begin with two underscores go."""
    inner = F.col("name").startswith("__")
    return df.where(~inner), df.where(F.col("name") == "__cgroup_global__")


def by_task(df: DataFrame, regexes: list[str] = (), labels: list[str] = ()) -> DataFrame:
    """Tasks whose name some pattern matches from its start and that have any of the labels."""
    if regexes:
        df = df.where(F.col("name").rlike("^(?:" + "|".join(f"(?:{r})" for r in regexes) + ")"))
    return df.where(F.arrays_overlap("labels", F.array(*map(F.lit, labels)))) if labels else df


def union(*frames: DataFrame) -> DataFrame:
    """Metric frames below each other; columns that one lacks are NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def first_delta(df: DataFrame, keys: list[str], time: str, order: str) -> DataFrame:
    """``delta``: time since the task's first observation."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("delta", F.col(time) - F.first(time).over(w))


def last_seen(df: DataFrame, keys: list[str], iteration: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(F.when(F.col(value) != 0, F.col(iteration))).alias("last_iter"))


def per_iteration(df: DataFrame, fields: list[str], per: list[str] = ()) -> DataFrame:
    """Sums per pipeline, iteration and ``per``; iterations without rows are there with zeros."""
    per = list(per)
    sums = df.groupBy("pipeline", "iter", *per).agg(*[F.sum(f).alias(f) for f in fields])
    span = df.groupBy("pipeline").agg(F.min("iter").alias("a"), F.max("iter").alias("z"))
    keys = df.select("pipeline", *per).distinct().join(span, "pipeline")
    grid = keys.select("pipeline", *per, F.explode(F.sequence("a", "z")).alias("iter"))
    return grid.join(sums, ["pipeline", "iter", *per], "left").fillna(0, fields)


def series_stats(series: DataFrame, fields: list[str], per: list[str] = (), scale: dict[str, Column] | None = None) -> DataFrame:
    """Minimum, mean and maximum over the iterations, scaled where asked."""
    aggs = []
    for f in fields:
        v = F.col(f) * scale[f] if scale and f in scale else F.col(f)
        aggs += [F.min(v).alias(f"{f}_min"), F.avg(v).alias(f"{f}_mean"), F.max(v).alias(f"{f}_max")]
    return series.groupBy("pipeline", *per).agg(*aggs)


def category_need(df: DataFrame, field: str) -> DataFrame:
    """Per category the sum of each task's largest value."""
    top = df.groupBy("category", "name").agg(F.max(field).alias("v"))
    return top.groupBy("category").agg(F.sum("v").alias(field), F.count("*").alias("tasks"))


def task_need(df: DataFrame, field: str, category: str | None = None) -> DataFrame:
    rows = df.where(F.col("category") == category) if category else df
    return rows.groupBy("name").agg(F.max(field).alias("max"), F.avg(field).alias("mean"))


def top_peaks(df: DataFrame, field: str, n: int = 5) -> DataFrame:
    return df.groupBy("name").agg(F.max(field).alias(field)).orderBy(F.desc(field), "name").limit(n)


def run_summary(tasks: DataFrame, slices: DataFrame, cpus: int) -> DataFrame:
    """Per pipeline: mean and largest total memory and CPU (slice-global readings first), efficiency, wall time and disk."""
    sums = tasks.groupBy("pipeline", "iter").agg(F.sum("pss").alias("pss"), F.sum("cpu").alias("cpu"), F.max("time").alias("time"), F.max("disc").alias("disc"))
    whole = slices.groupBy("pipeline", "iter").agg(F.max("cpu").alias("all_cpu"))
    j = sums.join(whole, ["pipeline", "iter"], "left").withColumn("used", F.coalesce("all_cpu", "cpu"))
    return j.groupBy("pipeline").agg(
        F.avg("pss").alias("pss_mean"), F.max("pss").alias("pss_max"), F.avg("used").alias("cpu_mean"), F.max("used").alias("cpu_max"),
        (F.avg("used") / cpus).alias("efficiency"), (F.max("time") - F.min("time")).alias("wall"), (F.max("disc") - F.min("disc")).alias("disc"),
    )


def task_stats(df: DataFrame, fields: list[str]) -> DataFrame:
    """Minimum, maximum and mean per task to three digits."""
    return df.groupBy("name").agg(*[F.round(f(c), 3).alias(f"{c}_{n}") for c in fields for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])


def lifetime_stats(df: DataFrame) -> DataFrame:
    """Over a task's timeframes, statistics of its longest time; rows of lowest priority don't count."""
    life = df.where("nice <> 19").groupBy("name", "timeframe").agg(F.max("delta").alias("t"))
    return life.groupBy("name").agg(F.min("t").alias("min"), F.max("t").alias("max"), F.avg("t").alias("mean"), F.stddev_samp("t").alias("std"), F.count("*").alias("n"))


def measurement_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def merge_stats(stats: DataFrame, keys: Sequence[str] = ("name", "metric"), mode: str = "between") -> DataFrame:
    """One record per key from batch records (count, min, max, mean, std).

    ``between``: the deviation between the batches' means, weighted by count (population form).  ``full`` adds the deviation inside
    the batches.  Both are sums, so that the order and grouping of merges don't matter.
    """
    w = stats.where("mean is not null").withColumn("_w", F.col("count") * F.col("mean")).withColumn("_q", F.col("count") * F.col("mean") * F.col("mean"))
    inside = F.sum(F.col("count") * F.col("std") * F.col("std")) if mode == "full" else F.lit(0.0)
    g = w.groupBy(*keys).agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("_w").alias("_s"), F.sum("_q").alias("_q"), inside.alias("_i"))
    mean = F.col("_s") / F.col("count")
    m2 = F.greatest(F.lit(0.0), F.col("_q") - F.col("count") * mean * mean) + F.col("_i")
    return g.select(*keys, "count", "min", "max", mean.alias("mean"), m2.alias("m2"), F.sqrt(m2 / F.col("count")).alias("std"))


def estimates(df: DataFrame) -> DataFrame:
    """Per name up to its first underscore: mean wall time and cores, largest memory in whole MB."""
    g = df.groupBy(F.split("name", "_")[0].alias("task"))
    return g.agg(F.avg("walltime").alias("walltime"), (F.avg("cpu") / 100).alias("cpu"), F.ceil(F.max("mem") / 1024).alias("mem"))


def feature_compare(df: DataFrame, feature: str, field: str, values: list) -> DataFrame:
    """Largest value per task, one column per value of the feature."""
    return df.groupBy("name").pivot(feature, values).agg(F.max(field))


def overlay_estimates(stages: DataFrame, learned: DataFrame) -> DataFrame:
    """Stage resources replaced by learnt ones of the same base name; what wasn't learnt stays."""
    j = stages.join(learned, "base", "left")
    return j.select("name", "base", *[F.coalesce(f"{c}_learnt", c).alias(c) for c in ("mem", "cpu", "walltime")])


def overlay_logs(stats: DataFrame, logs: DataFrame) -> DataFrame:
    """Lifetimes from logs replace known ones and add tasks that weren't measured."""
    return stats.join(logs.withColumnRenamed("lifetime", "_new"), "name", "full").withColumn("lifetime", F.coalesce("_new", "lifetime")).drop("_new")


def weighted_usage(samples: DataFrame, assigned: DataFrame, keys: list[str]) -> DataFrame:
    """Per task: CPU weighted by the time since the sample before (the first reading counts nothing) and largest memory.

    Under three samples the assigned values hold.
    """
    w = Window.partitionBy(*keys).orderBy("time")
    s = samples.withColumn("_dt", F.col("time") - F.lag("time").over(w))
    g = s.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum(F.when(F.col("cpu") >= 0, F.col("cpu") * F.col("_dt"))).alias("_i"), F.sum("_dt").alias("_t"), F.max("mem").alias("_m")
    )
    j = g.join(assigned, keys)
    few = F.col("_n") < 3
    total = F.when(F.col("_t") != 0, F.col("_t")).otherwise(1.0)
    cpu = F.when(few, F.col("cpu_assigned")).otherwise(F.coalesce("_i", F.lit(0.0)) / total)
    return j.select(*keys, cpu.alias("cpu"), F.when(few, F.col("mem_assigned")).otherwise(F.col("_m")).alias("mem"))


def sibling_usage(usage: DataFrame, assigned: DataFrame, group: str) -> DataFrame:
    """Mean CPU and largest memory of the finished siblings; a value of zero or less falls back to the assigned one."""
    g = usage.groupBy(group).agg(F.avg("cpu").alias("c"), F.max("mem").alias("m"))
    j = assigned.join(g, group, "left")
    pick = lambda v, a: F.when(F.col(v) > 0, F.col(v)).otherwise(F.col(a))
    return j.select(group, pick("c", "cpu_assigned").alias("cpu"), pick("m", "mem_assigned").alias("mem"))
