"""Quality-control streams: cycles, merging, trends, checks and calibration slots; what needs own state is in ``monitors``.

All functions take and return DataFrames and work on streaming and batch input alike, except where a mode is named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITY = ("GOOD", "MEDIUM", "BAD", "NULL")


def _late(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def cycles(df: DataFrame, ts: str, seconds: int, keys: list[str], aggs: list[Column], delay: str | None = "0 seconds", slide: int | None = None) -> DataFrame:
    """One row per monitoring cycle and key; sliding windows if ``slide`` is given."""
    w = F.window(ts, f"{seconds} seconds", f"{slide} seconds") if slide else F.window(ts, f"{seconds} seconds")
    return _late(df, ts, delay).groupBy(w.alias("cycle"), *keys).agg(*aggs)


def merge_deltas(cycled: DataFrame, seconds: int, multiplier: int, keys: list[str], sums: list[str]) -> DataFrame:
    """Deltas of several sites added over ``multiplier`` cycles: a second window over the first one's time."""
    w = F.window(F.window_time("cycle"), f"{seconds * multiplier} seconds")
    return cycled.groupBy(w.alias("merged"), *keys).agg(*[F.sum(c).alias(c) for c in sums])


def sampled(df: DataFrame, ident: str, fraction: float, seed: str) -> DataFrame:
    """A fraction by the hash of id and seed, so that a replay takes the same rows."""
    limit = f"{int(fraction * 0xFFFFFFFF):08x}"
    return df.where(F.substring(F.md5(F.concat_ws("/", F.col(ident).cast("string"), F.lit(seed))), 1, 8) < limit)


def trend(df: DataFrame, ts: str, seconds: int, keys: list[str], value: str, delay: str | None = "0 seconds") -> DataFrame:
    """Mean, deviation, entries and error of the mean per cycle, from mergeable sums."""
    n, s, q = F.count(value), F.sum(value), F.sum(F.col(value) * F.col(value))
    out = cycles(df, ts, seconds, keys, [n.alias("entries"), s.alias("_s"), q.alias("_q")], delay)
    mean = F.col("_s") / F.col("entries")
    dev = F.sqrt(F.greatest(F.lit(0.0), F.col("_q") / F.col("entries") - mean * mean))
    return out.withColumns({"mean": mean, "stddev": dev, "error": dev / F.sqrt("entries")}).drop("_s", "_q")


def slice_trend(df: DataFrame, ts: str, seconds: int, keys: list[str], value: str, axis: str, edges: list[float], delay: str | None = "0 seconds") -> DataFrame:
    """As ``trend`` per slice of an axis between the edges; values outside are left out."""
    which = None
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        c = (F.col(axis) >= a) & (F.col(axis) < b)
        which = F.when(c, k) if which is None else which.when(c, k)
    return trend(df.withColumn("slice", which).where("slice is not null"), ts, seconds, [*keys, "slice"], value, delay)


def quality(value: Column, medium: float, bad: float) -> Column:
    """Severity 0 to 3 by two thresholds; no value is NULL quality."""
    return F.when(value.isNull(), 3).when(value >= bad, 2).when(value >= medium, 1).otherwise(0)


def check(objects: DataFrame, cycle: str, value: str, medium: float, bad: float, policy: str, wanted: list[str] | None = None) -> DataFrame:
    """Quality per cycle: ``each`` object separately, on ``any`` object there is, or only once ``all`` wanted objects are there."""
    q = objects.withColumn("severity", quality(F.col(value), medium, bad))
    if policy == "each":
        return q
    g = q.groupBy(cycle).agg(F.max("severity").alias("severity"), F.collect_set("object").alias("_o"))  # as many as there are objects
    if policy == "all":
        g = g.where(F.size(F.array_intersect("_o", F.array(*map(F.lit, wanted)))) == len(wanted))
    return g.drop("_o")


def worst_of_all(qualities: DataFrame, cycle: str) -> DataFrame:
    g = qualities.groupBy(cycle).agg(F.max("severity").alias("severity"))
    return g.withColumn("quality", F.element_at(F.array(*map(F.lit, SEVERITY)), F.col("severity") + 1))


def increasing(cycled: DataFrame, key: str, order: str, entries: str) -> DataFrame:
    """Batch form: did the entries grow since the cycle before?"""
    before = F.lag(entries).over(Window.partitionBy(key).orderBy(order))
    return cycled.withColumn("grew", F.coalesce(F.col(entries) > before, F.lit(True)))


def slots(df: DataFrame, ts: str, frame_seconds: int, per_slot: int, max_delay: int, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Calibration slots of ``per_slot`` frames; frames later than ``max_delay`` slots are dropped."""
    length = frame_seconds * per_slot
    return cycles(df, ts, length, keys, aggs, f"{length * max_delay} seconds")


def merge_pushed(payloads: DataFrame) -> DataFrame:
    """Running totals per tag, task and metric of pushed (count, mean, min, max); update mode flushes each change."""
    w = F.col("count") * F.col("mean")
    g = payloads.groupBy("tag", "task", "metric").agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum(w).alias("_s"), F.sum(w * F.col("mean")).alias("_q"))
    mean = F.col("_s") / F.col("count")
    return g.withColumns({"mean": mean, "std": F.sqrt(F.greatest(F.lit(0.0), F.col("_q") / F.col("count") - mean * mean))}).drop("_s", "_q")


def drain(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything there is and return its output as a table (append mode) under ``folder``."""
    q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def drain_updates(stream: DataFrame, folder: str, key: list[str], order: str) -> DataFrame:
    """As ``drain`` in update mode: each micro-batch's changed rows are appended, the last one per key (largest ``order``) holds."""
    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").parquet(f"{folder}/out")

    q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
