"""Streaming queries: the events table replayed through a file stream, drained, and compared with batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.durable import folder
from ..streaming import streams as S
from .tables import read, rounded


def _folder(spark) -> str:
    return f"{folder(spark)}/stream-{uuid.uuid4().hex}"


def source(spark, d, files: int = 4):
    """Events as a stream of files in time order, with a last row far ahead that closes every window."""
    at = _folder(spark) + "/in"
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    end = e.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("interval 10 days")).alias("ts"), F.lit(0).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), F.lit("").alias("props"))
    rows = e.select("event_id", "ts", "user_id", "event_type", "value", "props").repartitionByRange(files, "ts").sortWithinPartitions("ts")
    rows.write.parquet(at)
    end.write.mode("append").parquet(at)
    # oldest files first; the closing row's file was written last
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 100).parquet(at)


def _start(df, name):
    return df.withColumns({"start": F.unix_timestamp(F.col(f"{name}.start"))}).drop(name).where("event_type <> 'end'")


def _sums():
    return [F.count("*").alias("n"), F.sum("user_id").alias("users")]


def cycle_stream(spark, d):
    return _start(S.drain(S.cycles(source(spark, d), "ts", 3600, ["event_type"], _sums()), _folder(spark)), "cycle")


def merge_deltas_stream(spark, d):
    c = S.cycles(source(spark, d), "ts", 3600, ["event_type"], _sums())
    return _start(S.drain(S.merge_deltas(c, 3600, 4, ["event_type"], ["n", "users"]), _folder(spark)), "merged")


def moving_stream(spark, d):
    return _start(S.drain(S.cycles(source(spark, d), "ts", 7200, ["event_type"], _sums(), slide=3600), _folder(spark)), "cycle")


def sampled_stream(spark, d):
    return S.drain(S.sampled(source(spark, d), "event_id", 0.25, "p1").select("event_id", "user_id"), _folder(spark)).where("event_id >= 0")


def trend_stream(spark, d):
    t = _start(S.drain(S.trend(source(spark, d), "ts", 21600, ["event_type"], "value"), _folder(spark)), "cycle")
    return rounded(t, mean=6, stddev=6, error=6)


def slice_trend_stream(spark, d):
    t = _start(S.drain(S.slice_trend(source(spark, d), "ts", 86400, ["event_type"], "value", "user_id", [0, 40, 80, 120]), _folder(spark)), "cycle")
    return rounded(t.drop("error"), mean=6, stddev=6)


def slot_stream(spark, d):
    return _start(S.drain(S.slots(source(spark, d), "ts", 600, 12, 3, ["event_type"], _sums()), _folder(spark)), "cycle")


def _batch(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("object", F.col("event_type"))
    c = S.cycles(e, "ts", 21600, ["object"], [F.avg("value").alias("mean"), F.count("*").alias("entries")])
    return c.withColumn("start", F.unix_timestamp(F.col("cycle.start"))).drop("cycle")


def quality_check(spark, d):
    """The three policies over the objects of each cycle."""
    b = _batch(spark, d)
    one = S.check(b, "start", "mean", 50, 60, "each").groupBy("start").agg(F.sum("severity").alias("severity")).withColumn("policy", F.lit("each"))
    some = S.check(b, "start", "mean", 50, 60, "any").withColumn("policy", F.lit("any"))
    every = S.check(b.where("entries > 5"), "start", "mean", 50, 60, "all", ["click", "view", "purchase"]).withColumn("policy", F.lit("all"))
    return one.select("start", "policy", F.col("severity").cast("long").alias("severity")).unionByName(some.select("start", "policy", F.col("severity").cast("long").alias("severity"))).unionByName(every.select("start", "policy", F.col("severity").cast("long").alias("severity")))


def worst_quality(spark, d):
    return S.worst_of_all(S.check(_batch(spark, d), "start", "mean", 50, 60, "each"), "start").select("start", "quality")


def increasing_entries(spark, d):
    return S.increasing(_batch(spark, d), "object", "start", "entries").select("object", "start", "entries", "grew")


def _payload(e):
    return e.select(
        F.concat(F.lit("tag"), (F.col("user_id") % 3).cast("string")).alias("tag"), F.col("event_type").alias("task"), F.lit("value").alias("metric"), (F.col("event_id") % 4 + 1).alias("count"),
        F.col("value").alias("mean"), (F.col("value") - 1).alias("min"), (F.col("value") + 1).alias("max"),
    )


def merge_stream(spark, d):
    s = S.merge_pushed(_payload(source(spark, d).where("event_id >= 0")))
    return rounded(S.drain_updates(s, _folder(spark), ["tag", "task", "metric"], "count"), mean=6, std=5)


def _win(seconds: int) -> str:
    return f"(epoch_us(ts) // 1000000 // {seconds} * {seconds})"


BATCH = f"b as (select event_type as object, {_win(21600)} as start, avg(value) as mean, count(*) as entries from events group by all), q as (select *, case when mean >= 60 then 2 when mean >= 50 then 1 else 0 end as s from b)"
SQL = {
    "cycle_stream": f"select event_type, count(*) as n, sum(user_id)::bigint as users, {_win(3600)} as start from events group by all",
    "merge_deltas_stream": f"select event_type, count(*) as n, sum(user_id)::bigint as users, {_win(14400)} as start from events group by all",
    "moving_stream": f"with x as (select event_type, user_id, unnest([{_win(3600)}, {_win(3600)} - 3600]) as start from events) select event_type, count(*) as n, sum(user_id)::bigint as users, start from x group by all",
    "sampled_stream": "select event_id, user_id from events where substr(md5(event_id || '/p1'), 1, 8) < '3fffffff'",
    "trend_stream": f"""select event_type, count(value) as entries, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as stddev, round(stddev_pop(value) / sqrt(count(value)), 6) as error, {_win(21600)} as start from events group by event_type, {_win(21600)}""",
    "slice_trend_stream": f"""select event_type, (user_id // 40)::int as slice, count(value) as entries, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as stddev, {_win(86400)} as start from events where user_id between 0 and 119 group by event_type, user_id // 40, {_win(86400)}""",
    "slot_stream": f"select event_type, count(*) as n, sum(user_id)::bigint as users, {_win(7200)} as start from events group by all",
    "quality_check": f"""with {BATCH} select start, 'each' as policy, sum(s)::bigint as severity from q group by 1 union all select start, 'any', max(s)::bigint from q group by 1
        union all select start, 'all', max(s)::bigint from q where entries > 5 group by 1 having count(distinct object) filter (object in ('click', 'view', 'purchase')) = 3""",
    "worst_quality": f"with {BATCH} select start, ['GOOD', 'MEDIUM', 'BAD'][max(s) + 1] as quality from q group by 1",
    "increasing_entries": f"with {BATCH} select object, start, entries, coalesce(entries > lag(entries) over (partition by object order by start), true) as grew from b",
    "merge_stream": """with p as (select 'tag' || user_id % 3 as tag, event_type as task, 'value' as metric, event_id % 4 + 1 as c, value as m from events), g as (select tag, task, metric, sum(c)::bigint as count, min(m - 1) as min, max(m + 1) as max, sum(c * m) / sum(c) as mean from p group by all)
        select tag, task, metric, any_value(count) as count, any_value(min) as min, any_value(max) as max, round(any_value(mean), 6) as mean, round(sqrt(sum(c * (m - mean) ^ 2) / any_value(count)), 5) as std from p join g using (tag, task, metric) group by tag, task, metric""",
}
QUERIES = {name: globals()[name] for name in SQL}
