"""Stateful monitoring queries: the events arrive in several batches, and the stream is restarted from its checkpoint for each."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import folder
from ..streaming import monitors as M
from ..streaming import streams as S
from .tables import read, rounded

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def _events(spark, d) -> DataFrame:
    return read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).select(*COLUMNS)


def arrivals(events: DataFrame, late: str = "false") -> list[DataFrame]:
    """Events in three arrivals by thirds of their time; those that are ``late`` come with the last one.

    The last arrival also has a row far ahead, of type ``end``, that closes every window before it.
    """
    ends = events.agg(F.unix_timestamp(F.min("ts")).alias("a"), (F.unix_timestamp(F.max("ts")) + 1).alias("b"))
    third = F.when(F.expr(late), 2).otherwise(F.floor(3 * (F.unix_timestamp("ts") - F.col("a")) / (F.col("b") - F.col("a"))))
    dealt = events.crossJoin(F.broadcast(ends)).withColumn("arrival", third)  # one row
    close = ends.select(F.lit(-1).cast("long").alias("event_id"), F.timestamp_seconds(F.col("b") + 864000).alias("ts"), F.lit(0).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"))
    parts = [dealt.where(F.col("arrival") == k).select(*COLUMNS) for k in range(3)]
    return [*parts[:2], parts[2].unionByName(close)]


def replay(parts: list[DataFrame], build, sink=None) -> tuple[str, list]:
    """Append one arrival after the other to the source's folder and run the stream from its checkpoint each time."""
    spark = parts[0].sparkSession
    at = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    queries = []
    for part in parts:
        part.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{at}/in")
        queries.append(M.start(build(stream), at, sink(at) if sink else None))
    return at, queries


def _out(parts: list[DataFrame], build) -> DataFrame:
    at, _ = replay(parts, build)
    return parts[0].sparkSession.read.parquet(f"{at}/out")


def _sums():
    return [F.count("*").alias("n"), F.sum("user_id").alias("users")]


def _whole(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def reset_stream(spark, d):
    """Hourly cycles; the cumulative objects begin anew every six of them."""
    out = _out(arrivals(_events(spark, d)), lambda s: M.monitored(s, "ts", 3600, ["event_type"], _sums(), ["n", "users"], 6))
    return _whole(out, "n", "users", "n_total", "users_total").where("event_type <> 'end'")


def cumulative_stream(spark, d):
    """Each cycle's own object beside the cumulative one, which is never reset."""
    out = _out(arrivals(_events(spark, d)), lambda s: M.monitored(s, "ts", 7200, ["event_type"], _sums(), ["n", "users"]))
    return _whole(out, "n", "users", "n_total", "users_total").where("event_type <> 'end'")


def increasing_stream(spark, d):
    """Cycles of six hours arrive in order; each is compared with the one before it, whichever batch that came in."""
    def build(s):
        c = S.cycles(s, "ts", 21600, ["event_type"], [F.count("*").alias("entries")])
        return M.growing(c.select(F.col("event_type").alias("object"), F.unix_timestamp("cycle.start").alias("start"), "entries"), "object", "start", "entries")

    return _out(arrivals(_events(spark, d)), build).where("object <> 'end'")


LATE = "event_id % 11 = 0"


def late_slots(parts: list[DataFrame]) -> tuple[DataFrame, int]:
    """Slots of twelve frames with rows up to three slots late, and how many counts the watermark dropped."""
    at, queries = replay(parts, lambda s: S.slots(s, "ts", 600, 12, 3, ["event_type"], _sums()))
    return parts[0].sparkSession.read.parquet(f"{at}/out"), sum(map(M.dropped, queries))


def late_slot_stream(spark, d):
    out, _ = late_slots(arrivals(_events(spark, d), LATE))
    return out.select("event_type", "n", "users", F.unix_timestamp("cycle.start").alias("start")).where("event_type <> 'end'")


def incremental_stream(spark, d):
    """Contents that no earlier batch had: one row per distinct (type, user)."""
    def build(s):
        return M.harvested(s.where("event_id >= 0").select(F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("content")), "content")

    at, _ = replay(arrivals(_events(spark, d)), build, lambda at: M.once(f"{at}/harvest"))
    return spark.read.parquet(f"{at}/harvest").select("content")


CONFIG = {
    "tasks": {
        "clicks": {"cycleDurationSeconds": "21600", "resetAfterCycles": "4", "where": "event_type = 'click'", "object": "concat('part', user_id % 3)", "value": "value"},
        "types": {"cycleDurationSeconds": "86400", "where": "event_type <> 'end'", "object": "event_type", "value": "user_id", "sampling": {"id": "event_id", "fraction": "0.5", "seed": "4533"}},
        "closing": {"active": "true", "cycleDurationSeconds": "3600", "where": "event_type = 'end'", "value": "value"},
        "unused": {"active": "false", "cycleDurationSeconds": "60", "value": "value"},
    },
    "checks": {
        "mean": {"policy": "OnEachSeparately", "dataSource": [{"type": "Task", "name": "types"}], "value": "s / n", "medium": 40, "bad": 60},
        "spread": {"policy": "OnAny", "dataSource": [{"type": "Task", "name": "clicks"}], "value": "n_total", "medium": 5, "bad": 20},
        "complete": {"policy": "OnAll", "dataSource": [{"type": "Task", "name": "clicks", "MOs": ["part0", "part1", "part2"]}], "value": "s / n", "medium": 50, "bad": 60},
        "off": {"active": "false", "policy": "OnAny", "dataSource": [], "value": "n", "medium": 1, "bad": 2},
    },
}


def configured(parts: list[DataFrame], config: dict) -> str:
    at, _ = replay(parts, lambda s: M.tasks(s, "ts", config), lambda at: M.both(at, config))
    return at


def configured_tasks(spark, d):
    """Two tasks of one document, in one pass over the source."""
    out = spark.read.parquet(f"{configured(arrivals(_events(spark, d)), CONFIG)}/tasks").where("task <> 'closing'")
    return rounded(_whole(out, "n", "n_total"), s=4, s_total=4).select("task", "object", "start", "n", "n_total", "s", "s_total")


def configured_checks(spark, d):
    """What three checks of the same document make of the tasks' cycles."""
    return spark.read.parquet(f"{configured(arrivals(_events(spark, d)), CONFIG)}/checks").select("check", "object", "start", "severity", "quality")


def _win(seconds: int, ts: str = "ts") -> str:
    return f"(epoch_us({ts}) // 1000000 // {seconds} * {seconds})"


def _totals(seconds: int, over: str) -> str:
    return f"""with c as (select event_type, {_win(seconds)} as start, count(*) as n, sum(user_id)::bigint as users from events group by all)
      select *, (sum(n) over w)::bigint as n_total, (sum(users) over w)::bigint as users_total from c window w as (partition by event_type{over} order by start)"""


TASKS = f"""t as (
    select 'clicks' as task, 'part' || user_id % 3 as object, {_win(21600)} as start, value, {_win(86400)} as period from events where event_type = 'click'
    union all select 'types', event_type, {_win(86400)}, user_id::double, 0 from events where substr(md5(event_id || '/4533'), 1, 8) < '7fffffff'
  ), c as (
    select task, object, start, period, count(value) as n, sum(value) as s from t group by all
  ), x as (
    select *, (sum(n) over w)::bigint as n_total, sum(s) over w as s_total from c window w as (partition by task, object, period order by start)
  )"""
SQL = {
    "reset_stream": _totals(3600, ", start // 21600"),
    "cumulative_stream": _totals(7200, ""),
    "increasing_stream": f"with b as (select event_type as object, {_win(21600)} as start, count(*) as entries from events group by all) select *, coalesce(entries > lag(entries) over (partition by object order by start), true) as grew from b",
    "late_slot_stream": f"""with g as (select epoch_us(min(ts)) // 1000000 as a, epoch_us(max(ts)) // 1000000 + 1 as b from events),
      e as (select *, case when event_id % 11 = 0 then 2 else 3 * (epoch_us(ts) // 1000000 - a) // (b - a) end as arrival from events, g),
      w as (select epoch_ms(max(ts)) - 21600000 as mark from e where arrival < 2)
      select event_type, count(*) as n, sum(user_id)::bigint as users, {_win(7200)} as start from e, w where arrival < 2 or ({_win(7200)} + 7200) * 1000 > mark group by all""",
    "incremental_stream": "select distinct event_type || '/' || user_id as content from events",
    "configured_tasks": f"with {TASKS} select task, object, start, n, n_total, round(s, 4) as s, round(s_total, 4) as s_total from x",
    "configured_checks": f"""with {TASKS}, v as (
        select 'mean' as "check", 'types/' || object as object, start, case when s / n >= 60 then 2 when s / n >= 40 then 1 else 0 end as severity from x where task = 'types'
        union all select 'spread', 'any', start, max(case when n_total >= 20 then 2 when n_total >= 5 then 1 else 0 end) from x where task = 'clicks' group by start
        union all select 'complete', 'all', start, max(case when s / n >= 60 then 2 when s / n >= 50 then 1 else 0 end) from x where task = 'clicks' group by start having count(*) = 3)
      select "check", object, start, severity::int as severity, ['GOOD', 'MEDIUM', 'BAD'][severity + 1] as quality from v""",
}
QUERIES = {name: globals()[name] for name in SQL}
