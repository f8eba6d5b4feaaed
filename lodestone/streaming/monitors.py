"""Monitoring with state that survives restarts: cumulative objects with resets, growth checks, exactly-once harvest, and
tasks and checks built from a configuration.

State lives in RocksDB stores, dealt by key; run the queries inside ``rocks``.  Rows are reduced to one per key and cycle by
ordinary window aggregation before they meet a stateful processor, so a hot key costs it no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from . import streams as S

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocks(spark: SparkSession):
    """Queries started here keep their state in RocksDB, as processors with timers need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class Cumulative(StatefulProcessor):
    """Running sums per object beside each cycle's own, which begin anew every ``reset`` cycles (0 or less: never).

    Cycles are counted from the epoch, so that all objects and every restart agree on the resets.  A timer at the end of the last
    cycle of a run of cycles clears the state of objects that get no more rows.
    """

    def __init__(self, key: list[str], sums: list[str]):
        self.key, self.sums = key, sums

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("totals", "until long, " + ", ".join(f"{s} double" for s in self.sums))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("start")  # one row per cycle
        until, *totals = self.state.get() if self.state.exists() else (None, *([0.0] * len(self.sums)))
        out, timers = [], set()
        for row in new.to_dict("records"):
            # 0: never reset
            end = (row["start"] // row["seconds"] // row["reset"] + 1) * row["reset"] * row["seconds"] if row["reset"] > 0 else 0
            if end != until:
                until, totals = end, [0.0] * len(self.sums)
                timers |= {end} if end else set()
            totals = [t + float(row[s]) for t, s in zip(totals, self.sums, strict=True)]
            out.append({**{k: row[k] for k in (*self.key, "start")}, **{s: float(row[s]) for s in self.sums}, **{f"{s}_total": t for s, t in zip(self.sums, totals, strict=True)}})
        self.state.update((until, *totals))
        for end in timers:
            self.handle.registerTimer(end * 1000)
        yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists() and 0 < self.state.get()[0] * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def cumulative(cycled: DataFrame, key: list[str], sums: list[str]) -> DataFrame:
    """Per object and cycle its own ``sums`` and, as ``…_total``, those since the last reset; all as doubles.

    ``cycled``: streaming (key…, closed (the cycle's last instant, with a watermark), start (seconds), seconds, reset, sums…), one row
    per key and cycle.
    """
    kinds = {f.name: f.dataType.simpleString() for f in cycled.schema}
    out = ", ".join([*(f"{k} {kinds[k]}" for k in key), "start long", *(f"{s} double" for s in sums), *(f"{s}_total double" for s in sums)])
    return cycled.groupBy(*key).transformWithStateInPandas(Cumulative(key, sums), out, "Append", "EventTime")


def monitored(df: DataFrame, ts: str, seconds: int, keys: list[str], aggs: list[Column], sums: list[str], reset: int = 0, delay: str = "0 seconds") -> DataFrame:
    """Monitoring cycles of ``seconds``: each cycle's own object beside the cumulative one, cleared every ``reset`` cycles."""
    c = S.cycles(df, ts, seconds, keys, aggs, delay)
    c = c.select(*keys, F.window_time("cycle").alias("closed"), F.unix_timestamp("cycle.start").alias("start"), F.lit(seconds).cast("long").alias("seconds"), F.lit(reset).cast("long").alias("reset"), *sums)
    return cumulative(c, keys, sums)


class Growth(StatefulProcessor):
    """Did the entries of an object grow since its cycle before?"""

    def __init__(self, key: str, order: str, entries: str):
        self.names = key, order, entries

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "entries long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name, order, entries = self.names
        new = pd.concat(list(rows)).sort_values(order)  # the cycles of one object in one micro-batch
        last = self.state.get()[0] if self.state.exists() else None
        before = [last, *new[entries].tolist()[:-1]]
        self.state.update((int(new[entries].iloc[-1]),))
        yield pd.DataFrame({name: new[name], order: new[order], entries: new[entries], "grew": [b is None or n > b for b, n in zip(before, new[entries], strict=True)]})

    def close(self) -> None:
        pass


def growing(cycled: DataFrame, key: str, order: str, entries: str) -> DataFrame:
    """(key, order, entries, grew) for a stream of cycles that arrive in order; an object's first cycle counts as grown."""
    return cycled.select(key, F.col(order).cast("long").alias(order), F.col(entries).cast("long").alias(entries)).groupBy(key).transformWithStateInPandas(
        Growth(key, order, entries), f"{key} string, {order} long, {entries} long, grew boolean", "Append", "None"
    )


def once(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that keeps each micro-batch in a folder of its own, so that a replayed one replaces itself."""
    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return run


def harvested(new: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier row had, in this run or any before it from the same checkpoint.

    The keys seen are the state: each task holds those of its share of the hashes and looks up only the keys of the batch.  With
    ``once`` as its sink every key comes out once, whatever is replayed.
    """
    return new.dropDuplicates([key])


def start(stream: DataFrame, folder: str, sink: Callable[[DataFrame, int], None] | None = None):
    """Run a stream over all there is, from the checkpoint under ``folder``, into ``folder``/out; the finished query."""
    w = stream.writeStream.option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True)
    w = w.foreachBatch(sink) if sink else w.format("parquet").option("path", f"{folder}/out")
    with rocks(stream.sparkSession):
        q = w.start()
    q.awaitTermination()
    return q


def dropped(query) -> int:
    """Late rows that the finished query's watermark dropped, as its operators counted them (after map-side aggregation)."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


# --- tasks and checks from a configuration ---------------------------------------------------------------------------------


def tasks(df: DataFrame, ts: str, config: dict, delay: int = 0) -> DataFrame:
    """All active tasks of a configuration over one pass of ``df``: (task, object, start, n, s, q and their totals).

    A task: ``cycleDurationSeconds``, ``resetAfterCycles`` (default: never), ``where`` (SQL condition), ``object`` and ``value`` (SQL
    expressions), ``sampling`` (``fraction``, ``seed``, ``id``), ``active``.  Each row is handed to the tasks that want it and all tasks
    share one aggregation and one state.  ``n``, ``s``, ``q`` are the count, sum and sum of squares of the values.
    """
    wanted = {n: t for n, t in config["tasks"].items() if str(t.get("active", True)).lower() == "true"}
    if not wanted:
        raise ValueError("no active task")
    longest = max(int(t["cycleDurationSeconds"]) for t in wanted.values())
    copies = []
    for name, t in wanted.items():
        seconds = int(t["cycleDurationSeconds"])
        first = F.floor(F.unix_timestamp(ts) / seconds) * seconds
        row = F.struct(
            F.lit(name).alias("task"), F.expr(t.get("object", "'all'")).cast("string").alias("object"), F.expr(t["value"]).cast("double").alias("value"), first.cast("long").alias("start"),
            F.lit(seconds).cast("long").alias("seconds"), F.lit(int(t.get("resetAfterCycles", 0))).cast("long").alias("reset"),
        )
        conditions = [F.expr(t["where"])] if "where" in t else []
        if "sampling" in t:
            p = t["sampling"]
            share = F.substring(F.md5(F.concat_ws("/", F.col(p["id"]).cast("string"), F.lit(str(p["seed"])))), 1, 8)
            conditions.append(share < f"{int(float(p['fraction']) * 0xFFFFFFFF):08x}")
        copies.append(F.when(reduce(lambda a, b: a & b, conditions, F.lit(True)), row))
    rows = df.select(F.explode(F.array_compact(F.array(*copies))).alias("r")).select("r.*")
    # the end of a row's cycle is the event time: no cycle ends later than the longest one after its rows
    rows = rows.withColumn("closed", F.timestamp_seconds(F.col("start") + F.col("seconds"))).withWatermark("closed", f"{longest + delay} seconds")
    sums = [F.count("value").cast("double").alias("n"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("s"), F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)).alias("q")]
    cycled = rows.groupBy("task", "object", "start", "seconds", "reset", "closed").agg(*sums)
    return cumulative(cycled, ["task", "object"], ["n", "s", "q"])


def checked(cycles: DataFrame, config: dict) -> DataFrame:
    """All active checks of a configuration over the closed cycles of its tasks: (check, object, start, severity, quality).

    A check: ``policy`` (OnAny, OnAll, OnEachSeparately), ``dataSource`` (list of ``name`` (task) and, for OnAll and to choose objects,
    ``MOs``), ``value`` (SQL over n, s, q and totals), ``medium``, ``bad``, ``active``.  All objects of a cycle close together, so one
    batch of ``tasks`` holds all there is to a cycle.
    """
    out = []
    for name, c in config.get("checks", {}).items():
        if str(c.get("active", True)).lower() != "true":
            continue
        policy = {"OnAny": "any", "OnAll": "all", "OnEachSeparately": "each"}[c["policy"]]
        sources = [F.when((F.col("task") == s["name"]) & (F.col("object").isin(*s["MOs"]) if "MOs" in s else F.lit(True)), True) for s in c["dataSource"]]
        rows = cycles.where(F.coalesce(*sources, F.lit(False))).withColumn("value", F.expr(c["value"]))
        rows = rows.withColumn("object", F.concat_ws("/", "task", "object"))
        objects = [f"{s['name']}/{o}" for s in c["dataSource"] for o in s.get("MOs", [])]
        q = S.check(rows, "start", "value", c["medium"], c["bad"], policy, objects)
        q = q if policy == "each" else q.withColumn("object", F.lit(policy))
        out.append(q.select(F.lit(name).alias("check"), "object", "start", F.col("severity").cast("int").alias("severity")))
    if not out:
        raise ValueError("no active check")
    every = reduce(DataFrame.unionByName, out)
    return every.withColumn("quality", F.element_at(F.array(*map(F.lit, S.SEVERITY)), F.col("severity") + 1))


def both(path: str, config: dict) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink for ``tasks``: the cycles to ``path``/tasks, what the checks make of them to ``path``/checks, each batch once."""
    def run(batch: DataFrame, number: int) -> None:
        at = f"{path}/tasks/batch={number}"
        batch.write.mode("overwrite").parquet(at)
        cycles = batch.sparkSession.read.schema(batch.schema).parquet(at)
        checked(cycles, config).write.mode("overwrite").parquet(f"{path}/checks/batch={number}")

    return run
