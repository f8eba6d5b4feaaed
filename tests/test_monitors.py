"""Stateful streams: restarts, timers, dropped rows, replays and configurations."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from lodestone.operators.durable import folder
from lodestone.plans import monitored as P
from lodestone.streaming import monitors as M

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


def rows(spark, *given):
    return spark.createDataFrame([(i, s, u, t, float(u)) for i, (s, u, t) in enumerate(given)], "event_id long, s long, user_id long, event_type string, value double").select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "event_type", "value")


def test_resets_timers_and_idle_objects(spark):
    """Cycles of 10 s, reset every three: b is idle over a reset, a goes on, and only running totals are left as state."""
    parts = [rows(spark, (1, 5, "a"), (12, 7, "a"), (13, 1, "b")), rows(spark, (25, 1, "a"), (31, 2, "a"), (44, 3, "a")), rows(spark, (65, 9, "b"), (66, 4, "a"), (200, 0, "end"))]
    at, _ = P.replay(parts, lambda s: M.monitored(s, "ts", 10, ["event_type"], P._sums(), ["n", "users"], 3))
    got = {(r["event_type"], r["start"]): (r["n"], r["users"], r["n_total"], r["users_total"]) for r in spark.read.parquet(f"{at}/out").collect()}
    assert got == {
        ("a", 0): (1, 5, 1, 5), ("a", 10): (1, 7, 2, 12), ("a", 20): (1, 1, 3, 13), ("a", 30): (1, 2, 1, 2), ("a", 40): (1, 3, 2, 5), ("b", 10): (1, 1, 1, 1), ("b", 60): (1, 9, 1, 9), ("a", 60): (1, 4, 1, 4),
    }
    left = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "totals").load(f"{at}/state")
    assert left.count() == 0  # the row at 200 has closed all runs of cycles


def test_late_rows_are_dropped_and_counted(spark):
    """Slots of 7200 s, three slots late at most: after 30,000 s only slots that end after 8,400 s take rows."""
    parts = [rows(spark, (100, 1, "a"), (30_000, 2, "a")), rows(spark, (200, 10, "a"), (7300, 20, "a"), (31_000, 3, "a")), rows(spark, (900_000, 0, "end"))]
    out, lost = P.late_slots(parts)
    got = {int(r["start"]): r["users"] for r in out.where("event_type = 'a'").select(F.unix_timestamp("cycle.start").alias("start"), "users").collect()}
    assert got == {0: 1, 7200: 20, 28800: 5} and lost == 1


def test_replayed_batch_gives_no_second_row(spark):
    """The second batch fails after its rows were written; the restarted stream runs it again."""
    at = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    failing = []

    def sink(batch, number):
        M.once(f"{at}/harvest")(batch, number)
        if number in failing:
            raise RuntimeError("lost after the write")

    def run(values):
        spark.createDataFrame([(v,) for v in values], "k string").write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema("k string").parquet(f"{at}/in")
        return M.start(M.harvested(stream, "k"), at, sink)

    run(["x", "y", "x"])
    failing.append(1)
    with pytest.raises(Exception, match="lost after the write"):
        run(["y", "z", "z"])
    assert sorted(r[0] for r in spark.read.parquet(f"{at}/harvest").select("k").collect()) == ["x", "y", "z"]
    failing.clear()
    run(["z", "w"])
    assert sorted(r[0] for r in spark.read.parquet(f"{at}/harvest").select("k").collect()) == ["w", "x", "y", "z"]


def test_growth_goes_on_after_a_restart(spark):
    at = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    for part in ([("a", 1, 5), ("a", 2, 9), ("b", 1, 1)], [("a", 3, 9), ("b", 2, 2)], [("a", 4, 10), ("b", 3, 1), ("b", 4, 4)]):
        spark.createDataFrame(part, "object string, start long, entries long").write.mode("append").parquet(f"{at}/in")
        M.start(M.growing(spark.readStream.schema("object string, start long, entries long").parquet(f"{at}/in"), "object", "start", "entries"), at)
    got = {(r["object"], r["start"]): r["grew"] for r in spark.read.parquet(f"{at}/out").collect()}
    assert got == {("a", 1): True, ("a", 2): True, ("a", 3): False, ("a", 4): True, ("b", 1): True, ("b", 2): True, ("b", 3): False, ("b", 4): True}


def test_configuration(spark):
    """Tasks of different cycles and conditions, a check over two tasks, and one that waits for all its objects."""
    config = {
        "tasks": {"short": {"cycleDurationSeconds": 10, "where": "event_type <> 'end'", "object": "event_type", "value": "value"}, "long": {"cycleDurationSeconds": "20", "resetAfterCycles": "1", "value": "value"}},
        "checks": {
            "any": {"policy": "OnAny", "dataSource": [{"name": "short"}, {"name": "long"}], "value": "n", "medium": 2, "bad": 3},
            "all": {"policy": "OnAll", "dataSource": [{"name": "short", "MOs": ["a", "b"]}], "value": "s", "medium": 5, "bad": 50},
            "each": {"policy": "OnEachSeparately", "dataSource": [{"name": "short", "MOs": ["b"]}], "value": "n_total", "medium": 2, "bad": 9},
        },
    }
    at = P.configured([rows(spark, (1, 5, "a"), (2, 7, "b")), rows(spark, (11, 1, "a"), (21, 2, "b"), (500, 0, "end"))], config)
    tasks = {(r["task"], r["object"], r["start"]): (r["n"], r["s_total"]) for r in spark.read.parquet(f"{at}/tasks").collect()}
    assert tasks == {("short", "a", 0): (1, 5), ("short", "b", 0): (1, 7), ("short", "a", 10): (1, 6), ("short", "b", 20): (1, 9), ("long", "all", 0): (3, 13), ("long", "all", 20): (1, 2)}
    checks = {(r["check"], r["object"], r["start"]): r["quality"] for r in spark.read.parquet(f"{at}/checks").collect()}
    assert checks == {("any", "any", 0): "BAD", ("any", "any", 10): "GOOD", ("any", "any", 20): "GOOD", ("all", "all", 0): "MEDIUM", ("each", "short/b", 0): "GOOD", ("each", "short/b", 20): "MEDIUM"}
    with pytest.raises(ValueError, match="no active task"):
        M.tasks(rows(spark, (1, 1, "a")), "ts", {"tasks": {"x": {"active": "false"}}})
