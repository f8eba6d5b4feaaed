"""Closed intervals of integers: overlap joins, exclusion, range lookup and window planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import nearest
from .ranges import fits, with_previous

#: Lengths of stretches are powers of 2 to this power.
STEP = 3


def _level(lo: Column, hi: Column) -> Column:
    """Exponent of the stretches an interval is kept in: at least its length, and a multiple of STEP."""
    return (F.ceil(F.length(F.bin(hi - lo)) / STEP) * STEP).cast("int")


def _cells(lo: str, hi: str, level: Column) -> Column:
    """The stretches of 2^level that an interval of at most that length touches: one or two."""
    at = lambda c: F.call_function("shiftright", F.col(c).cast("long"), level)
    return F.array_distinct(F.array(at(lo), at(hi)))


def _levels(df: DataFrame, lo: str, hi: str) -> list[int]:
    """Which levels occur; 64 / STEP numbers at most."""
    return sorted(r[0] for r in df.select(_level(F.col(lo), F.col(hi))).distinct().collect())


def _kept(df: DataFrame, lo: str, hi: str) -> DataFrame:
    return df.withColumn("_l", _level(F.col(lo), F.col(hi))).withColumn("_k", F.explode(_cells(lo, hi, F.col("_l"))))


def _probing(df: DataFrame, lo: str, hi: str, levels: list[int], equal: bool) -> DataFrame:
    """The stretches of the coarser ``levels`` (and, if ``equal``, of its own) that an interval touches."""
    own = _level(F.col(lo), F.col(hi))
    able = F.array_compact(F.array(*[F.when(own <= n if equal else own < n, n) for n in levels])) if levels else F.array().cast("array<int>")
    return df.withColumn("_l", F.explode(able)).withColumn("_k", F.explode(_cells(lo, hi, F.col("_l"))))


def overlap(left: DataFrame, right: DataFrame, by: list[str] = (), margin: str | int = 0, inclusive: bool = False) -> DataFrame:
    """Pairs whose overlap is larger than ``margin`` (a number or a column of ``right``), or any overlap if ``inclusive``.

    ``left`` has lo, hi; ``right`` has ws, we.  An interval is kept in the one or two stretches of its own length (rounded up to a
    power of 2^STEP) that it touches, and looked up in those of every coarser length that occurs on the other side, so that its rows
    don't grow with its length.  A pair meets in the stretch of the longer interval where the overlap begins.  Intervals that end
    before they begin overlap nothing.
    """
    m = F.col(margin) if isinstance(margin, str) else F.lit(margin)
    left, right = left.where("hi >= lo"), right.where("we >= ws")
    pairs = _probing(left, "lo", "hi", _levels(right, "ws", "we"), True).join(_kept(right, "ws", "we"), [*by, "_l", "_k"])
    turned = _kept(left, "lo", "hi").join(_probing(right, "ws", "we", _levels(left, "lo", "hi"), False), [*by, "_l", "_k"])
    j = pairs.unionByName(turned)
    first = F.col("_k") == F.call_function("shiftright", F.greatest("lo", "ws").cast("long"), F.col("_l"))
    touch = (F.col("hi") >= F.col("ws")) & (F.col("lo") <= F.col("we"))
    enough = F.lit(True) if inclusive else F.least("hi", "we") - F.greatest("lo", "ws") > m
    return j.where(first & touch & enough).drop("_l", "_k")


def merged(intervals: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by…, lo, hi): the union of the closed intervals of each ``by`` as disjoint ones; intervals that end before they begin are none."""
    by = list(by)
    rows = intervals.where("hi >= lo").select(*by, "lo", "hi").withColumn("_end", F.col("hi"))
    fit = fits(rows, by)
    new = with_previous(rows, by, "lo", "_end", "_before", F.col("_end"), fit).where(F.col("_top").isNull() | (F.col("lo") > F.col("_top")))
    # all that begins before the next island ends within this one
    new = new.select(*by, "lo", "_top", (-F.col("lo")).alias("_down"))
    new = with_previous(new, by, "_down", "_top", "_until", fit=fit).select(*by, "lo", "_until")
    last = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.max("hi").alias("_last"))
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return new.join(last, match).select(*by, "lo", F.coalesce("_until", "_last").alias("hi"))


def _within(points: DataFrame, intervals: DataFrame, time: str, by: list[str]) -> DataFrame:
    """``points`` with ``_in``: does some closed interval of the same ``by`` hold them?  One walk over points and merged intervals."""
    known = intervals.where(F.lit(True) if not by else F.coalesce(*[F.when(F.col(c).isNull(), False) for c in by], F.lit(True)))
    islands = merged(known, by).select(*by, F.col("lo").alias(time), "hi")
    out = nearest(points, islands, time, "hi", by, out="_hi", side="below")
    return out.withColumn("_in", F.coalesce(F.col(time) <= F.col("_hi"), F.lit(False))).drop("_hi")


def exclude_points(points: DataFrame, periods: DataFrame, time: str, by: str) -> DataFrame:
    """Points outside all closed periods of their run; points of a null run or time stay."""
    return _within(points, periods, time, [by]).where(~F.col("_in")).drop("_in")


def to_orbits(periods: DataFrame, limit: int, start: str, per_ms: float) -> DataFrame:
    """Periods in orbits, or in ms if their bounds exceed ``limit``, all as orbits since ``start``."""
    conv = lambda c: F.when(F.col(c) > limit, F.floor((F.col(c) - F.col(start)) * per_ms)).otherwise(F.col(c)).cast("long")
    return periods.withColumn("lo", conv("lo")).withColumn("hi", conv("hi"))


def range_lookup(df: DataFrame, ranges: list[tuple[float, float, int]] | int, rate: str, out: str, missing: int = -1) -> DataFrame:
    """The first range with a <= rate < b; a plain number holds for all rows.  The list is configuration and becomes one expression."""
    if isinstance(ranges, int):
        return df.withColumn(out, F.lit(ranges))
    found = None
    for a, b, v in ranges:
        c = (F.col(rate) >= a) & (F.col(rate) < b)
        found = F.when(c, v) if found is None else found.when(c, v)
    return df.withColumn(out, F.lit(missing) if found is None else found.otherwise(missing))


def _stretches(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """``df`` with a row (_l, _k) for each of the fewest stretches k * 2^l … (k + 1) * 2^l - 1 that make up [lo, hi]: two a length at most."""
    low, high, level = F.col(lo).cast("long"), F.col(hi).cast("long"), F.col("_l")
    at = lambda c: F.call_function("shiftright", c, level)
    rest = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), level))
    first = at(low) + F.when(low.bitwiseAND(rest) == 0, 0).otherwise(1)
    last = at(high) - F.when(high.bitwiseAND(rest) == rest, 0).otherwise(1)
    span = F.coalesce(F.length(F.bin(F.try_subtract(high, low))), F.lit(63))  # no number for a span of over 63 bits
    cut = df.withColumn("_l", F.explode(F.sequence(F.lit(0), span))).withColumns({"_f": first, "_t": last}).where("_f <= _t")
    ends = F.array_compact(F.array(F.when(F.col("_f").bitwiseAND(F.lit(1)) == 1, F.col("_f")), F.when(F.col("_t").bitwiseAND(F.lit(1)) == 0, F.col("_t"))))
    return cut.withColumn("_k", F.explode(ends)).drop("_f", "_t")


def run_lookup(df: DataFrame, settings: DataFrame, run: str) -> DataFrame:
    """Settings by run range (lo, hi, setting; closed): of several the one with the highest lo, of those the largest setting.

    Every row of ``df`` comes back once, repeated ones each; NULL where no range holds its run.  No pairs of runs and ranges are
    made: each stretch that some range is made up of keeps its best setting, and each distinct run asks the stretches it lies in, one of
    each length that occurs.
    """
    rows = df.select(F.struct("*").alias("_whole"), F.col(run).cast("long").alias("_x"))
    kept = _stretches(settings.where("hi >= lo").select("lo", "hi", "setting"), "lo", "hi")
    levels = sorted(r[0] for r in kept.select("_l").distinct().collect())  # 64 numbers at most
    best = kept.groupBy("_l", "_k").agg(F.max(F.struct("lo", "setting")).alias("_best"))
    asked = rows.select("_x").where("_x is not null").distinct().withColumn("_l", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    asked = asked.withColumn("_k", F.call_function("shiftright", "_x", "_l"))
    hit = asked.join(best, ["_l", "_k"]).groupBy("_x").agg(F.max("_best")["setting"].alias("setting"))
    return rows.join(hit, "_x", "left").select("_whole.*", "setting")


def skim(data: DataFrame, frames: DataFrame, time: str, backward: int = 55, forward: int = 55) -> DataFrame:
    """Data within [lo - backward, hi + forward] of some selected frame, each row once."""
    wide = frames.select((F.col("lo") - backward).alias("lo"), (F.col("hi") + forward).alias("hi"))
    return _within(data, wide, time, []).where("_in").drop("_in")


def plan_windows(labels: DataFrame, step: int, margin: int, by: str = "run") -> DataFrame:
    """Whole steps over each run's span (lo of the first to hi of the last label).

    A remainder of at least half a step is a window of its own, else the last window takes it in.  The margin is at most a tenth of
    the window's length.
    """
    runs = labels.groupBy(by).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    span = F.col("last") - F.col("first")
    whole = F.floor(span / step) if step > 0 else F.lit(0)
    n = F.when((span <= 0) | F.lit(step <= 0), 1).otherwise(F.greatest(F.lit(1), whole) + F.when((span - F.greatest(F.lit(1), whole) * step) * 2 >= step, 1).otherwise(0))
    w = runs.withColumn("n", n.cast("long")).withColumn("window", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    ws = F.col("first") + F.col("window") * step
    we = F.when(F.col("window") + 1 == F.col("n"), F.col("last")).otherwise(F.col("first") + (F.col("window") + 1) * step - 1)
    w = w.select(by, "window", ws.alias("ws"), we.alias("we"))
    return w.withColumn("margin", F.least(F.lit(margin), F.floor((F.col("we") - F.col("ws")) / 10)).cast("long"))


def order_by_distance(df: DataFrame, position: str, value: str, by: str) -> DataFrame:
    """Rows by ascending distance to a target interpolated from the run's extremes at ``position`` (clamped to 0..1).

    Runs in which some row lacks the value are left out.
    """
    g = df.groupBy(by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count_if(F.col(value).isNull()).alias("_none")).where("_none = 0")
    at = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(position)))
    j = df.join(g, by).withColumn("distance", F.abs(F.col(value) - (F.col("_lo") + at * (F.col("_hi") - F.col("_lo")))))
    w = Window.partitionBy(by).orderBy("distance", value)
    return j.withColumn("rank", F.row_number().over(w)).drop("_lo", "_hi", "_none")


def consecutive(df: DataFrame, ident: str, start: int, n: int, blocks: str | None = None, count: int | None = None) -> DataFrame:
    """From the smallest id at or above ``start`` the next n, optionally only those with ``count`` blocks."""
    rows = df.where(F.col(ident) >= start)
    if blocks:
        rows = rows.where(F.col(blocks) == count)
    return rows.orderBy(ident).limit(n)
