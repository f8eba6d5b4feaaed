"""Nearest-in-order joins and sliding statistics, by running windows over ranges of the keys and the ordered column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import counted, table
from .ranges import fits, numbered, running


def nearest(left: DataFrame, right: DataFrame, on: str, value: str, by: list[str] = (), order: str | None = None, out: str = "nearest", side: str = "nearest") -> DataFrame:
    """``left`` with ``out``: ``value`` of the row of ``right`` with equal ``by`` and the nearest ``on``.

    Of two equally near rows the upper one counts; beyond the ends the end row; of rows with equal keys and ``on`` the last by
    ``order`` (default: the largest value).  Rows without any lookup row, or with a null ``on``, get NULL; null keys equal each other.

    With ``side`` "below" only lookup rows at or below ``on`` count, NULL where there is none.

    No pair of rows is ever formed: each key is walked once upwards and once downwards.  Where a count shows a key with too many rows
    for a task, both sides are dealt by ranges of (by, on) and the lookup rows at the ends of a range are carried over to those
    around it.
    """
    by = list(by)
    lookup = right.groupBy(*by, on).agg((F.max_by(value, order) if order else F.max(value)).alias("_v")).where(F.col(on).isNotNull())
    lookup = lookup.select(*by, on, F.struct(F.col(on).alias("x"), F.col("_v").alias("v")).alias("_hit"))
    both = left.withColumn("_left", F.lit(True)).unionByName(lookup, allowMissingColumns=True)
    walk = lambda part: (F.last("_hit", True).over(Window.partitionBy(*part).orderBy(o)) for o in (F.col(on).asc(), F.col(on).desc()))
    a, z = F.col("_a"), F.col("_z")
    lower = F.lit(True) if side == "below" else z.isNull() | (F.col(on) - a["x"] < z["x"] - F.col(on))
    chosen = F.when(F.col(on).isNotNull(), F.when(lower, a["v"]).otherwise(z["v"])).alias(out)
    own = [F.col(f"`{c}`") for c in left.columns]
    if fits(both, by):
        up, down = walk(by or [F.lit(0)])
        return both.withColumn("_a", up).withColumn("_z", down).where("_left").select(*own, chosen)
    dealt = table(both.repartitionByRange(*by, on).withColumn("_p", F.spark_partition_id()), "dealt")
    # a row per range and key
    ends = dealt.groupBy("_p", *by).agg(F.min_by("_hit", "_hit.x").alias("_first"), F.max_by("_hit", "_hit.x").alias("_last"))
    key = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = lambda o: key.orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        F.col("_p").alias("_q"), *[F.col(c).alias(f"_by_{c}") for c in by],
        F.last("_last", True).over(earlier(F.col("_p"))).alias("_below"), F.last("_first", True).over(earlier(F.col("_p").desc())).alias("_above"),
    )
    match = F.col("_p") == F.col("_q")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    up, down = walk(["_p", *by])
    j = dealt.withColumn("_a", up).withColumn("_z", down).where("_left").join(ends, match)
    return j.withColumn("_a", F.coalesce("_a", "_below")).withColumn("_z", F.coalesce("_z", "_above")).select(*own, chosen)


def _moments(rows: DataFrame, x: str, y: str, dx: float, part: list[str]) -> DataFrame:
    """mean and std at each home row of ``rows`` from running sums of the stretch.

    Each home row also sends a mark to either end of its span; the marks read the sums there, so that a row costs the same
    whatever the number of rows in its span.  Where a count shows a stretch with too many points for a task, its running sums go
    over ranges.
    """
    keep = [*part, F.col(x).alias("_home_x")]
    none = F.lit(None).cast("double")
    points = rows.select(*keep, F.col(x).alias("_x"), F.lit(1).alias("_kind"), F.col(y).cast("double").alias("_y"))
    home = rows.where("_home = _s")
    marks = [home.select(*keep, (F.col(x) + side).alias("_x"), F.lit(kind).alias("_kind"), none.alias("_y")) for side, kind in ((-dx, 0), (dx, 2))]
    every = points.unionByName(marks[0]).unionByName(marks[1])
    # sums around the stretch's mean, which keeps them small
    fit = fits(rows, part)
    if fit:
        every = every.withColumn("_m", F.avg("_y").over(Window.partitionBy(*part)))
    else:
        every = _joined(every, rows.groupBy(*part).agg(F.avg(y).alias("_m")), part)
    d = F.coalesce(F.col("_y") - F.col("_m"), F.lit(0.0))
    sums = {"_n": F.when(F.col("_kind") == 1, 1).otherwise(0), "_s1": d, "_s2": d * d}
    sums = running(every, part, ["_x", "_kind"], sums, fit).select(*part, "_home_x", "_kind", "_m", "_n", "_s1", "_s2")
    span = lambda c: F.sum(F.when(F.col("_kind") == 2, F.col(c)).otherwise(-F.col(c)))
    g = sums.where("_kind <> 1").groupBy(*part, "_home_x").agg(F.max("_m").alias("_m"), *[span(c).alias(c) for c in ("_n", "_s1", "_s2")])
    mean = F.try_divide(F.col("_s1"), F.col("_n"))
    var = F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * mean) / F.when(F.col("_n") > 1, F.col("_n") - 1)
    return g.select(*[c for c in part if c != "_s"], F.col("_home_x").alias(x), (F.col("_m") + mean).alias("mean"), F.sqrt(var).alias("std"))


def sliding(
    df: DataFrame, x: str, y: str, dx: float, by: list[str] = (), stats: tuple[str, ...] = ("mean", "std"), order: str | None = None, query: DataFrame | None = None
) -> DataFrame:
    """Statistics of ``y`` over the points of equal ``by`` within ``x`` ± ``dx``: mean, std (sample, NULL for one point), median (upper).

    Points are the distinct ``x`` of ``df``, of rows with equal ``x`` the last by ``order`` (default: the largest ``y``) counts; rows with
    a null ``x`` or ``y`` are no points.  The statistics are those at a point; each row of ``query`` (default: ``df``) gets those of
    its nearest point, of two equally near ones the upper.

    Mean and std: points are windowed per key and stretch of eight ``dx``; one near a stretch's end is also a guest in the next.  They come
    from differences of running sums around the stretch's mean, with an error of some 1e-15 of the stretch's sums.  Medians: ``_medians``.
    """
    by = list(by)
    points = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, x).agg((F.max_by(y, order) if order else F.max(y)).alias("_y"))
    width = 8 * dx
    home = F.floor(F.col(x) / width)
    guests = F.array_distinct(F.array(home, F.floor((F.col(x) - dx) / width), F.floor((F.col(x) + dx) / width)))
    rows = points.withColumn("_home", home).withColumn("_s", F.explode(guests))
    part, found = [*by, "_s"], points.select(*by, x)
    if {"mean", "std"} & set(stats):
        found = _joined(found, _moments(rows, x, "_y", dx, part), [*by, x])
    if "median" in stats:
        found = _joined(found, _medians(points, x, "_y", dx, by), [*by, x])
    if query is None:
        return _joined(df, found.select(*by, x, *stats), [*by, x], "left")
    out = nearest(query, found.select(*by, x, F.struct(*stats).alias("_stats")), x, "_stats", by, out="_stats")
    return out.select(*[F.col(f"`{c}`") for c in query.columns], *[F.col(f"_stats.{s}").alias(s) for s in stats])


#: Points of a span that may be gathered; longer spans are searched.  Digits of a rank are of so many bits.
GATHERED, DIGIT = 256, 4


def _medians(points: DataFrame, x: str, y: str, dx: float, by: list[str]) -> DataFrame:
    """(by…, x, median): the upper median of ``y`` over the points of equal ``by`` within ``x`` ± ``dx``; ``x`` are distinct.

    Running counts of points give each span as a range of positions.  Where all spans are short their values are gathered, else they
    are found by ``select``, at a cost that doesn't grow with the span.
    """
    g = points.select(F.to_json(F.struct(*by)).alias("_g") if by else F.lit("").alias("_g"), *by, F.col(x).alias("_x"), F.col(y).alias("_y"))
    fit = fits(g, ["_g"])
    marks = [g.select("_g", "_x", (F.col("_x") + side).alias("_o"), F.lit(kind).alias("_kind")) for side, kind in ((-dx, 0), (0, 1), (dx, 2))]
    counts = running(marks[0].unionByName(marks[1]).unionByName(marks[2]), ["_g"], ["_o", "_kind"], {"_n": F.when(F.col("_kind") == 1, 1).otherwise(0)}, fit)
    at = lambda k: F.max(F.when(F.col("_kind") == k, F.col("_n")))
    spans = counts.groupBy("_g", "_x").agg(at(0).alias("_a"), at(1).alias("_i"), at(2).alias("_b"))
    spans, seen = counted(spans, "spans", longest=F.coalesce(F.max(F.col("_b") - F.col("_a")), F.lit(0)))
    if seen["longest"] <= GATHERED:
        width = 8 * dx
        home = F.floor(F.col("_x") / width)
        guests = F.array_distinct(F.array(home, F.floor((F.col("_x") - dx) / width), F.floor((F.col("_x") + dx) / width))) if dx > 0 else F.array(home)
        rows = g.withColumn("_home", home).withColumn("_s", F.explode(guests))
        around = F.array_sort(F.collect_list("_y").over(Window.partitionBy("_g", "_s").orderBy("_x").rangeBetween(-dx, dx)))
        return rows.withColumn("_l", around).where("_home = _s").select(*by, F.col("_x").alias(x), F.element_at("_l", (F.floor(F.size("_l") / 2) + 1).cast("int")).alias("median"))
    ranked = table(numbered(g, ["_g"], ["_y", "_x"], "_rank", fit), "ranked")
    rows = ranked.select("_g", "_x", "_rank").join(spans.select("_g", "_x", (F.col("_i") - 1).alias("_pos")), ["_g", "_x"]).select("_g", "_pos", "_rank")
    asked = spans.select("_g", "_x", "_a", "_b", F.floor((F.col("_b") - F.col("_a")) / 2).alias("_k"))
    hit = select(rows, asked, fit).join(ranked.select("_g", "_rank", F.col("_y").alias("median")), ["_g", "_rank"])
    return g.select("_g", *by, "_x").join(hit.select("_g", "_x", "median"), ["_g", "_x"]).select(*by, F.col("_x").alias(x), "median")


def select(rows: DataFrame, asked: DataFrame, fit: bool | None = None) -> DataFrame:
    """``asked(_g, …, _a, _b, _k)`` with ``_rank``: the k-th smallest (from 0) of the ranks at positions _a to _b - 1 of a group.

    ``rows(_g, _pos, _rank)``: positions and ranks from 0, each a permutation.  The ranks are read digit by digit from the top: running
    counts of each digit along the positions say how many of a range have which digit, so the k-th's digit is known; then rows move,
    in order, to places sorted by that digit, and so do the ranges (a wavelet matrix).  A level is two joins on (group, position),
    whatever the length of the ranges, and there are log16 of the group's size of them.
    """
    top = rows.agg(F.max("_rank")).first()[0] or 0
    keep = [c for c in asked.columns if c not in ("_a", "_b", "_k")]
    asked = asked.withColumn("_rank", F.lit(0).cast("long"))
    width = 1 << DIGIT
    for shift in range((max(top.bit_length(), 1) - 1) // DIGIT * DIGIT, -1, -DIGIT):
        digit = F.shiftright("_rank", shift).bitwiseAND(width - 1).cast("int")
        own = rows.withColumn("_d", digit)
        sums = running(own, ["_g"], ["_pos"], {f"_c{d}": (F.col("_d") == d).cast("long") for d in range(width)}, fit)
        totals = own.groupBy("_g").agg(*[F.count_if(F.col("_d") == d).alias(f"_t{d}") for d in range(width)])
        starts = [F.lit(0).cast("long")]
        for d in range(width - 1):
            starts.append(starts[-1] + F.col(f"_t{d}"))
        level = sums.join(totals, "_g").select("_g", "_pos", "_rank", "_d", F.array(*[f"_c{d}" for d in range(width)]).alias("_n"), F.array(*starts).alias("_s"))
        level = table(level, "level")
        end = lambda n, p: level.select("_g", (F.col("_pos") + 1).alias(p), F.col("_n").alias(n))
        ends = asked.join(level.select("_g", (F.col("_pos") + 1).alias("_b"), F.col("_n").alias("_nb"), "_s"), ["_g", "_b"]).join(end("_na", "_a"), ["_g", "_a"], "left")
        ends = ends.withColumn("_na", F.coalesce("_na", F.array_repeat(F.lit(0).cast("long"), width)))
        below = [F.col("_nb")[0] - F.col("_na")[0]]
        for d in range(1, width):
            below.append(below[-1] + F.col("_nb")[d] - F.col("_na")[d])
        ends = ends.withColumn("_below", F.array(*below))
        ends = ends.withColumn("_c", F.size(F.filter("_below", lambda n: n <= F.col("_k"))))
        pick = lambda c, i=F.col("_c"): F.get(F.col(c), i)
        less = F.coalesce(F.get(F.col("_below"), F.col("_c") - 1), F.lit(0))
        asked = ends.select(
            *keep, (pick("_s") + pick("_na")).alias("_a"), (pick("_s") + pick("_nb")).alias("_b"), (F.col("_k") - F.when(F.col("_c") > 0, less).otherwise(0)).alias("_k"), (F.col("_rank") * width + F.col("_c")).alias("_rank")
        )
        asked = table(asked, "asked")
        rows = level.select("_g", (F.get(F.col("_s"), F.col("_d")) + F.get(F.col("_n"), F.col("_d")) - 1).alias("_pos"), "_rank")
    return asked.select(*keep, "_rank")


def _joined(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which null keys equal each other."""
    b = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return a.join(b, match, how).drop(*[f"_k_{k}" for k in keys])


_lookups: dict[tuple[str, str], tuple[DataFrame, str, str, list[str]]] = {}


def _named(df: DataFrame, name: str) -> tuple[str, str]:
    return df.sparkSession.sparkContext.applicationId, name


def register_lookup(name: str, table: DataFrame, on: str, value: str, by: list[str] = ()) -> None:
    """Name a lookup table for later use by ``lookup`` in the same application."""
    _lookups[_named(table, name)] = (table, on, value, list(by))


def unregister_lookup(df: DataFrame, name: str) -> None:
    """Forget a name in the application of ``df``."""
    _lookups.pop(_named(df, name), None)


def lookup(df: DataFrame, name: str, alias: str) -> DataFrame:
    table, on, value, by = _lookups[_named(df, name)]
    return nearest(df, table, on, value, by, out=alias)
