"""Positions and neighbours in the order of a part, without a window over a whole part.

Rows are dealt by ranges of (part, order), so that a large part spreads over many tasks.  What a range has to know of the ranges before
it is one row per range and part.  Where a count shows that no part has more than TASK_ROWS rows, a part is one task's window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import table


#: Rows of a part that one task may sort.
TASK_ROWS = 2_000_000


def fits(df: DataFrame, part: list[str]) -> bool:
    """Has no part more than TASK_ROWS rows?  One number comes to the driver."""
    return (df.groupBy(*part).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0) <= TASK_ROWS


def small(*tables: DataFrame) -> bool | None:
    """True where the tables together have so few rows that no part of them can be too large; None where parts have to be counted.

    For plain tables the files' own row counts answer, without a scan.
    """
    return sum(t.count() for t in tables) <= TASK_ROWS or None


def _with_ends(dealt: DataFrame, part: list[str], ends: DataFrame) -> DataFrame:
    """``dealt`` with the columns of ``ends`` (_p, part…, …) for its range and part; null parts equal each other.

    ``ends`` is written out, so that its size is known before the join and ``dealt`` isn't shuffled for it.
    """
    ends = table(ends, "ends").withColumnsRenamed({c: f"_e_{c}" for c in ("_p", *part)})
    match = F.col("_p") == F.col("_e__p")
    for c in part:
        match = match & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    return dealt.join(ends, match).drop(*[f"_e_{c}" for c in ("_p", *part)])


def _earlier(part: list[str]):
    return Window.partitionBy(*(part or [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, part: list[str], order: list[str | Column], name: str, fit: bool | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``name``: the position from 0 of each row of a part in ``order``.

    Rows that tie in ``order`` may change places when the result is computed anew: order by enough columns, or keep the result in a
    table.  ``fit``: what ``fits`` says, where that is known.  ``keep``: the columns of the result besides ``part`` and ``name``, all
    where it isn't given.  By ranges only these are written out, and the result is that table with one small one joined to it.
    """
    columns = df.columns if keep is None else [*part, *keep]
    columns = [F.col(f"`{c}`") for c in columns if c != name]
    if fits(df, part) if fit is None else fit:
        w = Window.partitionBy(*(part or [F.lit(0)])).orderBy(*order)
        out = df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))
        return out if keep is None else out.select(*columns, name)
    dealt = df.repartitionByRange(*part, *order).sortWithinPartitions(*part, *order)
    dealt = table(dealt.select(*columns, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_at")), "numbered")
    ends = dealt.groupBy("_p", *part).agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    ends = ends.select("_p", *part, (F.coalesce(F.sum("_n").over(_earlier(part)), F.lit(0)) - F.col("_from")).alias("_move"))
    return _with_ends(dealt, part, ends).withColumn(name, F.col("_at") + F.col("_move")).select(*columns, name)


def with_previous(df: DataFrame, part: list[str], order: str, value: str, name: str = "_prev", top: Column | None = None, fit: bool | None = None) -> DataFrame:
    """``df`` with ``name``: ``value`` of the row before, and, if ``top`` is given, ``_top``: its largest value in all rows before.

    ``fit``: what ``fits`` says, where that is known.
    """
    if fits(df, part) if fit is None else fit:
        w = Window.partitionBy(*(part or [F.lit(0)])).orderBy(order)
        out = df.withColumn(name, F.lag(value).over(w))
        return out if top is None else out.withColumn("_top", F.max(top).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    dealt = table(df.repartitionByRange(*part, order).withColumn("_p", F.spark_partition_id()), "dealt")
    wanted = [F.max_by(F.struct(F.col(value).alias("v")), order).alias("_last")] + ([F.max(top).alias("_most")] if top is not None else [])
    ends = dealt.groupBy("_p", *part).agg(*wanted)
    carried = [F.last("_last").over(_earlier(part)).alias("_carried")] + ([F.max("_most").over(_earlier(part)).alias("_above")] if top is not None else [])
    inner = Window.partitionBy("_p", *part).orderBy(order)
    own = dealt.withColumn("_own", F.lag(F.struct(F.col(value).alias("v"))).over(inner))
    if top is not None:
        own = own.withColumn("_so_far", F.max(top).over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    out = _with_ends(own, part, ends.select("_p", *part, *carried)).withColumn(name, F.coalesce("_own", "_carried")["v"])
    if top is not None:
        out = out.withColumn("_top", F.greatest("_so_far", "_above"))
    return out.drop("_p", "_own", "_carried", "_so_far", "_above")


def running(df: DataFrame, part: list[str], order: list[str | Column], sums: dict[str, Column], fit: bool | None = None) -> DataFrame:
    """``df`` with running sums, each row's own value included, over the rows of its part in ``order``.

    Values are never NULL.  ``fit``: what ``fits`` says, where that is known.
    """
    if fits(df, part) if fit is None else fit:
        w = Window.partitionBy(*(part or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    dealt = df.withColumns({f"_v_{n}": c for n, c in sums.items()}).repartitionByRange(*part, *order).sortWithinPartitions(*part, *order)
    dealt = table(dealt.withColumn("_p", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "dealt")
    ends = dealt.groupBy("_p", *part).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    ends = ends.select("_p", *part, *[F.coalesce(F.sum(f"_t_{n}").over(_earlier(part)), F.lit(0)).alias(f"_b_{n}") for n in sums])
    inner = Window.partitionBy("_p", *part).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = dealt.withColumns({n: F.sum(f"_v_{n}").over(inner) for n in sums})
    out = _with_ends(own, part, ends).withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums})
    return out.drop("_p", "_at", *[f"_{k}_{n}" for k in "vb" for n in sums])
