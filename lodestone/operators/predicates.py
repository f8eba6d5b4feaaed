"""Row filters by path, trigger and position in a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_path(path: Column) -> Column:
    """Without doubled, leading and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "^/|/$", "")


def by_path(df: DataFrame, path: str, wanted: list[str]) -> DataFrame:
    """Folders inside a wanted one, which opens its whole subtree, and folders on the way to one."""
    p, keep = normal_path(F.col(path)), F.lit(False)
    for w in wanted:
        w = "/".join(x for x in w.split("/") if x)
        keep = keep | p.contains(w) | F.lit(w).contains(p)
    return df.where(keep)


def triggered(df: DataFrame, mask: str) -> DataFrame:
    """Rows with any trigger bit."""
    return df.where(F.col(mask) != 0)


def events_before(counts: DataFrame, by: str, frame: str, n: str, offset: int = 0) -> DataFrame:
    """``before``: the offset and the events of all earlier frames of the file."""
    w = Window.partitionBy(by).orderBy(frame).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.lit(offset) + F.coalesce(F.sum(n).over(w), F.lit(0)))
