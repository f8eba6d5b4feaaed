"""Checks over linked tables; each returns a small DataFrame of findings or counts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .links import PART
from .ranges import with_previous


def monotonic(df: DataFrame, by: str, value: str, part: list[str], strict: bool = True, fit: bool | None = None) -> DataFrame:
    """Per part: rows, violations against the row before, first violation's position, largest backward jump."""
    df, prev = with_previous(df.select(*part, by, value), part, by, value, fit=fit), F.col("_prev")
    bad = (F.col(value) <= prev) if strict else (F.col(value) < prev)
    v = df.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn("_jump", prev - F.col(value))
    return v.groupBy(*part).agg(
        F.count("*").alias("rows"), F.count_if("_bad").alias("violations"), F.min(F.when(F.col("_bad"), F.col(by))).alias("first"), F.max(F.when(F.col("_bad"), F.col("_jump"))).alias("max_jump")
    )


def violation_samples(df: DataFrame, by: str, value: str, part: list[str], n: int = 5, fit: bool | None = None) -> DataFrame:
    """The first n violations of each part with the value before."""
    bad = with_previous(df.select(*part, by, value), part, by, value, "previous", fit=fit).where(F.col(value) < F.col("previous"))
    nth = F.row_number().over(Window.partitionBy(*part).orderBy(by))
    return bad.withColumn("_n", nth).where(F.col("_n") <= n).select(*part, by, value, "previous")


def monotonic_running(df: DataFrame, by: str, value: str, part: list[str], fit: bool | None = None) -> DataFrame:
    """As ``monotonic``, against the largest valid value so far; negative values are ignored."""
    valid = F.when(F.col(value) >= 0, F.col(value))
    df, top = with_previous(df.select(*part, by, value), part, by, value, top=valid, fit=fit), F.col("_top")
    bad = (F.col(value) >= 0) & (F.col(value) < top)
    v = df.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn("_back", top - F.col(value))
    return v.groupBy(*part).agg(
        F.count("*").alias("rows"), F.count_if(F.col(value) < 0).alias("invalid"), F.count_if("_bad").alias("violations"), F.max(F.when(F.col("_bad"), F.col("_back"))).alias("max_back")
    )


def contiguity(df: DataFrame, by: str, group: str, part: list[str]) -> DataFrame:
    """Groups re-opened after being closed: runs of equal values less distinct values."""
    df, prev = with_previous(df.select(*part, by, group), part, by, group), F.col("_prev")
    v = df.withColumn("_new", (prev.isNull() | (prev != F.col(group))).cast("int")).where(F.col(group) >= 0)
    return v.groupBy(*part).agg(F.sum("_new").alias("runs"), F.countDistinct(group).alias("groups")).withColumn("reopened", F.col("runs") - F.col("groups"))


def links_in_range(df: DataFrame, link: str, target: DataFrame, part: str = PART, kind: str = "scalar") -> DataFrame:
    """Per part: links, and how many are outside [-1, rows of the target)."""
    n = target.groupBy(part).agg(F.count("*").alias("_n"))
    if kind == "array":
        df = df.select(part, F.explode(link).alias(link))
    elif kind == "slice":
        df = df.select(part, F.explode(F.array(F.col(link)["first"], F.col(link)["last"])).alias(link))
    j = df.join(n, part, "left")
    bad = (F.col(link) < -1) | (F.col(link) >= F.coalesce("_n", F.lit(0)))
    return j.groupBy(part).agg(F.count(link).alias("links"), F.count_if(bad).alias("out_of_range"))


def paste_parity(child: DataFrame, parent: DataFrame, part: str = PART) -> DataFrame:
    """Row counts of both tables per part and whether they agree."""
    a, b = child.groupBy(part).agg(F.count("*").alias("child")), parent.groupBy(part).agg(F.count("*").alias("parent"))
    j = a.join(b, part, "full").select(part, F.coalesce("child", F.lit(0)).alias("child"), F.coalesce("parent", F.lit(0)).alias("parent"))
    return j.withColumn("equal", F.col("child") == F.col("parent"))


def mother_daughter(df: DataFrame, event: str, mother: str = "mother", first: str = "first_daughter", last: str = "last_daughter", part: str = PART) -> DataFrame:
    """Per part: slices that are half set, reversed or out of range, mothers out of range, and links into another event."""
    n = df.groupBy(part).agg(F.count("*").alias("_n"))  # a row per part
    rows = df.select(part, "row_id", event, mother, first, last).join(n, part)
    lone = (F.col(first) < 0) != (F.col(last) < 0)
    bad_slice = lone | ((F.col(first) >= 0) & ((F.col(first) > F.col(last)) | (F.col(last) >= F.col("_n"))))
    at = df.select(part, F.col("row_id").alias(mother), F.col(event).alias("_mother_event"))
    j = rows.withColumn("_slice", bad_slice).join(at, [part, mother], "left")
    bad_mother = (F.col(mother) >= 0) & F.col("_mother_event").isNull()
    cross = F.coalesce(F.col("_mother_event") != F.col(event), F.lit(False))
    return j.groupBy(part).agg(F.count_if("_slice").alias("bad_slice"), F.count_if(bad_mother).alias("bad_mother"), F.count_if(cross).alias("cross_event"))


def unregistered_links(df: DataFrame, registered: list[str]) -> list[str]:
    """Columns named like links that the registry doesn't know: schema only, no data."""
    return [c for c in df.columns if re.match(r"fIndex|.*[sS]lice", c) and c not in registered]


def multiset_excess(after: DataFrame, before: DataFrame, cols: list[str]) -> DataFrame:
    """Tuples that ``after`` holds more often than ``before``, with the surplus."""
    a, b = (x.groupBy(*cols).agg(F.count("*").alias(n)) for x, n in ((after, "_a"), (before, "_b")))
    cond = None
    b = b.toDF(*[f"_b{i}" for i in range(len(cols))], "_b")
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"_b{i}"))
        cond = e if cond is None else cond & e
    j = a.join(b, cond, "left")
    return j.select(*cols, (F.col("_a") - F.coalesce("_b", F.lit(0))).alias("excess")).where("excess > 0")


def fingerprint(df: DataFrame, payload: list[str]) -> DataFrame:
    """64 bits of the payload columns of each row."""
    return df.withColumn("_fp", F.xxhash64(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})))


def link_preservation(before: dict[str, DataFrame], after: dict[str, DataFrame], registry: dict[str, dict], part: str = PART) -> DataFrame:
    """Per table and link: tuples (own payload, target's payload) after that weren't there before.

    Payload is all columns but row numbers and links; a key table counts by its key alone.  A correct rewrite has no excess, except
    that a link may have become none.
    """
    def tuples(tables, name, link, target, kind):
        own, to = registry[name], registry[target]
        skip = {part, "row_id"}
        cols = lambda t, r: [r["key"]] if "key" in r else [c for c in t.columns if c not in skip | r.get("links", {}).keys()]
        a = fingerprint(tables[name], cols(tables[name], own)).withColumnRenamed("_fp", "own")
        t = fingerprint(tables[target], cols(tables[target], to)).select(part, F.col("row_id").alias("_l"), F.col("_fp").alias("target"))
        where = F.col(link) if kind == "scalar" else F.explode(link) if kind == "array" else F.explode(F.array(F.col(link)["first"], F.col(link)["last"]))
        return a.select(part, "own", where.alias("_l")).withColumn("_l", F.col("_l").cast("long")).join(t, [part, "_l"], "left").select(part, "own", "target")

    out = None
    for name, r in registry.items():
        for link, (target, kind) in r.get("links", {}).items():
            if name in before and target in before:
                e = multiset_excess(tuples(after, name, link, target, kind), tuples(before, name, link, target, kind), [part, "own", "target"])
                e = e.where(F.col("target").isNotNull()).agg(F.coalesce(F.sum("excess"), F.lit(0)).alias("unexplained"))
                e = e.select(F.lit(name).alias("table"), F.lit(link).alias("link"), "unexplained")
                out = e if out is None else out.unionByName(e)
    return out


def corruption(df: DataFrame, file: str, arrays: dict[str, str], required: list[str]) -> DataFrame:
    """Per file the worst row status: broken (a required value is missing), corrupted (array size is not its count), or ok."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    wrong = F.lit(False)
    for array, count in arrays.items():
        wrong = wrong | ~F.size(array).eqNullSafe(F.col(count))
    level = F.when(missing, 2).when(wrong, 1).otherwise(0)
    g = df.groupBy(file).agg(F.max(level).alias("_l"), F.count_if(level > 0).alias("bad_rows"))
    return g.select(file, F.element_at(F.array(F.lit("ok"), F.lit("corrupted"), F.lit("broken")), F.col("_l") + 1).alias("status"), "bad_rows")


def step_consistency(a: DataFrame, b: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Counts of two steps side by side and whether all agree."""
    x = a.groupBy(*keys).agg(*[F.sum(c).alias(f"{c}_1") for c in counts])
    y = b.groupBy(*keys).agg(*[F.sum(c).alias(f"{c}_2") for c in counts])
    j = x.join(y, keys, "full")
    same = F.lit(True)
    for c in counts:
        same = same & F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2"))
    return j.withColumn("consistent", same)


def expected_outputs(expected: DataFrame, present: DataFrame, runs: DataFrame) -> DataFrame:
    """Per task: expected and missing files, and a status from exit code, done marker and files, in this order."""
    files = expected.join(present.select("task", "file").distinct().withColumn("_there", F.lit(True)), ["task", "file"], "left")
    files = files.groupBy("task").agg(F.count("*").alias("expected"), F.count_if(F.col("_there").isNull()).alias("missing"))
    j = files.join(runs, "task", "left")
    status = F.when(F.col("exit_code").isNull(), "not_run").when(F.col("exit_code") != 0, "failed").when(~F.col("done"), "unfinished").when(F.col("missing") > 0, "incomplete").otherwise("ok")
    return j.select("task", "expected", "missing", status.alias("status"))


def metadata_consistency(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Do the first and last split of a run agree on these values?"""
    first = [F.min_by(c, order).alias(f"first_{c}") for c in values]
    last = [F.max_by(c, order).alias(f"last_{c}") for c in values]
    g = df.groupBy(*keys).agg(*first, *last)
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"first_{c}").eqNullSafe(F.col(f"last_{c}"))
    return g.withColumn("agree", same)
