"""Catalog, report and content operators: file selection per run, hashes, profiles, logs and requests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def thinned(df: DataFrame, part: str) -> DataFrame:
    """Only the first part of a dataset: an aggregate joined back, pruned at the scan where the part is a folder."""
    first = df.agg(F.min(part).alias(part))
    return df.join(F.broadcast(first), part, "left_semi")  # a single row


def first_parts(df: DataFrame, part: str, n: int) -> DataFrame:
    """The rows of the first n parts."""
    return df.join(df.select(part).distinct().orderBy(part).limit(n), part, "left_semi")


def with_workflow_only(archives: DataFrame, workflows: DataFrame, folder: str) -> DataFrame:
    """Archives whose folder also holds a workflow."""
    return archives.join(workflows.select(folder), folder, "left_semi")


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key), key, "left_anti")


def best_pass(df: DataFrame, run: str, name: str, priority: list[str], order: str) -> DataFrame:
    """Per run the file of the best pass: listed passes in their order, unknown ones last."""
    rank = F.lit(len(priority))
    for k, p in reversed(list(enumerate(priority))):
        rank = F.when(F.col(name) == p, k).otherwise(rank)
    w = Window.partitionBy(run).orderBy(rank, order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def edge_splits(df: DataFrame, run: str, split: str, valid: Column, ascending: bool = True) -> DataFrame:
    """Per run the first split with valid metadata, in numeric order from either end; names that aren't numbers come last."""
    n = F.col(split).try_cast("int")
    order = (n.isNull(), n.asc() if ascending else n.desc(), F.col(split).asc() if ascending else F.col(split).desc())
    w = Window.partitionBy(run).orderBy(*order)
    return df.where(valid).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sample_per_group(df: DataFrame, group: str, ident: str, n: int, seed: str) -> DataFrame:
    """n rows of each group without replacement, by the hash of id and seed: the same rows in every run."""
    w = Window.partitionBy(group).orderBy(F.md5(F.concat_ws("/", F.col(ident).cast("string"), F.lit(seed))))
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def run_info_join(df: DataFrame, info: DataFrame, run: str) -> DataFrame:
    """The scalars of a run on all its rows.  The plan broadcasts the run table only if it is small."""
    return df.join(info, run, "left")


def insert_if_absent(counts: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Known counts stay, missing ones are added."""
    return counts.unionByName(new.join(counts, key, "left_anti").select(*counts.columns))


def frame_structure(df: DataFrame, frame: str, cols: list[str]) -> DataFrame:
    """The ordered list of tuples of each timeframe."""
    return df.groupBy(frame).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("collisions"))


def table_counts(tables: dict[str, DataFrame], pattern: str | None = None) -> DataFrame:
    """(table, rows); of versioned names only those that match the pattern."""
    out = None
    for name, df in tables.items():
        if pattern is None or re.fullmatch(pattern, name):
            n = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
            out = n if out is None else out.unionByName(n)
    return out


def size_profile(df: DataFrame) -> DataFrame:
    """(column, bytes, values): text and binary by length, arrays by elements, others by their type's width.  One scan."""
    width = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8}
    rows = []
    for c, t in df.dtypes:
        if t in ("string", "binary"):
            size = F.sum(F.octet_length(c))
        elif t.startswith("array<"):
            size = F.sum(F.size(c)) * width.get(t[6:-1], 8)
        else:
            size = F.count(c) * width.get(t, 8)
        rows.append(F.struct(F.lit(c).alias("column"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"), F.count(c).alias("values")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def row_fingerprint(cols: list[str]) -> Column:
    """MD5 of the columns' texts, NULLs marked."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]))


def hist_hash(bins: DataFrame, key: list[str] = ("object",)) -> DataFrame:
    """SHA-256 of a histogram: axis, then contents by bin."""
    item = F.struct("bin", F.concat_ws(":", F.col("bin").cast("string"), F.col("content").cast("long").cast("string")).alias("t"))
    g = bins.groupBy(*key).agg(F.array_sort(F.collect_list(item)).alias("b"))  # as many items as a histogram has bins
    return g.select(*key, F.sha2(F.concat_ws(",", F.concat_ws("/", *key), F.transform("b", lambda x: x["t"])), 256).alias("hash"))


def record_hash(df: DataFrame, cols: list[str]) -> DataFrame:
    """SHA-256 of each record as JSON with sorted keys."""
    return df.withColumn("hash", F.sha2(F.to_json(F.struct(*sorted(cols))), 256))


def job_status(df: DataFrame, group: list[str], status: str) -> DataFrame:
    n = lambda s: F.count_if(F.col(status) == s)
    return df.groupBy(*group).agg(F.count("*").alias("total"), n("DONE").alias("done"), n("RUNNING").alias("running"), n("ERROR").alias("error"))


def request_report(df: DataFrame, wanted: list[str], accepted: str) -> DataFrame:
    """A row per request and wanted label; a request that also has the label with the suffix ``accepted`` is done with it."""
    x = df.withColumn("label", F.explode("labels")).where(F.col("label").isin(wanted))
    x = x.where(~F.array_contains("labels", F.concat(F.col("label"), F.lit(accepted))))
    state = F.when(F.col("merged_at").isNotNull(), "merged").when(F.col("closed"), "closed").otherwise("open")
    return x.select("label", state.alias("state"), "request", "merged_at").orderBy("label", "state", "merged_at", "request")


def contradictions(settings: DataFrame) -> DataFrame:
    """Settings (group, key) that have more than one value, with the values in order."""
    g = settings.groupBy("group", "key").agg(F.array_sort(F.collect_set("value")).alias("values"))
    return g.where(F.size("values") > 1)


#: What marks a failure in a log.  Fixed values.
FAILURES = [
    r"\b[Ee]xception",
    "segmentation violation",
    "error while setting up workflow",
    "bus error",
    "Assertion.*failed",
    "Fatal in",
    r"libc\+\+abi.*terminating",
    "There was a crash.",
    "arrow.*Check failed",
    "terminate called after",
    "terminate called without an active",
    r"\]\[FATAL\]",
    r"\*\*\* Program crashed",
    r"\*\*\* Fatal Exception",
    "was killed abnormally",
    "line.*Killed",
    r"\*\*\* Error in",
]


def failure_context(lines: DataFrame, file: str, patterns: list[str] = FAILURES, before: int = 2, after: int = 10) -> DataFrame:
    """Per file the first line that some pattern finds, with the lines around it."""
    hit = lines.where(F.col("line").rlike("|".join(patterns))).groupBy(file).agg(F.min("line_no").alias("_at"))
    return lines.join(hit, file).where(F.col("line_no").between(F.col("_at") - before, F.col("_at") + after)).withColumn("first", F.col("line_no") == F.col("_at")).drop("_at")


def failed_tasks(lines: DataFrame) -> DataFrame:
    """(task, timeframe) of lines that tell of a failed task and a retry."""
    x = lines.where(F.col("line").rlike("failed.*retry"))
    name = F.regexp_extract("line", r"([A-Za-z][A-Za-z0-9]*)_([0-9]+)[^_0-9A-Za-z].*failed", 1)
    tf = F.regexp_extract("line", r"([A-Za-z][A-Za-z0-9]*)_([0-9]+)[^_0-9A-Za-z].*failed", 2)
    return x.select(name.alias("task"), tf.cast("int").alias("timeframe")).where("task <> ''").distinct()


def column_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (column, bytes, values) in only one of two profiles."""
    key = ["column", "bytes", "values"]
    return a.select(key).subtract(b.select(key)).withColumn("only", F.lit("first")).unionByName(b.select(key).subtract(a.select(key)).withColumn("only", F.lit("second")))


def compact_plan(files: DataFrame, by: str, order: str, size: str, target: int, min_pct: int = 20) -> DataFrame:
    """``group`` per file: files stay alone, but an undersized last file joins the one before it."""
    w = Window.partitionBy(by)
    n = F.row_number().over(w.orderBy(order))
    total = F.count("*").over(w)
    last_small = (n == total) & (total >= 2) & (F.col(size) * 100 < target * min_pct)
    return files.withColumn("group", (n - F.when(last_small, 1).otherwise(0)).cast("long"))
