"""Exact dedup by a heavy-hitter split, in DataFrame functions only.

A mergeable Misra-Gries style sketch (``approx_top_k``) names the few digests that may be frequent.  Their true counts and
winners are computed exactly by partial aggregation, verified, and broadcast (at most ``heavy_items`` rows), so that the copies
of a hot text are settled where they lie.  All other digests use an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, documents, table


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy_items: int = 256, sketch_items: int = 4096, heavy_rows: int = 1000) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z.  A null text counts as empty; an empty table gives an empty result;
    other columns are ignored whatever their names.  Of equal texts the largest id stays; a null id is smaller than any other;
    if rows repeat the largest id, one of them is kept and the others are not.  Sketch counts only choose the route: a digest is
    heavy when it has at least ``heavy_rows`` rows by an exact count.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256).alias("text_sha256"))
    rows = table(base.withColumn("row", F.monotonically_increasing_id()), "digests")
    winner = [F.max(F.struct("doc_id", "row")).alias("win"), F.count("*").alias("group_size")]
    sketch = rows.agg(F.expr(f"approx_top_k(text_sha256, {int(heavy_items)}, {int(sketch_items)})").alias("top"))
    named = sketch.select(F.explode("top.item").alias("text_sha256")).where("text_sha256 is not null")
    heavy = rows.join(F.broadcast(named), "text_sha256", "left_semi").groupBy("text_sha256").agg(*winner).where(F.col("group_size") >= heavy_rows)
    heavy = table(heavy, "heavy")
    hot = rows.join(F.broadcast(heavy), "text_sha256")
    rest = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    rest = rest.join(rest.groupBy("text_sha256").agg(*winner), "text_sha256")
    return hot.unionByName(rest).select(
        "doc_id", F.col("win.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("win.row")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: the kept row of each group, all columns unchanged.

    Rows that repeat both the kept id and its text are one document; one of them is returned, whichever comes first where they
    differ in letter case or other columns.  Null texts and empty ones are copies of each other; a null id stays only where all
    of a group are null; an empty table gives an empty result.
    """
    key = F.concat_ws(":", "text_sha256", F.col("doc_id").cast("string")).alias("k")
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(key)
    digest = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    whole = docs.select(F.struct("*").alias("whole"), F.concat_ws(":", digest, F.col(id_col).cast("string")).alias("k"))
    return whole.join(kept, "k", "left_semi").groupBy("k").agg(F.first("whole").alias("whole")).select("whole.*")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP2_SQL = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       row_number() over (partition by text_sha256 order by doc_id desc nulls last) = 1 as kept, text_sha256
from d window w as (partition by text_sha256)
"""
