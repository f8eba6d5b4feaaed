"""Mixing sources to target weights by hash-random order, distributed prefix sums and exact cuts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prefix_sums, table

WEIGHTS = (5, 2, 1)
COUNTED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64())])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [0 if t is None else len(t.encode("utf-8", "surrogatepass").split()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64())], schema=COUNTED)


def weighed(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``sources(source, source_size)`` with ``weight``: the weights in turn, by code point, null last."""
    given = sources.select(F.col("source").isNull().alias("last"), "source", "source_size", F.lit(1).alias("one"), F.lit(0).alias("all"))
    ranked = prefix_sums(given, ["all", "last", "source"], "one", "all", "ranked")
    turn = F.col("before") % len(weights)
    weight = F.coalesce(*[F.when(turn == i, F.lit(float(w))) for i, w in enumerate(weights)])
    return ranked.select("source", "source_size", weight.alias("weight"))


def shares(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``target`` for each source: ``share`` of all sizes by weight, at most ``most`` times the source's own size.

    Excess is shared anew by weight until no source is above; each round is one aggregation and brings three numbers.
    """
    cap = F.col("source_size") * most
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level > cap
        capped, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not weight:
            break
        new = (total - capped) / weight
        if level is not None and new <= level:
            break
        level = new
    target = cap if level is None else F.least(cap, F.col("weight") * level)
    return sources.withColumn("target", target)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, weights=WEIGHTS, share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: row, doc_id, source, size, source_size, target, taken.

    A document's place in its source is the MD5 of seed and id, so that reruns agree; rows with equal ids follow their size.  The
    mix takes documents in this order until the source's target (rounded down) is reached, the last one in part, and starts
    again from the first when the source is used up.  Null texts have size 0, a null source is a source of its own, sources
    without words get 0, an empty table gives an empty result; other columns are ignored.
    """
    given = docs.select(
        (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    sizes = table(given.mapInArrow(count_words, "row long, doc_id long, source string, size long"), "sizes")
    sources = table(weighed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "sources")
    sources = table(shares(sources, share, most), "targets").withColumnRenamed("source", "s")
    keyed = sizes.withColumn("key", F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id").cast("string"))))
    placed = prefix_sums(keyed, ["source", "key", "doc_id", "size"], "size", "source", "placed")
    out = placed.join(sources, F.col("source").eqNullSafe(F.col("s")))
    budget = F.floor("target")
    taken = F.lit(0)
    for epoch in range(most):
        taken = taken + F.greatest(F.lit(0), F.least(budget - F.col("source_size") * epoch - F.col("before"), F.col("size")))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts shortened to their first ``words`` words, the space before each word kept; whole texts where ``words`` is null."""
    for batch in batches:
        texts = []
        for text, words in zip(batch.column("text").to_pylist(), batch.column("words").to_pylist(), strict=True):
            if words is not None:
                raw = text.encode("utf-8", "surrogatepass")
                rest = raw.split(None, words)[words:]
                text = raw[: len(raw) - len(rest[0])].rstrip().decode("utf-8", "surrogatepass") if rest else text
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(texts, pa.string())], names=["whole", "text"])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per document and epoch; at a cut the text ends after its last word taken.

    Null and empty texts have no words to take and are left out; a null source is a source of its own; rows of a null id and
    repeated rows are taken like others; an empty table gives an empty result.
    """
    rows = table(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row")), "whole")
    taken = mix(rows.select("row", f"whole.`{id_col}`", f"whole.`{text_col}`", f"whole.`{source_col}`"), id_col, text_col, source_col, "row", **how)
    # a document's words taken: whole epochs, then a part
    parts = taken.where("taken > 0").select(F.col("row").alias("r"), F.col("size"), F.explode(F.expr("sequence(0, int(ceil(taken / size)) - 1)")).alias("epoch"), "taken")
    parts = parts.select("r", F.when((F.col("epoch") + 1) * F.col("size") > F.col("taken"), F.col("taken") - F.col("epoch") * F.col("size")).alias("words"))
    picked = rows.join(parts, F.col("row") == F.col("r")).select("whole", F.col("whole").getField(text_col).alias("text"), "words")
    kind = picked.select("whole").schema.simpleString()[7:-1]
    done = picked.where("words is null").select("whole").unionByName(
        picked.where("words is not null").mapInArrow(cut, f"{kind}, text string".replace("whole:", "whole ", 1)).select(F.col("whole").withField(text_col, F.col("text")).alias("whole"))
    )
    return done.select("whole.*").select(*[F.col(f"`{c}`") for c in docs.columns])


OP8_SQL = """
with d as (
  select row_number() over () as row, doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as size from documents
), s as (
  select source, sum(size) as source_size from d group by source
), r as (
  select *, [5, 2, 1][((row_number() over (order by source is null, encode(source)) - 1) % 3)::int + 1]::double as weight from s
), o as (
  select *, sum(2.0 * source_size) over w - 2.0 * source_size as capped, sum(weight) over (order by source_size / weight desc, source rows unbounded preceding) as rest,
         (select 1.5 * sum(source_size) from s) as total
  from r window w as (order by source_size / weight, source desc rows unbounded preceding)
), t as (
  select source, source_size, weight, case when rest > 0 then (total - capped) / rest end as level, 2.0 * source_size / weight as ratio from o
), lv as (
  select max(level) as level from t where ratio >= level
), g as (
  select source, source_size::bigint as source_size, least(2.0 * source_size, weight * (select level from lv)) as target from t
), p as (
  select d.*, sum(size) over (partition by source order by md5('mix/' || doc_id), doc_id, size, row rows unbounded preceding) - size as before from d
)
select doc_id, size::bigint as size, source_size, target,
       (greatest(0, least(floor(target) - before, size)) + greatest(0, least(floor(target) - source_size - before, size)))::bigint as taken
from p join g on p.source is not distinct from g.source
"""
