"""Quality rules with cross-document line frequencies per host."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, table

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

PROFILE = (
    "row long, doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, host string, copy long, "
    "lines array<struct<line: long, words: long, at: array<int>>>"
)
ARROW = pa.schema(
    [(c, pa.int64()) for c in ("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("host", pa.string()), ("copy", pa.int64()), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64()), ("at", pa.list_(pa.int32()))])))]
)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of ``width`` words that the text holds twice or more, the first window included."""
    if len(words) <= width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    n = len(ids) - width + 1
    key = ids[:n]
    for k in range(1, width):  # windows as dense numbers, so that no product can overflow
        _, key = np.unique(key * len(seen) + ids[k : k + n], return_inverse=True)
    starts = np.flatnonzero(np.bincount(key)[key] > 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(cover)[:-1]))


def line_key(host: str | None, words: list[bytes]) -> int:
    """64 bits of the host and the normalised line: lower-cased A-Z, single spaces."""
    text = b" ".join(words).lower()
    head = b"-" if host is None else b"+" + host.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(head + b"\0" + text, digest_size=8).digest(), "little", signed=True)


def profile(batches: Iterator[pa.RecordBatch], with_at: bool = False) -> Iterator[pa.RecordBatch]:
    """The counts of each text and its lines, with the numbers of the lines if ``with_at`` (else null)."""
    for batch in batches:
        out = []
        for row, doc_id, host, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "host", "text")), strict=True):
            text = text or ""
            raw = text.encode("utf-8", "surrogatepass")
            words = raw.split()
            seen: set[bytes] = set()
            lines: dict[int, int] = {}
            at: dict[int, list[int]] = {}
            dup = 0
            for no, line in enumerate(raw.split(b"\n")):
                if own := line.split():
                    dup += line in seen
                    seen.add(line)
                    k = line_key(host, own)
                    lines[k] = lines.get(k, 0) + len(own)
                    if with_at:
                        at.setdefault(k, []).append(no)
            spaces, symbols = (len(raw) - len(raw.translate(None, x)) for x in (SPACES, SYMBOLS))
            copy = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
            pairs = [{"line": k, "words": n, "at": at.get(k)} for k, n in lines.items()]
            out.append((row, doc_id, len(words), len(text) - spaces, symbols, dup, repeated_words(words), host, copy, pairs))
        yield pa.RecordBatch.from_pylist([dict(zip(ARROW.names, x, strict=True)) for x in out], schema=ARROW)


def profile_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return profile(batches, True)


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_words: int = 50, max_repeat: float = 0.5, min_docs: int = 5, max_share: float = 0.05, min_left: float = 0.5,
    with_lines: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` with the base counts, ``base_failed``, ``n_common_words`` and ``kept``.

    A line (lower-cased A-Z, single spaces) is over the limit when it stands in at least ``min_docs`` distinct documents of its
    host and in more than ``max_share`` of them; exact copies of a text count as one document, so that a text isn't lost to its own copies.  A
    document whose words outside such lines are fewer than ``min_left`` of all is depleted and rejected.  Base rules reject
    documents under ``min_words`` words or with more than ``max_repeat`` of the words in repeated three-word windows.

    A null text has no words; a null host is a host of its own; repeated rows are judged alike; an empty table gives an empty
    result; other columns are ignored.  ``with_lines`` adds ``gone``: the numbers of the lines over the limit (null: none).
    """
    given = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")
    )
    rows = table(given.mapInArrow(profile_at if with_lines else profile, PROFILE), "profiles")
    lines = rows.select("row", "host", "copy", F.explode("lines").alias("l")).select("row", "host", "copy", "l.line", "l.words", "l.at")
    # Two partial aggregations: the copies of a text collapse where they lie, then the texts of a line are counted.
    texts = rows.select("host", "copy").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    per_line = lines.select("host", "line", "copy").distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    t = texts.select(F.col("host").alias("h"), "texts")
    common = per_line.join(t, F.col("host").eqNullSafe(F.col("h"))).where(F.col("docs") > max_share * F.col("texts")).select("line")
    lost = lines.join(common, "line").groupBy("row").agg(F.sum("words").alias("lost"), *([F.flatten(F.collect_list("at")).alias("gone")] if with_lines else []))
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    out = rows.drop("lines").join(lost, "row", "left").withColumn("n_common_words", F.coalesce("lost", F.lit(0)))
    depleted = F.col("n_words") - F.col("n_common_words") < min_left * F.col("n_words")
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~depleted)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_common_words"]


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(*COLUMNS)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """``docs`` without the rejected documents, and the texts of the others without their lines over the limit; other columns are
    unchanged.

    The verdict depends on host and text alone, so that repeated rows are kept or rejected together, whatever their ids.  A null or
    empty text has too few words and is rejected; a null host is a host of its own; an empty table gives an empty result.
    """
    judged = quality_rules(docs.select(F.xxhash64(F.col(text_col), F.col(host_col)).alias("k"), F.col(text_col).alias("t"), F.col(host_col).alias("h")), "k", "t", "h", with_lines=True, **limits)
    # Rows of one k are judged alike.  As a string the line numbers are aggregated and joined like any plain value.
    lost = F.concat_ws(",", F.col("gone").cast("array<string>"))
    good = judged.where("kept").groupBy(F.col("doc_id").alias("_k"), F.col("host").alias("_h")).agg(F.max(lost).alias("_gone"))
    whole = docs.select(F.struct("*").alias("whole"), F.xxhash64(F.col(text_col), F.col(host_col)).alias("_id"), F.col(host_col).cast("string").alias("_host"))
    joined = whole.join(good, (F.col("_id") == F.col("_k")) & F.col("_host").eqNullSafe(F.col("_h"))).withColumn("_gone", F.when(F.col("_gone") != "", F.split("_gone", ",").cast("array<int>")))
    left = F.array_join(F.filter(F.split(F.col("whole").getField(text_col), "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("whole").getField(text_col)).otherwise(left)
    return joined.select(F.col("whole").withField(text_col, text).alias("whole")).select("whole.*")


#: The words of a text as DuckDB sees them.
WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP6_SQL = f"""
with d as (
  select doc_id, source as host, coalesce(text, '') as text, md5(coalesce(text, '')) as copy, row_number() over () as row, {WORDS} as w from documents
), tri as (
  select row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t from (select row, w, unnest(range(1, len(w) - 1)) as i from d where len(w) > 2)
), rep as (
  select row, i from (select row, i, count(*) over (partition by row, t) as c from tri) where c > 1
), cov as (
  select row, count(distinct j) as n from (select row, unnest([i, i + 1, i + 2]) as j from rep) group by row
), l as (
  select row, host, copy, line, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as lw from (select row, host, copy, unnest(string_split(text, chr(10))) as line from d)
), lines as (
  select *, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from l where len(lw) > 0
), dup as (
  select row, sum(c - 1) as n from (select row, line, count(*) as c from lines group by row, line) group by row
), hosts as (
  select host, count(distinct copy) as texts from d group by host
), common as (
  select host, norm from (select host, norm, count(distinct copy) as docs from lines group by host, norm) join hosts using (host)
  where docs >= 5 and docs > 0.05 * texts
), lost as (
  select row, sum(len(lw)) as n from lines join common using (host, norm) group by row
), m as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
         coalesce(cov.n, 0)::bigint as n_repeat_words, coalesce(lost.n, 0)::bigint as n_common_words
  from d left join dup using (row) left join cov using (row) left join lost using (row)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select *, not base_failed and 100 * (n_words - n_common_words) >= 50 * n_words as kept from b
"""
