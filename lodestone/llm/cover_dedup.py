"""Substring dedup on words by difference-cover anchors.

{0, 1, 3} is a difference cover modulo 7: for any two word positions some shift of less than 7 brings both onto cover positions.  So
two equal windows of 13 words share an aligned anchor: seven words that start at a cover position of either document, within
the first seven positions of the window.  Only anchors are hashed and compared across the corpus; windows around the anchors that
more than one document has are then extended to the full 13 words and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import SEEDS, blocks, by_doc, mix, runs, signed, span_hash, tags
from .common import documents, table

PERIOD, COVER, GRAM, WINDOW = 7, (0, 1, 3), 7, 13  # PERIOD + GRAM - 1 = WINDOW
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
HIT = pa.schema([("k", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one array, the start and end of each word, and where each text's words begin (with the total at the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return data, starts, ends, np.searchsorted(starts, offsets)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive word hashes; for the last positions it is of no use."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out) + words[k : k + n]
    return mix(out)


def hits(key: np.ndarray, owner: np.ndarray, docs: np.ndarray, at: np.ndarray, across: bool, with_own: bool = False) -> pa.RecordBatch:
    """Rows (k, doc, at) to be compared by k, and the key of the rows that aren't (own, else null) if ``with_own``.

    What the block itself shows to be repeated (over documents, if ``across``) goes straight to its document with the lowest bit of
    ``at`` set, and stands for comparison once: a hot key leaves each block as one row.
    """
    doc = docs[owner]
    order = np.lexsort((doc, key))
    first = runs(key[order])
    size = np.diff(np.append(first, len(key)))
    many = size > 1
    if across and len(key):
        many &= doc[order[first]] != doc[order[np.append(first[1:], len(key)) - 1]]
    sure = np.zeros(len(key), bool)
    sure[order] = np.repeat(many, size)
    lone = ~sure
    lone[order[first[many]]] = True
    # in the order of the texts, so that a document's rows stay together and compress well
    lone, sure = np.flatnonzero(lone), np.flatnonzero(sure)
    columns = [np.concatenate([signed(key)[lone], by_doc(doc[sure])]), np.concatenate([doc[lone], doc[sure]]), np.concatenate([at[lone], at[sure] | 1])]
    out = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=HIT)
    return out.append_column("own", pa.concat_arrays([pa.nulls(len(lone), pa.int64()), pa.array(signed(key)[sure])])) if with_own else out


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in blocks(batches):
        data, starts, ends, begin = word_spans(texts)
        g = grams(span_hash(data, starts, ends, SEEDS[0]), GRAM)
        count = np.diff(begin)
        owner = np.repeat(np.arange(len(ids)), count)[: len(g)]
        pos = np.arange(len(g)) - begin[owner]
        good = np.isin(pos % PERIOD, COVER) & (pos + GRAM <= count[owner]) & (count[owner] >= WINDOW)
        owner, pos = owner[good], pos[good]
        yield hits(g[good], owner, np.array(ids, np.int64), tags(texts)[owner] << 32 | pos << 1, True)


FOUND = pa.schema([("k", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])


def candidate_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that hold a shared anchor among their first positions, with 96 bits of their words.

    Of equal windows in a block only those of the smallest id stand for comparison; the others are removed whatever else there is.
    """
    for ids, texts, found in blocks(batches, "found"):
        docs, tag = np.array(ids, np.int64), tags(texts)
        data, starts, ends, begin = word_spans(texts)
        count = np.diff(begin)
        mark = np.zeros(len(starts) + PERIOD + 1, np.int64)
        for n, own in enumerate(found):
            at = np.asarray(own or [], np.int64)
            pos = np.unique((at[at >> 32 == tag[n]] & 0xFFFFFFFF) >> 1)
            np.add.at(mark, begin[n] + np.maximum(0, pos - PERIOD + 1), 1)
            np.add.at(mark, begin[n] + pos + 1, -1)
        owner = np.repeat(np.arange(len(ids)), count)
        pos = np.arange(len(starts)) - begin[owner]
        good = np.flatnonzero((np.cumsum(mark)[: len(starts)] > 0) & (pos + WINDOW <= count[owner]))
        if not len(good):
            continue
        key, check = (grams(span_hash(data, starts, ends, seed), WINDOW)[good] for seed in SEEDS)
        key, check = signed(key), signed(check >> np.uint64(32))
        doc, at = docs[owner[good]], tag[owner[good]] << 32 | pos[good] << 1
        order = np.lexsort((doc, check, key))
        k, c = key[order], check[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
        low = np.empty(len(key), np.int64)
        low[order] = doc[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
        sure = doc > low
        columns = [np.where(sure, by_doc(doc), key), np.where(sure, -1, check), doc, at | sure]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=FOUND)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
RESULT_SQL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"


def remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in blocks(batches, "found"):
            out = []
            for doc, text, own, tag in zip(ids, texts, found, tags(texts).tolist(), strict=True):
                words, gone = text.split(), 0
                at = np.asarray(own or [], np.int64)
                at = (at[at >> 32 == tag] & 0xFFFFFFFF) >> 1
                if len(at):
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + WINDOW, -1)
                    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                    gone = len(words) - len(kept)
                    kept_text = b" ".join([words[k] for k in kept.tolist()])
                else:
                    kept_text = b" ".join(words)
                out.append((doc, len(words), gone, hashlib.sha256(kept_text).hexdigest(), kept_text if with_text else None))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=RESULT)

    return run


def with_found(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    own = found.groupBy("doc").agg(F.collect_list("at").alias("found"))  # at most one entry per position of a document
    return docs.join(own, F.coalesce("doc_id", F.lit((1 << 63) - 1)) == F.col("doc"), how).select("doc_id", "text", "found")


def cover_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept (UTF-8 bytes if ``with_text``, else null).

    A word is removed when a window of 13 words over it also starts in a document with a smaller id.  Windows are judged on the
    input.  A null text has no words; a null id is larger than any other; rows with equal ids do not count against each other; an
    empty table gives an empty result; other columns are ignored.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = given.mapInArrow(anchors, "k long, doc long, at long")
    same = Window.partitionBy("k")
    shared = rows.withColumn("lo", F.min("doc").over(same)).withColumn("hi", F.max("doc").over(same))
    flagged = table(shared.where((F.col("at").bitwiseAND(F.lit(1)) == 1) | (F.col("lo") < F.col("hi"))).select("doc", "at"), "anchors")
    windows = with_found(given, flagged, "inner").mapInArrow(candidate_windows, "k long, check long, doc long, at long")
    earliest = windows.withColumn("lo", F.min("doc").over(Window.partitionBy("k", "check")))
    removed = table(earliest.where((F.col("at").bitwiseAND(F.lit(1)) == 1) | (F.col("doc") > F.col("lo"))).select("doc", "at"), "windows")
    out = with_found(given, removed, "left").mapInArrow(remove(with_text), RESULT_SQL)
    return out.withColumn("doc_id", F.when(F.col("doc_id") < (1 << 63) - 1, F.col("doc_id")))


def op4_cover_dedup(spark, sf_dir: str) -> DataFrame:
    return cover_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP4_SQL = """
with d as (
  select doc_id, row_number() over () as row, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
), win as (
  select row, doc_id, s, array_to_string(w[s : s + 12], ' ') as t from (select *, unnest(range(1, len(w) - 11)) as s from d where len(w) >= 13)
), gone as (
  select row, s from (select row, doc_id, s, min(doc_id) over (partition by t) as first from win) where doc_id > first
), word as (
  select distinct row, unnest(range(s, s + 13)) as i from gone
), n as (
  select row, count(*) as n, list(i) as i from word group by row
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
       sha256(array_to_string(case when n is null then w else list_filter(w, lambda x, k: not list_contains(i, k)) end, ' ')) as kept_sha256
from d left join n using (row)
"""
