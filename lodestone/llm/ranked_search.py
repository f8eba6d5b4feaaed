"""Ranked lexical search by best-first intervals over range-maximum tables.

Texts are read once: each document becomes the counts of those terms that some item holds.  Tasks then turn blocks of documents
into posting lists in document order, each with a sparse table of its largest impacts.  An interval of documents is bounded by
the sum, over the item's terms, of weight times the largest impact in the interval; the interval with the largest bound is split
at the document that holds the largest single share, which is scored, until no interval can reach the item's k-th score.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, table

#: Terms of the items that are searched for at once; an item belongs to one round whole.
ROUND_TERMS = 200_000
#: Postings of a block of documents, and postings below which an interval is scored whole.
BLOCK_POSTINGS, LEAF_POSTINGS = 1 << 20, 8192
#: Every byte that is no letter, digit or part of a longer character is a space; A-Z become small.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_TERMS).split()


ITEM_TERMS = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.binary()), ("times", pa.int64())])


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, name, text in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text")), strict=True):
            found = Counter(terms(text))
            columns = [[item] * len(found), [name] * len(found), list(found), list(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ITEM_TERMS, strict=True)], schema=ITEM_TERMS)


POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])


def count_terms(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document with a term: the number of its terms, and the counts of those in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            ids, sizes, held, times = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms(text.as_py())
                if words:
                    found = Counter(map(known, words))
                    found.pop(None, None)
                    ids.append(doc)
                    sizes.append(len(words))
                    held.append(list(found))
                    times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, sizes, held, times), POSTINGS, strict=True)], schema=POSTINGS)

    return run


class Top:
    """The k best of one item: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k, self.heap, self.least = k, [], 1

    def add(self, score: int, doc: int | None) -> None:
        key = (score, doc is not None, -(doc or 0))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, key)
        elif key > self.heap[0]:
            heapq.heapreplace(self.heap, key)
        if len(self.heap) == self.k:
            self.least = max(1, self.heap[0][0])

    def rows(self) -> list[tuple[int, int | None]]:
        return [(score, -at if given else None) for score, given, at in self.heap]


class Block:
    """Posting lists of a block of documents, and over all of them one sparse table of the places of largest impacts."""

    def __init__(self, docs: np.ndarray, null: np.ndarray, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int):
        """``docs``, ``null``, ``sizes`` by document; ``doc`` (place of the document), ``term``, ``times`` by posting."""
        self.docs, self.null, self.width = docs, null, len(docs)
        part = 75 + (25 * sizes * n_docs) // n_terms
        key = term * self.width + doc
        order = np.argsort(key, kind="stable")
        self.key, self.doc = key[order], doc[order]
        self.impact = ((1_000_000_000 * times) // (1000 * times + 12 * part[doc]))[order]
        longest = int(np.bincount(term).max()) if len(term) else 1
        self.log = np.zeros(longest + 2, np.int64)
        for i in range(2, longest + 2):
            self.log[i] = self.log[i >> 1] + 1
        # lists lie one after the other; places whose range runs into the next list are never asked for
        self.table = [np.arange(len(key), dtype=np.int32)]
        while 2 << (len(self.table) - 1) <= longest:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            right = np.concatenate([last[half:], last[len(last) - half :]])
            self.table.append(np.where(self.impact[last] >= self.impact[right], last, right))
        self.table = np.stack(self.table)

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each non-empty range [a, b) of one list."""
        k = self.log[b - a]
        left, right = self.table[k, a], self.table[k, b - (1 << k)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def search(self, term: np.ndarray, weight: np.ndarray, top: Top) -> None:
        """Add to ``top`` all documents that may belong to it; ``term`` are the item's distinct terms, ``weight`` times repeats."""
        base = term * self.width
        heap: list = []

        def push(lo: int, hi: int, a: np.ndarray, b: np.ndarray) -> None:
            some = np.flatnonzero(b > a)
            if not len(some):
                return
            best = self.largest(a[some], b[some])
            share = weight[some] * self.impact[best]
            bound = int(share.sum())
            if bound >= top.least:
                heapq.heappush(heap, (-bound, lo, hi, a, b, int(self.doc[best[share.argmax()]])))

        push(0, self.width, np.searchsorted(self.key, base), np.searchsorted(self.key, base + self.width))
        while heap and -heap[0][0] >= top.least:
            _, lo, hi, a, b, middle = heapq.heappop(heap)
            if int((b - a).sum()) <= LEAF_POSTINGS or hi - lo <= 2:
                self.score(lo, hi, a, b, weight, top)
                continue
            p = np.searchsorted(self.key, base + middle)
            q = np.searchsorted(self.key, base + middle + 1)
            self.score(middle, middle + 1, p, q, weight, top)
            for side in ((lo, middle, a, p), (middle + 1, hi, q, b)):
                if 8 * (side[1] - side[0]) > 7 * (hi - lo):  # the split leaves nearly all on one side: halve that side
                    cut = (side[0] + side[1]) // 2
                    c = np.searchsorted(self.key, base + cut)
                    push(side[0], cut, side[2], c)
                    push(cut, side[1], c, side[3])
                else:
                    push(*side)

    def score(self, lo: int, hi: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray, top: Top) -> None:
        """Score all documents of an interval."""
        sizes = b - a
        total = int(sizes.sum())
        if not total:
            return
        at = np.repeat(a - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(total)
        scores = np.zeros(hi - lo, np.int64)
        np.add.at(scores, self.doc[at] - lo, self.impact[at] * np.repeat(weight, sizes))
        able = np.flatnonzero(scores >= top.least)
        if len(able) > top.k:
            able = able[np.lexsort((self.docs[lo + able], self.null[lo + able], -scores[able]))[: top.k]]
        for i in able.tolist():
            top.add(int(scores[i]), None if self.null[lo + i] else int(self.docs[lo + i]))


FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def search_blocks(items: list[tuple], n_docs: int, n_terms: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best documents of each task; the scores an item has reached bound the task's later blocks.

    ``items``: (item, item_id, terms, weights).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in items]
        parts: list[pa.RecordBatch] = []
        held = 0

        def work() -> None:
            t = pa.Table.from_batches(parts).combine_chunks()
            null = t["doc_id"].is_null().to_numpy().astype(bool)
            ids = t["doc_id"].fill_null(0).to_numpy()
            lengths = np.diff(t["terms"].chunk(0).offsets.to_numpy())
            doc = np.repeat(np.arange(len(ids)), lengths)
            term, times = (t[c].chunk(0).flatten().to_numpy().astype(np.int64) for c in ("terms", "times"))
            block = Block(ids, null, t["n"].to_numpy(), doc, term, times, n_docs, n_terms)
            for (_, _, own, weight), top in zip(items, tops, strict=True):
                block.search(own, weight, top)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                parts.append(some)
                held += len(some.column("terms").flatten())
                if held >= BLOCK_POSTINGS:
                    work()
                    parts, held = [], 0
        if held:
            work()
        rows = [(item, name, doc, score) for (item, name, _, _), top in zip(items, tops, strict=True) for score, doc in top.rows()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(FOUND)], schema=FOUND)

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per item, first within 256 parts of an item's rows."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("part", F.pmod(F.hash("doc_id"), F.lit(256)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("r") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """For each row of ``items`` its ``k`` best rows of ``docs``: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all other than ASCII characters, A-Z in lower case, of the whole text.  The
    score of a document is the sum, over the item's terms with repeats, of weight times impact (``weights``, ``Block``); documents
    without a common term are not returned.  Equal scores stand by ascending id, null ids last.  Null and blank texts have no
    terms: such items get no rows and such documents don't count.  Repeated items are ranked each, repeated documents are ranked
    beside each other; an empty table on either side gives an empty result; other columns are ignored.

    Items are taken in rounds of about ROUND_TERMS terms, which bounds what is sent to the tasks; each round reads the texts.
    """
    spark = docs.sparkSession
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    held = table(rows.mapInArrow(item_terms, "item long, item_id long, term binary, times long"), "items")
    given = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rounds = math.ceil(held.count() / ROUND_TERMS)
    out = None
    for turn in range(rounds):
        own = held.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == turn).toArrow()
        if own.num_rows:
            found = best(_round(given, own, k), k).select("item_id", "rank", "doc_id", "score")
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def weights(df: dict[int, int], n_docs: int) -> dict[int, int]:
    """A term's weight by the number of documents that hold it."""
    return {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}


def _round(docs: DataFrame, own: pa.Table, k: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted(set(own["term"].to_pylist())))}
    postings = table(docs.mapInArrow(count_terms(vocabulary), "doc_id long, n long, terms array<int>, times array<int>"), "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = weights({r["term"]: r["count"] for r in df}, n_docs)
    by_item: dict = {}
    for item, name, term, times in zip(*(own[c].to_pylist() for c in ("item", "item_id", "term", "times")), strict=True):
        if weight.get(vocabulary[term]):
            by_item.setdefault((item, name), []).append((vocabulary[term], times * weight[vocabulary[term]]))
    packed = [(*key, *(np.array(c, np.int64) for c in zip(*sorted(pairs), strict=True))) for key, pairs in by_item.items()]
    return postings.where(F.size("terms") > 0).mapInArrow(search_blocks(packed, n_docs, n_terms or 1, k), "item long, item_id long, doc_id long, score long")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = """
with dt as (
  select doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from (select *, row_number() over () as row from documents)
), tf as (
  select row, doc_id, term, count(*) as tf from dt group by all
), n as (
  select row, sum(tf)::bigint as n from tf group by row
), g as (
  select count(*) as n_docs, sum(n)::bigint as n_terms from n
), w as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, g group by term, n_docs
), i as (
  select item, item_id, term, count(*) as times
  from (select item_id, item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from (select *, row_number() over () as item from benchmark))
  group by all
), s as (
  select item, item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
  from i join tf using (term) join w using (term) join n using (row), g group by all
), r as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from s where score > 0
)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20
"""
