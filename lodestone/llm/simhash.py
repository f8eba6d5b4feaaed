"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments.  The binary Golay code [23, 12, 7] is perfect: each 23-bit word lies within three
bits of exactly one codeword.  Decoding a segment and its 23 neighbours at one flipped bit gives one or six codeword indices, and
two segments that differ in at most two bits have a common neighbour, so they share an index.  Of two errors in three segments at
least one segment has none: the key of that exact segment with a Golay index of the next segment is shared by every pair of
fingerprints at distance two or less.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, documents, table

#: First bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
GOLAY_LENGTH, GOLAY_POLYNOMIAL, CHECK_BITS = 23, 0b101011100011, 11


def fingerprint(words: list[bytes], width: int = 3, seed: int = 42) -> int:
    """The majority of the bits of the XXH64 of all word shingles; 0 for no words."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(text, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-width]])
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(text[a:b], seed) for a, b in zip(starts.tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        some = hashes[at : at + 4096].astype("<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


FINGERPRINTS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint((t or "").encode("utf-8", "surrogatepass").lower().split()) for t in batch.column("text").to_pylist()]
        fp = pa.array(np.array(found, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), fp], schema=FINGERPRINTS)


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of the division by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(GOLAY_LENGTH - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY_POLYNOMIAL << (bit - CHECK_BITS)), rest)
    return rest


@lru_cache(1)
def leaders() -> np.ndarray:
    """By syndrome, the only error pattern of at most three bits with it."""
    patterns = np.array([sum(1 << b for b in c) for n in range(4) for c in combinations(range(GOLAY_LENGTH), n)], np.int64)
    out = np.zeros(1 << CHECK_BITS, np.int64)
    out[syndrome(patterns)] = patterns
    return out


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each word."""
    return (words ^ leaders()[syndrome(words)]) >> CHECK_BITS


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, index) for each distinct index among a word and its one-bit neighbours."""
    flips = np.concatenate([[0], 1 << np.arange(GOLAY_LENGTH, dtype=np.int64)])
    index = np.sort(decode((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), -1), axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    at, column = np.nonzero(new)
    return at, index[at, column]


KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])


def fuzzy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        parts = [(fp >> first) & ((1 << width) - 1) for first, width in SEGMENTS]
        for k in range(len(SEGMENTS)):
            at, index = golay_keys(parts[(k + 1) % len(SEGMENTS)])
            key = (k << 40) | (parts[k][at] << 12) | index
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], schema=KEYS)


def links(nodes: DataFrame, bucket: int = 64) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints ``nodes(fp)`` linked at two or fewer bits, directly or over others.

    Keys shared by 2 to ``bucket`` fingerprints are joined and the pairs verified.  The fingerprints of more frequent keys meet at
    their 65 neighbours within one bit instead: two that share such a midpoint are at most two bits apart and the reverse, a midpoint
    has 65 neighbours at most, and each is tied to the smallest, so that no group's pairs are ever written out.
    """
    keys = table(nodes.mapInArrow(fuzzy_keys, "key long, fp long"), "keys")
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = table(keys.join(counts, "key"), "shared")
    cold = shared.where(F.col("n") <= bucket).select("key", F.col("fp").alias("a"))
    other = cold.select("key", F.col("a").alias("b"))
    pairs = cold.join(other, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    hot = shared.where(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - ((1 << 64) if k == 63 else 0)).cast("long") for k in range(64)])
    near = hot.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    met = near.groupBy("mid").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    tied = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return pairs.unionByName(tied).distinct()


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row, doc_id, fp (the fingerprint as a signed long), fingerprint (hex), component_id.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and hashed by 3-word shingles; shorter texts are one
    shingle.  Null and empty texts have fingerprint 0, which links like any other.  ``component_id`` is the smallest id reachable,
    nulls left out unless all are null; equal rows get equal results; an empty table gives an empty result; other columns are ignored.
    """
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = table(given.mapInArrow(fingerprints, "row long, doc_id long, fp long"), "fingerprints")
    nodes = table(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp")))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = table(named, "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(classes, "fp").select("row", "doc_id", "fp", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies, that with the smallest id; all columns unchanged.

    A null id is larger than any other; of repeated rows one stays; null, empty and blank texts are one group; an empty table gives
    an empty result.
    """
    rows = table(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("at")), "whole")
    found = simhash(rows.select("at", F.col("whole").getField(id_col).alias("d"), F.col("whole").getField(text_col).alias("t")), "at", "t")
    ids = rows.select("at", F.col("whole").getField(id_col).alias("d")).join(found.select(F.col("doc_id").alias("at"), F.col("component_id").alias("c")), "at")
    kept = ids.groupBy("c").agg(F.min(F.struct(F.col("d").isNull(), "d", "at")).alias("win")).select(F.col("win.at").alias("at"))
    return rows.join(kept, "at", "left_semi").select("whole.*")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
