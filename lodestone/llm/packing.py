"""Best-fit packing by a configuration linear program over the length histogram.

The program's columns are configurations: multisets of lengths that fit one sequence.  Multiplicative weights price the lengths, a
knapsack dynamic program finds the best configurations for the prices, and the cover they make is rounded; what rounding
leaves over is filled largest first with the best fitting lengths.  All of this works on a histogram with at most ``capacity``
entries, whatever the corpus.  Spark counts the histogram, ranks the pieces of each length and gives each its place.
"""

from __future__ import annotations

import logging
import os
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, table

CAPACITY = 2048
CACHED_WORDS = 500_000
PIECE = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int64()), ("at", pa.int64())]
)
PIECE_SQL = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part long, at long"

_encoders: dict[str, Encoder] = {}
#: Where a letter meets ASCII punctuation (an apostrophe may join them) the tokenizer cuts, so that a space there changes nothing.
MEETING = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([!-&(-/:-@\\[-`{-~])"
SPECIAL = "<|"
ONE_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[!-&(-/:-@\\[-`{-~]+")
WORD_END = "</w>"


class Encoder:
    """From texts to their ids as little-endian 32-bit bytes.

    The tokenizer lower-cases, drops white space and never joins across it.  So words can be encoded once and remembered, after A-Z
    are lower-cased and punctuation is set apart; texts that may hold a special token stay as they are.  The memory is emptied at
    ``CACHED_WORDS`` entries.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith(WORD_END)]] = True

    def encode(self, some: list[str]) -> Iterator[bytes]:
        """The ids of each string, many at a time.

        A string of letters or of punctuation alone is one word to the tokenizer and ends with the only token that marks a word's
        end.  Where this doesn't hold, a token belongs to the string in which it starts.
        """
        for at in range(0, len(some), 2000):
            strings = some[at : at + 2000]
            found = self.tokenizer.encode(" ".join(strings), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            if all(map(ONE_WORD.fullmatch, strings)) and len(cuts := np.flatnonzero(self.ends[ids]) + 1) == len(strings):
                cuts = np.concatenate([[0], cuts])
            else:
                starts = np.cumsum([0] + [len(x) + 1 for x in strings])
                cuts = np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), starts)
            raw = ids.tobytes()
            for a, b in pairwise((4 * cuts).tolist()):
                yield raw[a:b]

    def learn(self, words: list[str]) -> None:
        one = [w for w in words if ONE_WORD.fullmatch(w)]
        rest = [w for w in words if not ONE_WORD.fullmatch(w)]
        for some in (one, rest):
            self.words.update(zip(some, self.encode(some), strict=True))

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text (null: none).  Some megabytes at a time are split and numbered by distinct words, whose ids are then put
        in place by array operations."""
        at, sizes = 0, np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        while at < len(texts):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 8 << 20, side="right")))
            some = pc.fill_null(texts.slice(at, n), "")
            apart = pc.replace_substring_regex(pc.ascii_lower(some), MEETING, r"\1 \2")
            lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(some, SPECIAL), some, apart))
            at += n
            coded = lists.flatten().dictionary_encode()
            distinct, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            known = self.words
            if missing := [w for w in distinct if w not in known]:
                if len(known) + len(missing) > CACHED_WORDS:
                    known.clear()
                    missing = distinct
                self.learn(missing)
            found = [known[w] for w in distinct]
            pool, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
            start, each = np.cumsum(size) - size, size[codes] if len(codes) else np.zeros(0, np.int64)
            upto = np.cumsum(each)
            flat = pool[np.repeat(start[codes] - (upto - each), each) + np.arange(int(upto[-1]))] if len(codes) else pool
            bounds = np.concatenate([[0], upto])[np.asarray(lists.offsets) - int(lists.offsets[0].as_py())]
            raw = flat.tobytes()
            for a, b in pairwise((4 * bounds).tolist()):
                yield raw[a:b]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ranks = encoder(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            out = []
            rows = (batch.column(c).to_pylist() for c in ("row", "doc_id"))
            for row, doc_id, found in zip(*rows, encode.ids(batch.column("text")), strict=True):
                ids = found + bytes(4)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    ranks[n] = ranks.get(n, -1) + 1
                    out.append((row, doc_id, piece, at // 4, n, zlib.crc32(own), own if with_ids else None, part, ranks[n]))
            columns = list(zip(*out, strict=True)) or [()] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE, strict=True)], schema=PIECE)

    return run


def fillings(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity`` the highest price of a multiset that fits it, and the length to take first (-2: leave one
    place empty): the unbounded knapsack program."""
    value, take = np.zeros(capacity + 1), np.full(capacity + 1, -2)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if n := upto[room]:
            gain = value[room - lengths[:n]] + prices[:n]
            k = int(gain.argmax())
            if gain[k] > value[room]:
                value[room], take[room] = gain[k], k
    return value, take


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400, rate: float = 0.25, gap: float = 0.005) -> list[tuple[np.ndarray, float]]:
    """Configurations with fractional multiplicities that cover the whole demand, by multiplicative weights.

    A length's price starts at its size and falls as its coverage grows.  One knapsack program a round gives, for each length, the
    best configuration that holds it; those within a few percent of the best price enter, the lengths covered least first, as
    often as raises no length's coverage by more than ``rate`` of its demand in the round.  Any prices bound the number of sequences
    from below; rounds end when the cover is within ``gap`` of the best bound.  Where ``rounds`` end first, single
    configurations of the lengths behind complete the cover.
    """
    covered, found, total, bound, near = np.zeros(len(lengths)), {}, 0.0, 0.0, 0.02
    sizes = lengths.tolist()
    for _ in range(rounds):
        prices = lengths / capacity * np.exp(-(covered - covered.min()))
        value, take = fillings(lengths, prices, capacity)
        best = float(value[capacity])
        bound = max(bound, float(demand @ prices) / best)
        first, room = take.tolist(), np.zeros(len(lengths))
        good = prices + value[capacity - lengths] >= (1 - near) * best
        for k in np.argsort(covered, kind="stable").tolist():
            if not good[k] or room[k] > 0.9 * rate:
                continue
            own, left = {k: 1}, capacity - sizes[k]
            while left > 0:
                j = first[left]
                if j >= 0:
                    own[j] = own.get(j, 0) + 1
                    left -= sizes[j]
                else:
                    left -= 1
            step = min((rate - room[j]) * demand[j] / c for j, c in own.items())
            if step * own[k] < 0.02 * rate * demand[k]:
                continue
            for j, c in own.items():
                room[j] += step * c / demand[j]
            key = tuple(sorted(own.items()))
            found[key] = found.get(key, 0.0) + step
            total += step
        covered += room
        if covered.min() > 0 and total / covered.min() <= (1 + gap) * bound:
            break
    base = float(np.quantile(covered, 0.02)) or float(covered.max()) or 1.0
    for k in np.flatnonzero(covered < base).tolist():
        own = capacity // sizes[k]
        found[((k, own),)] = found.get(((k, own),), 0.0) + (base - covered[k]) * demand[k] / own
    out = []
    for key, times in found.items():
        counts = np.zeros(len(lengths), np.int16)
        counts[[j for j, _ in key]] = [c for _, c in key]
        out.append((counts, times / base))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = 400, placed: dict[str, int] | None = None) -> list[tuple[list[tuple[int, int]], int]]:
    """Configurations as ((length, count), ...) with whole multiplicities that use up the histogram exactly.

    The program's multiplicities are rounded down, then their fractions up, the largest first, while there are pieces; a place left in
    a configuration is filled largest first.  ``placed`` gets the sequences laid by the program and by the filler alone.
    """
    lengths = np.array(sorted(x for x in histogram if 0 < x < capacity), np.int64)
    left = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    out: list[tuple[list[tuple[int, int]], int]] = [([(capacity, 1)], histogram[capacity])] if histogram.get(capacity) else []
    laid = {"program": 0, "filler": 0}

    def use(counts: np.ndarray, most: int | None, by: str) -> None:
        """Largest first what still fits beside ``counts``, then as often as the pieces last, ``most`` times at most."""
        nonlocal left
        counts, rest, k = counts.astype(np.int64), left - counts, len(lengths)
        room = capacity - int(counts @ lengths)
        while room > 0:
            k = min(k, int(np.searchsorted(lengths, room, side="right")))
            there = np.flatnonzero(rest[:k])
            if not len(there):
                break
            k = int(there[-1])
            n = min(int(room // lengths[k]), int(rest[k]))
            counts[k] += n
            rest[k] -= n
            room -= n * int(lengths[k])
        own = np.flatnonzero(counts)
        times = int(np.min(left[own] // counts[own]))
        times = max(1, times if most is None else min(times, most))
        left = left - counts * times
        laid[by] += times
        out.append(([(int(lengths[k]), int(counts[k])) for k in own[::-1]], times))

    found = solve(lengths, left.astype(float), capacity, rounds) if len(lengths) else []
    for up, turn in ((0, sorted(found, key=lambda x: -x[1])), (1, sorted(found, key=lambda x: -(x[1] % 1)))):
        for counts, times in turn:
            own = np.flatnonzero(counts)
            more = 1 if up else int(times)
            while (n := min(more, int(np.min(left[own] // counts[own])))) > 0:
                was = laid["program"]
                use(counts, n, "program")
                more -= laid["program"] - was
    while left.any():  # the remainder
        use(np.zeros(len(lengths), np.int64), None, "filler")
    if placed is not None:
        placed.update(laid)
    return out


def places(configurations: list[tuple[list[tuple[int, int]], int]]) -> tuple[np.ndarray, ...]:
    """For each stretch of ranks of a length: length, first rank, first sequence, count in the sequence, offset there."""
    out, nth, sequence = [], {}, 0
    for items, times in configurations:
        offset = 0
        for length, count in items:
            out.append((length, nth.get(length, 0), sequence, count, offset))
            nth[length] = nth.get(length, 0) + count * times
            offset += length * count
        sequence += times
    out.sort()
    return tuple(np.array(c, np.int64) for c in zip(*out, strict=True)) or (np.zeros(0, np.int64),) * 5


def place(where: tuple[np.ndarray, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, count, offset = where
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            lo = np.searchsorted(length, n, side="left")
            hi = np.searchsorted(length, n, side="right")
            k = np.empty(len(n), np.int64)
            for x in np.unique(n):
                own = n == x
                a, b = lo[own][0], hi[own][0]
                k[own] = a + np.searchsorted(first[a:b], rank[own], side="right") - 1
            nth = rank - first[k]
            columns = [c for c in batch.schema.names if c != "rank"]
            more = [pa.array(sequence[k] + nth // count[k], pa.int64()), pa.array(offset[k] + nth % count[k] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + more, names=[*columns, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, rounds: int = 400, with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence and place: row, doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    A document's ids end with id 0; only documents longer than ``capacity`` are cut.  ``ids`` holds the little-endian 32-bit ids if
    ``with_ids``, else null.  A null or empty text is one piece of one id; null and repeated ids are packed like others (``row``
    tells them apart); an empty table gives an empty result; other columns are ignored.  Pieces of one length are interchangeable:
    their ranks come from counts per task, so that a length held by a third of the corpus never meets in one task.
    """
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = table(given.mapInArrow(cut_pieces(tokenizer, capacity, with_ids), PIECE_SQL), "pieces")
    counts = table(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ranked = pieces.join(base, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
    ranked = ranked.withColumn("rank", F.col("first") + F.col("at")).drop("part", "at", "p", "l", "first")
    kinds = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    laid: dict[str, int] = {}
    where = places(plan(histogram, capacity, rounds, laid))
    logging.getLogger(__name__).info("sequences laid by the program: %(program)d, by the filler alone: %(filler)d", laid)
    return ranked.mapInArrow(place(where), f"{kinds}, sequence_id long, offset long")


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), word_bpe()).select(*COLUMNS)
