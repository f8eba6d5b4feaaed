"""Suffix-array dedup of byte strings.

Building suffix arrays over parts of the corpus that occur once is wasted work, so a first pass finds the places worth it: in every 100-byte
string the smallest hash of its 24-byte pieces is an anchor, and equal strings have equal anchors at equal offsets.  The text around
anchors that occur more than once is dealt into shards by anchor.  In each shard a suffix array is built by Larsson-Sadakane
refinement and its common prefixes by Kasai's rule; strings of 100 bytes that share a class of suffixes are compared in full, so
the result is exact.  Where an anchor's texts go beyond a shard, the next shard's strings are looked up among the earlier ones
by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import SEEDS, blocks, by_doc, piece_hash, pieces, runs, signed, tags
from .common import documents, table
from .cover_dedup import hits, with_found

LENGTH, PIECE = 100, 24
SPREAD = LENGTH - PIECE + 1
#: Bytes in a shard's suffix array.
SHARD = (2 << 20) - 1
#: Texts of one anchor that a task compares; where there may be more, each string is dealt by its own hash.
HOT = 8192
_PLACE = np.uint64((1 << 28) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Stretches of start positions of 100-byte strings with one anchor: text number, first start, how many, the anchor's hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    offset = np.concatenate([[0], np.cumsum(size)])
    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    whole = piece_hash(data, PIECE, SEEDS[0])
    # The place breaks ties towards the left; a block has fewer than 2^28 bytes.
    least = sliding_min(whole & ~_PLACE | np.arange(len(whole), dtype=np.uint64) & _PLACE, SPREAD)
    owner = np.repeat(np.arange(len(texts)), np.maximum(0, size - LENGTH + 1))
    start = np.arange(len(owner)) - np.concatenate([[0], np.cumsum(np.maximum(0, size - LENGTH + 1))])[owner] + offset[owner]
    chosen = (least[start] & _PLACE).astype(np.int64)
    first = runs(chosen) if len(chosen) else np.zeros(0, np.int64)
    if len(first):
        new = np.zeros(len(chosen), bool)
        new[first] = True
        new[1:] |= owner[1:] != owner[:-1]
        first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(chosen)))
    return owner[first], start[first] - offset[owner[first]], count, whole[chosen[first]]


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, tag, base in pieces(batches, LENGTH - 1):
        owner, start, _, key = segments(texts)
        out = hits(key, owner, np.array(ids, np.int64), tag[owner] << 32 | (start + base[owner]) << 1, False, True)
        # how often the block has the anchor, beside the row that stands for comparison
        k, at = out.column("k").to_numpy(), out.column("at").to_numpy()
        n, lone = np.zeros(len(k), np.int32), at & 1 == 0
        own, count = np.unique(signed(key), return_counts=True)
        n[lone] = count[np.searchsorted(own, k[lone])]
        yield out.append_column("n", pa.array(n))


CONTEXT = pa.schema([("k", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("text", pa.binary())])
CONTEXT_SQL = "k long, doc long, at long, n int, text binary"


def single_strings(texts: list[bytes], docs: np.ndarray, tag: np.ndarray, base: np.ndarray, owner: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The strings of stretches, each under its own hash (n -1).  Equal strings of the block are sent once, for the earliest place;
    the others are removed whatever else there is (text null)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    who = np.repeat(owner, count)
    begin = np.repeat(start, count) + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    pos = offset[who] + begin
    key = signed(piece_hash(data, LENGTH, SEEDS[1]))[pos]
    order = np.lexsort((begin, tag[who], docs[who], key))
    first = runs(key[order])
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(order[first], np.diff(np.append(first, len(order))))
    view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    copy = np.flatnonzero((docs[who] != docs[who[least]]) | (tag[who] != tag[who[least]]) | (begin != begin[least]))
    gone = np.zeros(len(pos), bool)
    for c in np.array_split(copy, len(copy) // 50_000 + 1):
        gone[c] = (view[pos[c]] == view[pos[least[c]]]).all(axis=1)
    at = tag[who] << 32 | (begin + base[who]) << 1
    sent = np.flatnonzero(~gone)
    for c in np.array_split(sent, len(sent) // 50_000 + 1):
        text = pa.Array.from_buffers(pa.binary(LENGTH), len(c), [None, pa.py_buffer(np.ascontiguousarray(view[pos[c]]))]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(key[c]), pa.array(docs[who[c]]), pa.array(at[c]), pa.array(np.full(len(c), -1, np.int32)), text], schema=CONTEXT)
    if len(own := np.flatnonzero(gone)):
        own = own[np.argsort(pos[own], kind="stable")]
        head = np.flatnonzero(np.concatenate([[True], (pos[own][1:] != pos[own][:-1] + 1) | (who[own][1:] != who[own][:-1])]))
        n, own = np.diff(np.append(head, len(own))), own[head]
        columns = [pa.array(by_doc(docs[who[own]])), pa.array(docs[who[own]]), pa.array(at[own]), pa.array(n, pa.int32()), pa.nulls(len(own), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=CONTEXT)


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text under the strings of each repeated anchor; the strings of anchors whose place has its lowest bit set one by one.  Equal
    texts of a block are sent once, for the earliest place; the strings of the others are removed whatever else there is (text null)."""
    for ids, texts, tag, base, found in pieces(batches, LENGTH - 1, "found"):
        docs = np.array(ids, np.int64)
        owner, start, count, key = segments(texts)
        begin = np.searchsorted(owner, np.arange(len(ids) + 1))
        good, hot = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
        for n, own in enumerate(found):
            at = np.asarray(own or [], np.int64)
            at = at[at >> 32 == tag[n]]
            place, stretch = ((at & 0xFFFFFFFF) >> 1) - base[n], slice(begin[n], begin[n + 1])
            good[stretch] = np.isin(start[stretch], place)
            hot[stretch] = np.isin(start[stretch], place[at & 1 == 1])
        if hot.any():
            yield from single_strings(texts, docs, tag, base, owner[hot], start[hot], count[hot])
        own = np.flatnonzero(good & ~hot)
        own = own[np.lexsort((start[own], tag[owner[own]], docs[owner[own]]))]
        seen: dict[tuple, tuple[int, int]] = {}
        out = []
        for o, s, c, k in zip(owner[own].tolist(), start[own].tolist(), count[own].tolist(), signed(key)[own].tolist(), strict=True):
            text = texts[o][s : s + c + LENGTH - 1]
            doc, at = ids[o], int(tag[o]) << 32 | (s + int(base[o])) << 1
            first = seen.setdefault((k, text), (doc, at))
            if first == (doc, at):
                out.append((k, doc, at, c, text))
            else:
                out.append((None, doc, at, c, None))
        if out:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), CONTEXT, strict=True)]
            route = pa.array(by_doc(columns[1].to_numpy()))
            columns[0] = columns[0].fill_null(0) if not columns[0].null_count else pc.coalesce(columns[0], route)
            yield pa.RecordBatch.from_arrays(columns, schema=CONTEXT)


def suffix_array(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, which stop at ``end[position]``, by Larsson-Sadakane refinement.

    Suffixes are first sorted by a few bytes.  Each round sorts only the groups that are still tied, by the rank of the suffix as
    many bytes further on as is known to be equal, which doubles the depth; a suffix that ends there comes first.  Suffixes
    equal to their ends are in the order of their positions, as Kasai's rule needs.  Group, rank and position share one number,
    which sorts much faster than an index does.
    """
    n = len(data)
    bits = max(1, int(n).bit_length())
    mask = (1 << bits) - 1
    if 2 * bits + bits > 63:
        raise ValueError("a shard must be smaller than 2^21 bytes")
    left = (end - np.arange(n)).astype(np.int32)
    h = 5 if bits <= 21 else 4
    padded = np.concatenate([data, np.zeros(h, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(h):
        key = key << np.uint64(8) | padded[j : j + n]
    short = np.flatnonzero(left < h)
    cut = (8 * (h - left[short])).astype(np.uint64)
    key[short] = key[short] >> cut << cut
    key = (key << np.uint64(3) | np.minimum(left, h).astype(np.uint64)) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    order = (key & np.uint64(mask)).astype(np.int32)
    key >>= np.uint64(bits)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    rank = np.empty(n + 1, np.int32)
    rank[order] = group
    rank[n] = -1
    depth = int(left.max(initial=0))
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        who, own = order[where], group[where].astype(np.int64) << 2 * bits
        if h < depth:
            second = rank[np.where(left[who] > h, who + h, n)] + 1
            own |= second.astype(np.int64) << bits
        own |= who
        own.sort()
        order[where] = who = (own & mask).astype(np.int32)
        if h >= depth:
            break
        own >>= bits
        start = np.concatenate([[True], own[1:] != own[:-1]])
        new[where] = start
        group[where] = first = np.maximum.accumulate(np.where(start, where, 0)).astype(np.int32)
        rank[who] = first
        h *= 2
    return order


def common_prefixes(data: np.ndarray, end: np.ndarray, lanes: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place in ``order`` the common prefix with the suffix before, up to ``depth``, by Kasai's rule.

    The rule walks a text from left to right and loses at most one byte a step.  All texts, which begin at ``lanes``, are walked side
    by side, so that each step is an array operation.
    """
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    pos, stop, known = lanes.copy(), end[lanes], np.zeros(len(lanes), np.int64)
    while len(pos):
        other = before[pos]
        a, b = pos + known, other + known
        same = (other >= 0) & (known < depth) & (a < stop)
        same &= b < end[other]
        same[same] = data[a[same]] == data[b[same]]
        known = known + same
        done = ~same
        out[pos[done]] = known[done]
        pos = pos + done
        known = np.where(done, np.maximum(0, known - 1), known)
        live = pos < stop
        if not live.all():
            pos, stop, known = pos[live], stop[live], known[live]
    return out[order]


class Shards:
    """Suffix arrays over rows sorted by (k, doc, at), a shard at a time; strings of an anchor cut by a shard's end are carried on."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, bytes]] = []
        self.size = 0
        self.texts: dict[bytes, tuple] = {}
        self.now: int | None = None
        self.lone: tuple | None = None
        self.key: int | None = None
        self.known = np.zeros(0, f"S{LENGTH}")

    def add(self, row) -> list[tuple[int, int, int]]:
        """Copies of an anchor's text stand in the array once; the later ones' strings all occur in the first.

        The starts of a stretch have their anchor at different offsets, so that no string is twice in it: a text without another one
        under its anchor has nothing to be compared with and stands in no array.
        """
        if row[0] != self.now:
            self.now, self.texts, self.lone = row[0], {}, None
        first = self.texts.setdefault(row[4], row)
        if first is not row:
            return [] if first[1:3] == row[1:3] else [(*row[1:3], abs(row[3]))]
        if row[3] < 0:  # a single string under its own hash
            return []
        if len(self.texts) == 1:
            self.lone = row
            return []
        out = self.put(self.lone) if self.lone else []
        self.lone = None
        return out + self.put(row)

    def put(self, row) -> list[tuple[int, int, int]]:
        out = self.flush() if self.rows and self.size + len(row[4]) > SHARD else []
        self.rows.append(row)
        self.size += len(row[4])
        return out

    def flush(self) -> list[tuple[int, int, int]]:
        """(doc, at, how many) for each run of starts of removed strings."""
        rows, self.rows, self.size = self.rows, [], 0
        if not rows:
            return []
        size = np.array([len(r[4]) for r in rows])
        lanes = np.concatenate([[0], np.cumsum(size)[:-1]])
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        owner = np.repeat(np.arange(len(rows)), size)
        end = (lanes + size)[owner]
        order = suffix_array(data, end)
        height = common_prefixes(data, end, lanes, order, LENGTH)
        # places by (doc, at) and start: rows with equal places are one document's
        place = np.array([(r[1], r[2]) for r in rows], np.int64)
        by = np.lexsort((place[:, 1], place[:, 0]))
        fresh = np.concatenate([[True], (place[by][1:] != place[by][:-1]).any(axis=1)])
        turn = np.empty(len(rows), np.int64)
        turn[by] = np.cumsum(fresh)
        key = turn[owner] << 8 | (np.arange(len(data)) - lanes[owner])
        first = np.flatnonzero(height < LENGTH)
        if not len(first) or first[0]:
            first = np.concatenate([[0], first])
        low = np.minimum.reduceat(key[order], first)
        gone = np.zeros(len(data), bool)
        gone[order] = key[order] > np.repeat(low, np.diff(np.append(first, len(order))))
        whole = end - np.arange(len(data)) >= LENGTH
        gone &= whole
        # strings of the anchor carried from the shard before, and those to carry on
        for k in {rows[0][0], rows[-1][0]}:
            own = np.flatnonzero([r[0] == k for r in rows])
            if k == self.key or k == rows[-1][0]:
                at = np.flatnonzero(whole & ~gone & np.isin(owner, own))
                view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
                strings = np.ascontiguousarray(view[at]).view(f"S{LENGTH}").ravel() if len(at) else np.zeros(0, f"S{LENGTH}")
                if k == self.key and len(self.known):
                    found = np.minimum(np.searchsorted(self.known, strings), len(self.known) - 1)
                    old = self.known[found] == strings
                    gone[at[old]] = True
                    strings = strings[~old]
                if k == rows[-1][0]:
                    self.known = np.sort(np.concatenate([self.known, strings]) if k == self.key else strings)
        self.key = rows[-1][0]
        out = []
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            while a < b:
                r = int(owner[a])
                upto = min(b, int(lanes[r] + size[r]))
                out.append((rows[r][1], rows[r][2] + 2 * (a - int(lanes[r])), upto - a))
                a = upto
        return out


REMOVED = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shards = Shards()

    def done(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))], schema=REMOVED)

    for batch in batches:
        copies = pc.is_null(batch.column("text"))
        own = batch.filter(copies)
        yield pa.RecordBatch.from_arrays([own.column(c).cast(pa.int64()) for c in REMOVED.names], schema=REMOVED)
        out = []
        for row in zip(*(c.to_pylist() for c in batch.filter(pc.invert(copies)).columns), strict=True):
            out += shards.add(row)
        yield done(out)
    yield done(shards.flush())


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
RESULT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in blocks(batches, "found"):
            out = []
            for doc, text, own, tag in zip(ids, texts, found, tags(texts).tolist(), strict=True):
                at = np.array([(x["at"], x["n"]) for x in own or []], np.int64).reshape(-1, 2)
                at = at[at[:, 0] >> 32 == tag]
                spans, kept = 0, text
                if len(at):
                    start = (at[:, 0] & 0xFFFFFFFF) >> 1
                    order = np.argsort(start)
                    start, end = start[order], np.maximum.accumulate((start + at[:, 1] + LENGTH - 1)[order])
                    head = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                    end = end[np.append(head[1:], len(end)) - 1]
                    spans = len(head)
                    kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start[head].tolist(), len(text)], strict=True))
                out.append((doc, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=RESULT)

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes if ``with_text``, else null).

    A byte is removed when a 100-byte string over it also starts earlier: in a document with a smaller id or earlier in its own.
    Strings are judged on the input.  A null text is empty; a null id is larger than any other; of rows with equal ids and
    different texts either may count as the earlier one, by a fixed rule; rows equal in id and text do not count against each other; an
    empty table gives an empty result; other columns are ignored.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = given.mapInArrow(anchors, "k long, doc long, at long, own long, n int")
    # A block sends each of its anchors once, so that the rows of a hot anchor are as many as the blocks.
    all_rows, sure = Window.partitionBy("k"), F.col("at").bitwiseAND(F.lit(1)) == 1
    counted = rows.withColumn("often", F.count("*").over(all_rows) > 1).withColumn("hot", ~sure & (F.sum("n").over(all_rows) > HOT))
    flagged = counted.where(sure | F.col("often") | F.col("hot")).select("doc", "at", F.coalesce("own", "k").alias("key"), "hot")
    flagged = table(flagged, "anchors")
    # Fewer than one in HOT of all anchors; each place learns by a join whether its own is one.
    hot = table(flagged.where("hot").select(F.col("key").alias("hot_key")).distinct(), "hot")
    at = F.col("at").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("hot_key").isNotNull().cast("long"))
    places = flagged.join(hot, F.col("key") == F.col("hot_key"), "left").select("doc", at.alias("at"))
    spots = with_found(given, places, "inner").mapInArrow(contexts, CONTEXT_SQL)
    sharded = spots.repartition("k").sortWithinPartitions("k", "doc", "at")
    removed = table(sharded.mapInArrow(compare, "doc long, at long, n long"), "removed")
    own = removed.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("found"))
    joined = given.join(own, F.coalesce("doc_id", F.lit((1 << 63) - 1)) == F.col("doc"), "left").select("doc_id", "text", "found")
    out = joined.mapInArrow(remove(with_text), RESULT_SQL)
    return out.withColumn("doc_id", F.when(F.col("doc_id") < (1 << 63) - 1, F.col("doc_id")))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
