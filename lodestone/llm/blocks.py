"""What the two substring operators share: bounded blocks of texts, polynomial hashes and in-block pre-aggregation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is a block of its own, which ``pieces`` cuts.
BLOCK = 2 << 20
SEEDS = (7, 11)
LAST = (1 << 63) - 1


def blocks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Lists of doc_id (null: last), text as bytes and further columns, of about BLOCK bytes each."""
    ids, texts, more, size = [], [], [[] for _ in columns], 0
    for batch in batches:
        rest = [batch.column(c).to_pylist() for c in columns]
        for n, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if ids and size + len(raw) > BLOCK:
                yield ids, texts, *more
                ids, texts, more, size = [], [], [[] for _ in columns], 0
            ids.append(LAST if doc is None else doc)
            texts.append(raw)
            for m, r in zip(more, rest, strict=True):
                m.append(r[n])
            size += len(raw)
    if ids:
        yield ids, texts, *more


def pieces(batches: Iterator[pa.RecordBatch], overlap: int, *columns: str) -> Iterator[tuple]:
    """As ``blocks``, with the texts' tags and the place in its text at which each begins: a text of over BLOCK bytes comes as several
    blocks, cut at multiples of BLOCK, each with ``overlap`` bytes of the next."""
    for ids, texts, *more in blocks(batches, *columns):
        tag = tags(texts)
        if len(texts) > 1 or len(texts[0]) <= BLOCK:
            yield ids, texts, tag, np.zeros(len(texts), np.int64), *more
            continue
        for base in range(0, len(texts[0]), BLOCK):
            yield ids, [texts[0][base : base + BLOCK + overlap]], tag, np.array([base], np.int64), *more


def tags(texts: list[bytes]) -> np.ndarray:
    """31 bits that tell apart different texts under one id."""
    return np.array([zlib.crc32(t) & 0x7FFFFFFF for t in texts], np.int64)


@lru_cache(2)
def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = (int(np.random.default_rng(seed).integers(1 << 62)) << 3 | 3) & 0xFFFFFFFFFFFFFFFF
    table = np.random.default_rng(seed + 1).integers(0, 1 << 64, 256, dtype=np.uint64)
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return table, *out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each span of bytes: polynomial prefix sums modulo 2^64, shifted to the span's start."""
    size = 1 << max(21, int(len(data) - 1).bit_length())
    table, up, down = _powers(seed, size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def piece_hash(data: np.ndarray, width: int, seed: int) -> np.ndarray:
    """As ``span_hash`` for the piece of ``width`` bytes at every position."""
    table, up, down = _powers(seed, 1 << max(21, int(len(data) - 1).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[: len(data) - width + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def by_doc(ids: np.ndarray) -> np.ndarray:
    """A routing key for rows that go to their own document."""
    return signed(mix(ids.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)))


def runs(keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
