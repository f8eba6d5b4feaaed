"""Sharding by a permutation-filled lookup table, in DataFrame functions only.

Each shard has its own order of preference over the slots of a table of prime size: an offset and a step from its name.  Shards
take turns, each claiming its next free slot, until the table is full, so that all get nearly the same number of slots and a
changed shard moves few of the others' rows.  The table is a constant of bounded size; a row finds its shard by one lookup.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, table

SLOTS, SHARDS = 2039, 16


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number in each slot."""
    if not shards or slots <= len(shards) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("a prime number of slots is needed, more than there are shards")
    start, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode()).hexdigest()
        start.append(int(digest[:15], 16) % slots)
        step.append(int(digest[15:30], 16) % (slots - 1) + 1)
    out, turn, left = [-1] * slots, [0] * len(shards), slots
    while True:
        for k in range(len(shards)):
            while out[at := (start[k] + turn[k] * step[k]) % slots] >= 0:
                turn[k] += 1
            out[at] = k
            turn[k] += 1
            left -= 1
            if not left:
                return out


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5 modulo the number of slots; a null key is the text ``null``."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(docs: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` in place of any columns of these names."""
    names = shards or [f"shard-{k}" for k in range(SHARDS)]
    lookup = F.from_json(F.lit(json.dumps(fill(names, slots))), "array<int>")
    return docs.withColumn("slot", slot_of(F.col(key), slots)).withColumn("shard", F.element_at(lookup, F.col("slot") + 1))


def write(docs: DataFrame, path: str, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> None:
    """One folder per shard.  Rows are dealt by shard and slot, so that a shard may be written by many tasks."""
    place(docs, key, shards, slots).repartition("shard", "slot").write.partitionBy("shard").parquet(path)


def sharding(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, slot, shard, n_bytes, shard_docs, shard_bytes.

    The shard depends on the id alone: equal ids share one, null ids too.  A null text has 0 bytes; an empty table gives an empty
    result; other columns are ignored.  Loads are summed per shard by partial aggregation and joined back (one row per shard).
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    rows = table(place(given, "doc_id", shards, slots), "placed")
    load = rows.groupBy("shard").agg(F.count("*").alias("shard_docs"), F.sum("n_bytes").alias("shard_bytes"))
    return rows.join(F.broadcast(load), "shard").select("doc_id", "slot", "shard", "n_bytes", "shard_docs", "shard_bytes")


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    return sharding(documents(spark, sf_dir))


#: The table is filled by taking turns in SQL as well: each step appends the next shard's first free slot.
OP7_SQL = f"""
with recursive s as (
  select k, ('0x' || substr(md5('shard-' || k), 1, 15))::bigint % {SLOTS} as start, ('0x' || substr(md5('shard-' || k), 16, 15))::bigint % {SLOTS - 1} + 1 as step
  from range({SHARDS}) r(k)
), pref as (
  select list(list_transform(range({SLOTS}), lambda j: (start + j * step) % {SLOTS}) order by k) as p from s
), f as (
  select 0 as n, [-1]::bigint[] as taken from pref
  union all
  select n + 1, list_append(taken, list_filter(p[(n % {SHARDS}) + 1], lambda x: not list_contains(taken, x))[1]) from f, pref where n < {SLOTS}
), t as (
  select unnest(taken[2:]) as slot, unnest(range({SLOTS})) % {SHARDS} as shard from f where n = {SLOTS}
), d as (
  select doc_id, ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint % {SLOTS} as slot, coalesce(strlen(text), 0)::bigint as n_bytes from documents
)
select doc_id, slot::int as slot, shard::int as shard, n_bytes, count(*) over w as shard_docs, (sum(n_bytes) over w)::bigint as shard_bytes
from d join t using (slot) window w as (partition by shard)
"""
