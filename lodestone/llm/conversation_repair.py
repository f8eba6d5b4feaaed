"""Repair of conversation structure by a square-root checkpointed dynamic program.

Role initials have to read ``(s?(ua)+)?``, a machine of four states.  Going backward, a row turns the costs to finish from each
state into those before it.  A conversation is dealt by ranges of rows, so it may lie in several segments: each gives the costs
between its two ends as a small matrix, from which the costs at all borders follow.  Inside a segment of n rows only every
sqrt(n)-th vector of costs is stored; walking forward, the vectors of one block at a time are computed again and the ASCII-least
edit is taken among those that keep the total.  Texts are not needed for that; they meet the edits in one sorted pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row of class s, u, a or other leads if kept, and where the row leads that is inserted or given a role.
NEXT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
FITTING = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
#: Costs to finish when no row is left.
LAST = (0, 2 * INSERT, INSERT, 0)
#: Faults of a symbol (class * 3 + fault).
SOUND, BAD, CUT = range(3)


@lru_cache(1 << 16)
def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    kind, fault = divmod(symbol, 3)
    costs = []
    for state in range(4):
        cost = DELETE + after[state]
        if fault != BAD:
            extra = TRUNCATED if fault == CUT else 0
            if NEXT[state][kind] is not None:
                cost = min(cost, KEEP + extra + after[NEXT[state][kind]])
            cost = min(cost, REROLE + extra + after[FITTING[state]])
        costs.append(cost)
    user, assistant = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


def before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to finish from each state before a row, inserts before it included, from those after it."""
    low = min(after)  # a shift changes nothing: few different vectors remain
    return tuple(min(c + low, FAR) for c in _before(symbol, tuple(min(c - low, FAR) for c in after)))


def matrix(symbols: list[int]) -> list[int]:
    """Costs from each state before the rows to each state after them, row by row."""
    columns = []
    for end in range(4):
        costs = tuple(0 if s == end else FAR for s in range(4))
        for symbol in reversed(symbols):
            costs = before(symbol, costs)
        columns.append(costs)
    return [columns[end][start] for start in range(4) for end in range(4)]


def walk(symbols: list[int], state: int, end: tuple[int, ...], last: bool) -> list[str]:
    """The ASCII-least of the cheapest edits, one string per row; inserts stand in the string of the next row, at last of the row before."""
    n = len(symbols)
    step = math.isqrt(n) + 1
    stored = {n: end}
    costs = end
    for i in range(n - 1, -1, -1):
        costs = before(symbols[i], costs)
        if i % step == 0:
            stored[i] = costs
    edits = []
    for first in range(0, n, step):
        stop = min(first + step, n)
        block = [stored[stop]]
        for i in range(stop - 1, first - 1, -1):
            block.append(before(symbols[i], block[-1]))
        block.reverse()
        for i in range(first, stop):
            here, after = block[i - first], block[i - first + 1]
            kind, fault = divmod(symbols[i], 3)
            extra = TRUNCATED if fault == CUT else 0
            done = ""
            while not done or done[-1] == "I":
                left, fitting, kept = here[state], FITTING[state], NEXT[state][kind]
                if DELETE + after[state] == left:
                    done += "D"
                elif INSERT + here[fitting] == left:
                    done += "I"
                    state = fitting
                elif fault != BAD and kept is not None and KEEP + extra + after[kept] == left:
                    done += "K"
                    state = kept
                else:
                    done += "R"
                    state = fitting
            edits.append(done)
    while last and n and state in (SYSTEM, USER):
        edits[-1] += "I"
        state = FITTING[state]
    return edits


MATRICES = pa.schema([("part", pa.int32()), ("matrix", pa.list_(pa.int64()))])


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([matrix(s) for s in batch.column("symbols").to_pylist()], pa.list_(pa.int64()))
        yield batch.drop_columns(["symbols"]).append_column("matrix", found)


def borders(group: pa.Table) -> pa.Table:
    """The costs to finish at the end of each segment of one conversation."""
    group = group.sort_by("part")
    costs, ends = LAST, []
    for m in reversed(group["matrix"].to_pylist()):
        ends.append(costs)
        costs = tuple(min(min(m[4 * s + t] + costs[t] for t in range(4)), FAR) for s in range(4))
    ends = pa.array([list(e) for e in reversed(ends)], pa.list_(pa.int64()))
    last = pa.array([i == group.num_rows - 1 for i in range(group.num_rows)])
    return pa.table([group["conv"], group["part"], ends, last], names=["conv", "part", "end", "last"])


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the edits of a segment for each state it may begin in; a conversation's first segment begins in the first state only."""
    for batch in batches:
        out = []
        for symbols, end, last in zip(*(batch.column(c).to_pylist() for c in ("symbols", "end", "last")), strict=True):
            whole = end is None
            states = range(1 if whole else 4)
            out.append([" ".join(walk(symbols, s, LAST if whole else tuple(end), whole or last)) for s in states])
        yield batch.drop_columns(["symbols", "end", "last"]).append_column("edits", pa.array(out, pa.list_(pa.string())))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``rows(conv_id, turn, role, text)`` with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20; nulls count as one space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    out = rows.withColumn("h", F.crc32(name.cast("binary")) % 20).where("h <> 0")
    out = out.withColumn("text", F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate(F.coalesce("text", F.lit(" ")), ".!?", "")).otherwise(F.coalesce("text", F.lit(" "))))
    out = out.withColumn("role", F.when(F.col("h") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))))
    return out.withColumn("copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("h", "copy")


ORDER = ("conv", "turn", "role", "digest", "row", "kind")


def replayed(rows: DataFrame) -> DataFrame:
    """The rows (kind 1) and the edits of each segment before its first row (kind 0), to be sorted by ORDER within a conversation.

    ``rows``: conv, turn, role, text.  Only numbers, roles and digests are dealt by range, and the edits of a segment are one row.
    """
    trimmed = F.rtrim("text", F.lit(SPACES))
    fault = F.when(trimmed == "", BAD).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    base = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    base = base.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), fault.alias("fault"), F.monotonically_increasing_id().alias("row"))
    base = table(base, "rows")
    light = base.drop("text")
    first = light.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn", "row")).alias("f")).select("f.row", F.lit(True).alias("first"))
    light = light.join(first, "row", "left").withColumn("again", F.col("first").isNull() & (F.col("fault") != BAD))
    kind = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, i) for i, c in enumerate("sua")], F.lit(3))
    light = light.withColumn("symbol", (kind * 3 + F.when(F.col("again"), BAD).otherwise(F.col("fault"))).cast("int"))
    by = ["conv", "turn", "role", "digest", "row"]
    dealt = light.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = table(dealt.select(*by, "symbol", "fault", "again", "part", "at"), "dealt")
    place = F.min(F.struct("at", "turn", "role", "digest", "row")).alias("place")
    counts = [F.count_if((F.col("fault") == BAD)).alias("blank"), F.count_if("again").alias("duplicate"), F.count_if((F.col("fault") == CUT) & ~F.col("again")).alias("truncated")]
    segments = dealt.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("at", "symbol"))).alias("all"), place, *counts)
    segments = table(segments.select("conv", "part", F.transform("all", lambda x: x["symbol"]).alias("symbols"), "place", "blank", "duplicate", "truncated"), "segments")
    # a border between ranges cuts one conversation at most, so these are no more than the ranges
    parts = F.broadcast(segments.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("c")))
    conv_type = rows.schema["conv"].dataType.simpleString()
    several = segments.join(parts, F.col("conv").eqNullSafe(F.col("c"))).select("conv", "part", "symbols")
    ends = several.mapInArrow(matrices, f"conv {conv_type}, part int, matrix array<long>").groupBy("conv").applyInArrow(borders, f"conv {conv_type}, part int, end array<long>, last boolean")
    ends = table(ends, "borders").select(F.col("conv").alias("c"), F.col("part").alias("p"), "end", "last")
    joined = segments.join(F.broadcast(ends), F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left").drop("c", "p")
    light_type = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in segments.drop("symbols").schema)
    done = joined.mapInArrow(solve, f"{light_type}, edits array<string>")
    marks = done.select("conv", "place.turn", "place.role", "place.digest", "place.row", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("int").alias("fault"), "edits", "blank", "duplicate", "truncated")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("edits", "array<string>"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"))]
    texts = base.select("conv", "turn", "role", "digest", "row", F.lit(1).alias("kind"), "text", "fault", *none)
    return marks.unionByName(texts).repartition("conv").sortWithinPartitions(*ORDER).drop("digest", "row")


class Replay:
    """One conversation's rows in order: its state, counts and repaired rows."""

    def __init__(self, conv: object):
        self.conv, self.state, self.waiting, self.audit, self.cost = conv, START, iter(()), [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.low = self.high = None

    def mark(self, edits: list[str], blank: int, duplicate: int, truncated: int) -> None:
        self.waiting = iter(edits[self.state if len(edits) > 1 else START].split(" "))
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated

    def row(self, turn: int | None, role: str, text: str, fault: int) -> Iterator[tuple[str, str]]:
        """The repaired rows in place of this one."""
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        done = next(self.waiting)
        self.audit.append(done)
        for edit in done:
            if edit == "D":
                self.cost += DELETE
                continue
            self.state = NEXT[self.state]["sua".index(initial)] if edit == "K" else FITTING[self.state]
            self.cost += INSERT if edit == "I" else (edit == "R") * REROLE + (fault == CUT) * TRUNCATED
            yield (role if edit == "K" else NAMES[self.state]), "" if edit == "I" else text

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Replay, tuple[str, str] | None]]:
    """Every repaired row with its conversation, and each conversation once more (None) at its end."""
    now: Replay | None = None
    names = ("conv", "kind", "turn", "role", "text", "fault", "edits", "blank", "duplicate", "truncated")
    for batch in batches:
        for conv, kind, turn, role, text, fault, edits, *counts in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    yield now, None
                now = Replay(conv)
            if kind == 0:
                now.mark(edits, *counts)
            else:
                for out in now.row(turn, role, text, fault):
                    yield now, out
    if now is not None:
        yield now, None


REPORT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)


def reports(conv_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            digest, begun = hashlib.sha256(), False
            for now, row in conversations(batches):
                if row is None:
                    yield now.conv, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, now.cost, "".join(now.audit), digest.hexdigest()
                    digest, begun = hashlib.sha256(), False
                else:
                    digest.update((("\n" if begun else "") + ":".join(row)).encode("utf-8", "surrogatepass"))
                    begun = True

        yield from _batches(rows(), pa.schema([("conv", conv_type), *REPORT]))

    return run


def repaired(conv_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at = 0
            for now, row in conversations(batches):
                if row is None:
                    at = 0
                else:
                    yield now.conv, at, *row
                    at += 1

        yield from _batches(rows(), pa.schema([("conv", conv_type), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())]))

    return run


def _given(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows: conv_id, position (from 0), role, text.

    Rows are taken by turn, nulls first, rows of one turn by role and SHA-256 of the text.  Null roles and texts count as one
    space, a null conv_id is a conversation of its own.  Blank and repeated rows go, of the others as many as the cheapest edits
    need; roles and inserted rows are ``user`` and ``assistant``.  An empty table gives an empty result; other columns are ignored.
    """
    out = replayed(_given(rows, conv, turn, role, text)).mapInArrow(repaired(pa.int64()), "conv long, position long, role string, text string")
    return out.withColumnRenamed("conv", "conv_id")


def audit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows as in ``repair``.  The digest of a conversation's text and its audit string come from one sorted pass, which holds one row
    at a time; all else about a long conversation is done by segments.
    """
    kind = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return replayed(_given(rows, conv, turn, role, text)).mapInArrow(reports(pa.int64()), kind).withColumnRenamed("conv", "conv_id")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    found = audit(damage(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _option(state: int, cost: str, edit: str, row: str | None) -> str:
    held = f"s{state}.t" if row is None else f"list_prepend({row}, s{state}.t)"
    return f"{{'c': (s{state}.c + {cost})::bigint, 'a': '{edit}' || s{state}.a, 't': {held}}}"


def _cheapest(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x is not null))[1]"


def _step(state: int) -> str:
    """SQL for the cheapest way on from a state at a row, inserts before the row aside."""
    extra = f"case when fault = {CUT} then {TRUNCATED} else 0 end"
    kept = " ".join(f"when kind = {k} then {_option(to, extra, 'K', 'whole')}" for k, to in enumerate(NEXT[state]) if to is not None)
    fitting = FITTING[state]
    named = _option(fitting, f"{REROLE} + {extra}", "R", f"'{NAMES[fitting]}:' || text")
    return _cheapest(_option(state, str(DELETE), "D", None), f"case when fault = {BAD} then null {kept} end", f"case when fault <> {BAD} then {named} end")


def _inserted(state: int) -> str:
    fitting = FITTING[state]
    return f"{{'c': n{fitting}.c + {INSERT}, 'a': 'I' || n{fitting}.a, 't': list_prepend('{NAMES[fitting]}:', n{fitting}.t)}}"


OP13_SQL = f"""
with recursive c as (
  select row_number() over () as row, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint) as name
  from conversations
), h as (
  select *, xor(list_reduce(name, lambda s, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(s, b)), 4294967295::bigint), 4294967295::bigint) % 20 as h from c
), d as (
  select conv_id, turn, row, case when h = 4 then 'user' else role end as role, case h when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when h = 3 then [0, 1] else [0] end) as copy
  from h where h <> 0
), o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), row, copy) as i,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as final, left(role, 1) as initial
  from d
), f as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again, lag(initial) over (partition by conv_id order by i) as previous from o
), r as (
  select *, role || ':' || text as whole, case initial when 's' then 0 when 'u' then 1 when 'a' then 2 else 3 end as kind,
         case when final = '' or again then {BAD} when final in ('.', '!', '?') then {SOUND} else {CUT} end as fault
  from f
), g as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (final = '') as blank, count(*) filter (final <> '' and again) as duplicate,
         count(*) filter (fault = {CUT}) as truncated, count(*) filter (previous is not null and previous || initial not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from r group by conv_id
), b as (
  select conv_id, n + 1 as i, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as s0, {{'c': {2 * INSERT}::bigint, 'a': 'II', 't': ['user:', 'assistant:']}} as s1,
         {{'c': {INSERT}::bigint, 'a': 'I', 't': ['assistant:']}} as s2, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as s3
  from g
  union all
  select conv_id, i, {_cheapest("n0", "{'c': m2.c + 5, 'a': 'I' || m2.a, 't': list_prepend('user:', m2.t)}")}, {_cheapest("n1", "{'c': m2.c + 5, 'a': 'I' || m2.a, 't': list_prepend('user:', m2.t)}")}, m2, m3
  from (select conv_id, i, n0, n1, {_cheapest("n2", _inserted(USER))} as m2, {_cheapest("n3", _inserted(ASSISTANT))} as m3
        from (select b.conv_id, r.i, {", ".join(f"{_step(s)} as n{s}" for s in range(4))} from b join r on r.conv_id is not distinct from b.conv_id and r.i = b.i - 1))
)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(b.s0.c, 0)::bigint as cost, coalesce(b.s0.a, '') as audit, sha256(coalesce(array_to_string(b.s0.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) e left join g on g.conv_id is not distinct from e.conv_id left join b on b.conv_id is not distinct from e.conv_id and b.i = 1
"""
