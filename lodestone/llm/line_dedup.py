"""Line dedup as an exact set-similarity join, in DataFrame functions only.

A line is the set of its words.  Words are ordered by rarity; two sets with a Jaccard similarity of ``t`` or more share words among
their first few, so only these prefixes are joined, under the length, positional and signature filters.  Where the first shared
word is a frequent one, a second shared word is as near: frequent words only meet in pairs, so that a word which stands in a large
part of the lines is no key of its own.  Surviving pairs of distinct sets are verified on their words.  Lines with the same set are
one set, whatever their number.

A line goes when some earlier one is similar; so a set found similar to one earlier set needs no other, and a group of many near
copies is mostly settled by comparing its sets with a few of its earliest.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, table

#: Bits of a word's hash that name its counter.  Rarity only orders the words: any fixed order gives the same result.
COUNTER_BITS = 14
#: Counters, the fullest ones, whose words count as frequent.
FREQUENT = 64
#: Sets of more words have signatures of 128 bits.
LARGE = 96
#: A band of more sets than this is crowded; all its sets are compared with this many of them first.
PIVOTS = 16
ODD_SPACE = "\t\v\f\r"
NO_ID = (1 << 63) - 1


def plain(text: Column) -> Column:
    """The text with all white space but \\n as spaces; texts without any other aren't rewritten."""
    odd = F.lit(False)
    for c in ODD_SPACE:
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, F.translate(text, ODD_SPACE, " " * len(ODD_SPACE))).otherwise(text)


def counter(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - COUNTER_BITS).cast("int")


def word_order(docs: DataFrame) -> list[int]:
    """For each counter its place by frequency, the rarest first, centred on zero so that signed numbers sort rightly.

    Only 2^COUNTER_BITS numbers come to the driver.
    """
    words = docs.select(F.explode(F.split(F.replace(plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w")).where("w <> ''")
    found, size = dict(words.groupBy(counter(F.xxhash64("w")).alias("c")).agg(F.count("*").alias("n")).collect()), 1 << COUNTER_BITS
    place = {c: k - (size >> 1) for k, c in enumerate(sorted(range(size), key=lambda c: (found.get(c, 0), c)))}
    return [place[c] for c in range(size)]


def word_set(line: Column) -> Column:
    """The hashes of the distinct words of a line."""
    return F.array_distinct(F.array_remove(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def by_rarity(words: Column, order: list[int]) -> Column:
    """The words as 64-bit numbers, rarest first: the top bits of a word's hash give way to its counter's place."""
    low, half = 64 - COUNTER_BITS, 1 << (COUNTER_BITS - 1)
    signed = lambda c: c - 2 * half if c >= half else c
    mask = F.from_json(F.lit(json.dumps([signed((p ^ c) & (2 * half - 1)) << low for c, p in enumerate(order)])), "array<long>")
    return F.sort_array(F.transform(words, lambda h: h.bitwiseXOR(F.coalesce(F.get(mask, counter(h)), F.lit(0).cast("long")))))


def signature(tokens: Column, upper: bool = False) -> Column:
    """64 bits, one of them flipped by each word; each differing bit of two signatures is a word that one set lacks.

    With ``upper`` only words of the upper half of a signature of 128 bits count; the lower half is the rest.
    """
    weight = lambda t: F.shiftright(t, 6).bitwiseAND(F.lit(1)) if upper else F.lit(1).cast("long")
    bit = lambda t: F.call_function("shiftleft", weight(t), t.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(bit(t)))


def keys_of(prefix: Column, size: Column) -> Column:
    """(key, i) of each word of a prefix of ``size`` words; of each pair with a later word where the word is frequent (negative).

    ``prefix`` is one word longer.  Frequent words come last, so that after a first shared word that is frequent the second is too.
    """
    alone = F.transform(F.slice(prefix, F.lit(1), size), lambda t, i: F.struct(t.alias("key"), i.alias("i")))
    pairs = F.flatten(
        F.transform(
            prefix,
            lambda t, i: F.when(t >= 0, F.array(F.struct(t.alias("key"), i.alias("i")))).otherwise(
                F.transform(F.slice(prefix, i + 2, F.size(prefix)), lambda u: F.struct(F.hash(t, u).alias("key"), i.alias("i")))
            ),
        )
    )
    return F.when(F.element_at(prefix, size) >= 0, alone).otherwise(F.filter(pairs, lambda k: k["i"] < size))


def judged_lines(docs: DataFrame, id_col: str, text_col: str, t_num: int, t_den: int) -> DataFrame:
    """(doc, mark, n_lines, gone) for each row of ``docs``: id or NO_ID, hash of the text, and the numbers of the removed lines."""
    if 3 * t_num < 2 * t_den or t_num >= t_den:
        raise ValueError("the similarity must be 2/3 or more and below 1")
    given = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    order = word_order(given)

    # one row per line with a word (the first of a text always): its set's hash, signature and size, its prefix by rarity in 31 bits a
    # word, and three words chosen by hash
    lines = given.withColumn("row", F.monotonically_increasing_id()).select("row", "doc", "mark", F.posexplode(F.split(plain(F.col("text")), "\n")).alias("line_no", "line"))
    lines = lines.where((F.col("line_no") == 0) | (F.trim("line") != "")).select("row", "doc", "mark", "line_no", word_set(F.col("line")).alias("words"))
    lines = lines.withColumn("tokens", by_rarity(F.col("words"), order))
    n, often = F.size("tokens"), ((1 << (COUNTER_BITS - 1)) - FREQUENT) << (64 - COUNTER_BITS)
    short = lambda t: t.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    prefix = F.transform(F.slice("tokens", 1, n - F.ceil(n * t_num / t_den).cast("int") + 2), lambda t: F.when(t < often, short(t)).otherwise(-1 - short(t)))
    lines = lines.select(
        "row", "doc", "mark", "line_no", n.alias("n"), F.xxhash64("tokens").alias("s"), signature(F.col("tokens")).alias("bits"),
        F.when(n > LARGE, signature(F.col("tokens"), True)).otherwise(0).alias("upper"), prefix.alias("prefix"), F.array_min("words").alias("least"), F.array_max("words").alias("most"),
    )
    lines = lines.withColumn("common", F.array_min("prefix"))
    bands = [("least", "most"), ("least", "common"), ("most", "common")]
    lines = table(lines.select("*", *[F.xxhash64(F.lit(k), *b).alias(f"band{k}") for k, b in enumerate(bands)]).drop("least", "most", "common"), "lines")

    # one row per distinct set, which hash, signature and size tell apart; the ids follow the sets' first places
    one, band = ["s", "bits", "n"], [f"band{k}" for k in range(len(bands))]
    sets = lines.where("n > 0").groupBy(*one).agg(F.min(F.struct("doc", "line_no", "mark", "prefix", "upper", *band)).alias("f"), F.count("*").alias("c"))
    sets = sets.select(*one, F.struct("f.doc", "f.line_no", "f.mark").alias("first"), "f.prefix", "f.upper", *[f"f.{b}" for b in band], "c")
    sets = table(sets.repartitionByRange("first").sortWithinPartitions("first").withColumn("id", F.monotonically_increasing_id()), "sets")
    # a set of fewer words than this has no other set similar enough
    some = sets.where(F.col("n") >= -(-t_num // (t_den - t_num)))

    def fits(position: Column | None = None) -> Column:
        """Can the sets x and y be similar, by their sizes, signatures and the words left after a shared one?"""
        need = F.ceil((F.col("xn") + F.col("yn")) * t_num / (t_num + t_den))
        whole, upper = F.col("xbits").bitwiseXOR(F.col("ybits")), F.col("xupper").bitwiseXOR(F.col("yupper"))
        differ = F.when(F.least("xn", "yn") > LARGE, F.bit_count(whole.bitwiseXOR(upper)) + F.bit_count(upper)).otherwise(F.bit_count(whole))
        length = F.least("xn", "yn") * t_den >= F.greatest("xn", "yn") * t_num
        # the signatures bound the words in only one of the sets
        return length & (differ <= F.col("xn") + F.col("yn") - 2 * need) & (F.lit(True) if position is None else position >= need)

    def as_side(df: DataFrame, v: str, *kept: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{v}{c}" for c in df.columns if c not in kept})

    def later(near: DataFrame, name: str) -> DataFrame:
        """The ids x of pairs (xid, yid) whose words are similar and whose places differ, y being the earlier.

        Words are read again from the first place of each set."""
        wanted = near.select(F.col("xid").alias("id")).union(near.select("yid")).distinct()
        spots = sets.join(wanted, "id", "left_semi").select("id", F.col("first.doc").alias("d"), F.col("first.mark").alias("m"), F.col("first.line_no").alias("l"))
        spots = spots.groupBy("d", "m").agg(F.collect_list(F.struct("id", "d", "l")).alias("spots"))  # at most one per line of a document
        texts = given.join(spots, (F.col("doc") == F.col("d")) & (F.col("mark") == F.col("m"))).select(F.split(plain(F.col("text")), "\n").alias("all"), F.explode("spots").alias("spot"))
        full = texts.select("spot.*", F.array_remove(F.array_distinct(F.split(F.element_at("all", F.col("spot.l") + 1), " ")), "").alias("w"))
        full = table(full, f"{name}_words")  # repeated rows of a document give a pair twice, which does no harm
        both = near.join(as_side(full, "x"), "xid").join(as_side(full, "y"), "yid").where((F.col("yd") < F.col("xd")) | (F.col("yl") < F.col("xl")))
        common = F.size(F.array_intersect("xw", "yw"))
        return table(both.where(common * t_den >= (F.size("xw") + F.size("yw") - common) * t_num).select(F.col("xid").alias("id")).distinct(), name)

    # Sets of many near copies meet first at a few pivots: of the sets with one crowded band, the earliest of each of PIVOTS classes of
    # ids.  A set similar to an earlier pivot is settled, so that the join below doesn't write out the pairs of such groups.
    banded = some.select("id", "n", "bits", "upper", F.explode(F.array(*band)).alias("band"))
    crowded = table(banded.groupBy("band").agg(F.count("*").alias("c")).where(F.col("c") > PIVOTS).select("band"), "crowded")
    banded = table(banded.join(crowded, "band"), "banded")
    pivots = banded.groupBy("band").agg(*[F.min(F.when(F.col("id") % PIVOTS == k, F.col("id"))).alias(f"p{k}") for k in range(PIVOTS)])
    pivots = pivots.select("band", F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)])).alias("id")).where("id is not null")
    pivots = as_side(pivots.join(some.select("id", "n", "bits", "upper"), "id"), "y", "band")
    tried = as_side(banded, "x", "band").join(pivots, "band").where((F.col("yid") < F.col("xid")) & fits()).select("xid", "yid").distinct()
    settled = later(table(tried, "tried"), "settled")

    # prefix join of the other sets with all earlier ones
    size = F.col("n") - F.ceil(F.col("n") * t_num / t_den).cast("int") + 1
    # one column says which set it is and whether it is settled, so that both sides of the join are one and the same shuffle
    code = F.when(F.col("done").isNull(), F.col("id")).otherwise(-1 - F.col("id"))
    magnitude = lambda n: F.length(F.bin(n))
    dealt = some.join(settled.withColumn("done", F.lit(True)), "id", "left").select(
        F.coalesce(code, F.lit(0)).alias("code"), "n", "bits", "upper", magnitude("n").alias("magnitude"),
        (magnitude(F.floor(F.col("n") * t_den / t_num)) > magnitude("n")).alias("guest"), F.explode(keys_of(F.col("prefix"), size)).alias("k"),
    )
    dealt = dealt.select("code", "n", "bits", "upper", "k.key", "k.i", "magnitude", "guest")
    # Sets meet only with those of their magnitude, the smaller of a pair as a guest in the next one; its first shared word stands
    # among fewer words than its own prefix has, as the other set has no fewer words.
    guest = F.col("guest") & (F.col("i") <= F.col("n") - F.ceil(F.col("n") * (2 * t_num) / (t_num + t_den)))
    at = F.explode(F.when(guest, F.array("magnitude", F.col("magnitude") + 1)).otherwise(F.array("magnitude"))).alias("at")
    dealt = dealt.select("key", "i", "code", "n", "bits", "upper", at).select(F.hash("key", "at").alias("key"), "i", "code", "n", "bits", "upper")
    position = 1 + F.least(F.col("xn") - F.col("xi") - 1, F.col("yn") - F.col("yi") - 1)
    earlier = F.when(F.col("ycode") < 0, -1 - F.col("ycode")).otherwise(F.col("ycode"))
    near = as_side(dealt, "x", "key").join(as_side(dealt, "y", "key"), "key").where((earlier < F.col("xcode")) & fits(position))
    near = near.select(F.col("xcode").alias("xid"), earlier.alias("yid")).distinct()
    found = later(table(near, "candidates"), "found")

    # lines of a set that isn't the first with its place, and all of a set with a similar earlier one
    late = sets.join(settled.union(found).withColumn("late", F.lit(True)), "id", "left").where("c > 1 or late").select(*one, F.struct("first.doc", "first.line_no").alias("first"), "late")
    gone = lines.join(late, one).where(F.col("late") | (F.col("first") < F.struct("doc", "line_no"))).select("doc", "mark", "line_no")
    gone = gone.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("line_no")).alias("gone")).withColumnsRenamed({"doc": "d", "mark": "m"})
    rows = lines.groupBy("row").agg(F.min("doc").alias("doc"), F.min("mark").alias("mark"), F.count_if(F.col("n") > 0).alias("n_lines"))
    return rows.join(gone, (F.col("doc") == F.col("d")) & (F.col("mark") == F.col("m")), "left").select("doc", "mark", "n_lines", "gone")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", t_num: int = 4, t_den: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed_lines (numbers from 0, comma-joined).

    Lines are split at \\n and count when they hold a word.  A line is removed when an earlier line (smaller id, or same id and smaller
    number) has a word set with a Jaccard similarity of t_num / t_den (0.8; 2/3 at least) or more; lines are judged on the input.  A
    null text has no lines; a null id is larger than any other; lines of equal number under one id don't count against each other;
    an empty table gives an empty result; other columns are ignored.
    """
    return judged_lines(docs, id_col, text_col, t_num, t_den).select(
        F.when(F.col("doc") < NO_ID, F.col("doc")).alias("doc_id"), "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed_lines"),
    )


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the similar later lines taken out of the text; other columns are unchanged.

    A null text stays null, rows of a null id count as later than all others, an empty table gives an empty result.  Rows of one id
    are told apart by their texts.
    """
    rows = table(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("at")), "whole")
    ids = rows.select("at", F.coalesce(F.col("whole").getField(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(F.coalesce(F.col("whole").getField(text_col).cast("string"), F.lit(""))).alias("m"))
    found = judged_lines(rows.select(f"whole.`{id_col}`", f"whole.`{text_col}`"), id_col, text_col, 4, 5).where("size(gone) > 0").select("doc", "mark", "gone").distinct()
    lost = ids.join(found, (F.col("d") == F.col("doc")) & (F.col("m") == F.col("mark"))).select("at", "gone")
    left = F.array_join(F.filter(F.split(F.col("whole").getField(text_col), "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("whole").getField(text_col)).otherwise(left)
    return rows.join(lost, "at", "left").select(F.col("whole").withField(text_col, text).alias("whole")).select("whole.*")


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


OP3_SQL = """
with l as (
  select doc_id, unnest(range(len(a))) as line_no, unnest(a) as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents)
), t as (
  select doc_id, line_no, list_sort(list_distinct(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) as s from l
), lines as (
  select * from t where len(s) > 0
), sets as (
  select s, len(s) as n, row_number() over () as id, min((doc_id, line_no)) as first from lines group by s
), tok as (
  select id, n, unnest(s) as w from sets
), freq as (
  select w, count(*) as c from tok group by w
), pre as (
  select id, n, w from (select *, row_number() over (partition by id order by c, w) as i from tok join freq using (w)) where i <= n - (4 * n + 4) // 5 + 1
), near as (
  select distinct a.id as x, b.id as y from pre a join pre b on a.w = b.w and a.id <> b.id and 5 * b.n >= 4 * a.n and 5 * a.n >= 4 * b.n
), sim as (
  select x, y from (select x, y, a.n + b.n as total, len(list_intersect(a.s, b.s)) as c from near join sets a on a.id = x join sets b on b.id = y) where 5 * c >= 4 * (total - c)
), early as (
  select a.s, least(a.first, coalesce(min(b.first), a.first)) as early from sets a left join sim on x = a.id left join sets b on b.id = y group by a.s, a.first
), gone as (
  select doc_id, line_no from lines join early using (s) where early < (doc_id, line_no)
), n as (
  select doc_id, count(*) as n_lines from lines group by doc_id
), g as (
  select doc_id, count(*) as n_removed, string_agg(line_no::varchar, ',' order by line_no) as removed_lines from gone group by doc_id
)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, coalesce(removed_lines, '') as removed_lines
from documents d left join n using (doc_id) left join g using (doc_id)
"""
