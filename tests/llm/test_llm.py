"""The corpus operators: edge cases, and brute force where SQL has no form."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA, same

from lodestone.llm import cover_dedup, exact_dedup, line_dedup, mixing, packing, pii, quality_rules, registry, sharding, simhash, suffix_dedup
from lodestone.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, k int, whole string, row long, doc long, size long"
LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
REPEATED = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen.\n" * 3
EDGE = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, LONG, "en", "a"), (4, LONG, "en", "a"), (5, LONG.upper(), "de", None), (None, "null id text of a few words", None, "b"),
    (7, "null id text of a few words", "en", "b"), (8, REPEATED, "en", "b"), (9, REPEATED + "tail", "en", "b"), (9, "Same id, other text: é   a@b.c.d\U0001f600 +1 (234) 555-1234", "en", "c"), (10, "a\x00b" * 80, "en", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, 0, True, 1, "w", 9, 9, 9) for r in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "op1": lambda d: packing.pack(d, packing.word_bpe()), "op2": exact_dedup.exact_dedup, "op3": line_dedup.line_dedup, "op4": cover_dedup.cover_dedup, "op5": pii.find_pii,
    "op6": quality_rules.quality_rules, "op7": sharding.sharding, "op8": mixing.mix, "op9": simhash.simhash, "op10": suffix_dedup.suffix_dedup,
}
STAGES = {"quality": quality_rules.keep_good, "exact": exact_dedup.keep_one, "near": simhash.keep_one, "mix": mixing.mixed_documents, "lines": line_dedup.remove_lines, "redact": pii.redact}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_cases(edge, empty, name):
    got = OPERATORS[name](edge).collect()
    assert OPERATORS[name](empty).count() == 0
    if name == "op1":
        assert {(r["doc_id"]) for r in got} == {r[0] for r in EDGE}
    else:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in EDGE)


@pytest.mark.parametrize(("name", "sql"), [("op2", exact_dedup.OP2_SQL), ("op6", quality_rules.OP6_SQL)])
def test_edge_values(edge, name, sql):
    """Null, empty, very long, repeated and odd rows give what the SQL gives."""
    import duckdb

    con = duckdb.connect()
    con.register("documents", edge.select("doc_id", "text", "lang", "source").toArrow())
    want = con.execute(sql).df()
    same(OPERATORS[name](edge).select(*want.columns).toPandas(), want)


@pytest.mark.parametrize("name", STAGES)
def test_stage_edge_cases(edge, empty, name):
    got = STAGES[name](edge)
    assert got.columns == edge.columns
    n = got.count()
    assert STAGES[name](empty).count() == 0
    assert n <= 2 * len(EDGE)
    if name == "exact":
        assert n == 8  # one null or empty, the space, LONG, and one of each other text


SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, duck, name):
    same(registry.queries()[name](spark, DATA).toPandas(), duck.execute(SQL[name]).df())


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("select doc_id, coalesce(text, '') from documents").fetchall())


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    got = packing.op1_packing(spark, DATA).collect()
    check_packing(got, texts)
    tokenizer = Tokenizer.from_file(packing.word_bpe())
    by = {(r["doc_id"], r["piece"]): r for r in got}
    for d, t in texts.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), 2048)):
            own, r = ids[a : a + 2048], by.pop((d, p))
            assert (r["start"], r["length"], r["ids_crc32"]) == (a, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert not by


def check_packing(got, texts):
    room = {}
    for r in got:
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in room.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert len(room) <= math.ceil(sum(r["length"] for r in got) / 2048) * 1.01 + 1


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, own, rng = Tokenizer.from_file(packing.word_bpe()), packing.Encoder(packing.word_bpe()), random.Random(5)
    letters = [*"abAB'sSt.,#0 19\t\n\xa0 éÉßẞİ\x1c\x85Σςﬁ中文!?​😀<|>", "<|endoftext|>", "'S", "'ll", " ", "  ", "é"]
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for t, ids in zip(some, own.ids(pa.array(some)), strict=True):
        assert np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() == ids


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    for capacity, n in ((64, 5000), (64, 7), (1, 3)):
        want = dict(Counter(rng.integers(1, capacity + 1, n).tolist()))
        got = Counter()
        for items, times in packing.plan(want, capacity, 60):
            assert sum(a * b for a, b in items) <= capacity and times > 0
            for length, count in items:
                got[length] += count * times
        assert dict(got) == want
    assert packing.plan({}, 8) == []


@pytest.mark.parametrize("least", [1, 900])
def test_program_covers_the_demand(least):
    """Many lengths: the program itself has to cover the whole demand with few sequences and to lay most of them."""
    lengths = np.arange(least, 2048)
    demand = np.full(len(lengths), 50.0)
    found = packing.solve(lengths, demand, 2048)
    assert (sum(c * x for c, x in found) >= 0.999 * demand).all()
    few = demand @ lengths / 2048 if least == 1 else demand[lengths > 1024].sum()
    assert sum(x for _, x in found) <= 1.05 * few
    placed = {}
    out = packing.plan(dict.fromkeys(lengths.tolist(), 50), placed=placed)
    assert sum(t for _, t in out) <= 1.01 * few + 1
    assert placed["program"] >= 0.9 * sum(t for _, t in out)


def test_pii(spark, texts):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(d)), "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }

    def brute(t):
        found = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds.values()) for m in re.finditer(p, t) if ok(m[0]))
        return [(a, k, b) for a, k, b in found]

    for r in pii.op5_pii(spark, DATA).collect():
        spans = brute(texts[r["doc_id"]])
        listed = [f"{list(kinds)[k]}:{a}:{b}" for a, k, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}
    rng = random.Random(9)
    bits = ["a@b.c", "x.y@", "@", "..", "1.2.3.4", "256.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111", "-", " ", "+1 (743) 555-3824", "+", "9", "0" * 20, "z", "é"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(t) == brute(t), t


def test_names_beside_punctuation():
    for t in ('contact "John Smith"', "(Maria Lopez)", "name:John Smith", "-Karen Miller", "\u00abPeter Pan\u00bb", "dear John Smith"):
        assert [t[a:b] for a, k, b, _ in pii.candidates(t, []) if k == 6] == [" ".join(re.findall("[A-Z][a-z]+", t))], t
    assert pii.candidates("xJohn Smith, John smith", []) == []


def test_labelers_agree_with_planted_classes():
    for_it = [2, 2, 2, 0, 2]
    pattern = lambda v: sum(x * 3**k for k, x in enumerate(v))
    counts = {(4, pattern(for_it)): 50, (4, pattern([2, 0, 2, 0, 2])): 40, (4, pattern([0, 0, 0, 1, 1])): 60, (4, pattern([0, 0, 0, 0, 1])): 80}
    p = pii.train(counts)
    assert p[4, pattern(for_it)] > 0.8 > 0.2 > p[4, pattern([0, 0, 0, 1, 1])]


def brute_simhash(t):
    import xxhash

    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash(spark, texts):
    prints = {d: brute_simhash(t) for d, t in texts.items()}
    want = brute_components(prints)
    for r in simhash.op9_simhash(spark, DATA).collect():
        assert (int(r["fingerprint"], 16), r["component_id"]) == (prints[r["doc_id"]], want[r["doc_id"]])


def test_golay_keys_meet():
    rng = np.random.default_rng(1)
    assert set(np.bincount(simhash.decode(np.arange(1 << 23))).tolist()) == {1 << 11}  # a perfect code
    a = rng.integers(0, 1 << 23, 3000)
    for flips in (0, 1, 2):
        b = a.copy()
        for k in range(len(a)):
            for bit in rng.choice(23, flips, replace=False):
                b[k] ^= 1 << int(bit)
        ka, kb = ({(i, x) for i, x in zip(*map(np.ndarray.tolist, simhash.golay_keys(v)), strict=True)} for v in (a, b))
        assert {i for i, _ in ka & kb} == set(range(len(a)))


def test_links_of_crowded_fingerprints(spark):
    """A chain of near fingerprints, many in one bucket, and their components against brute force."""
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(40)}
    base = rng.getrandbits(64)
    for _ in range(250):
        x = base
        for bit in rng.sample(range(45, 64), rng.randint(0, 4)):
            x ^= 1 << bit
        prints.add(x)
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(sign(x),) for x in prints], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(nodes, bucket=8)).collect()}
    want = brute_components({sign(x): x for x in prints})
    groups = Counter(want.values())
    for x, w in want.items():
        assert (groups[w] == 1 and x not in roots) or roots[x] == min(k for k, v in want.items() if v == w)


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(k * 7 % 101, (k + 1) * 7 % 101) for k in range(100)], "a long, b long")
    assert {r["root"] for r in components(e).collect()} == {0}


def brute_bytes(docs):
    first, out = set(), []
    for d, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in first:
                gone[i : i + 100] = b"\1" * 100
            first.add(w)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def test_suffix_dedup(spark, texts):
    rng = random.Random(2)
    passage = "".join(rng.choice("abc d") for _ in range(260))
    docs = [(i, passage[rng.randint(0, 120) : rng.randint(140, 260)] + ("x" * rng.choice((0, 99, 100, 150, 400))) + "ab" * rng.choice((0, 70)) + str(i)) for i in range(30)]
    docs += [(100 + d, t) for d, t in list(texts.items())[:60]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffix_dedup.suffix_dedup(df).drop("kept").collect()
    assert sorted(map(tuple, got)) == brute_bytes([(d, t.encode()) for d, t in sorted(docs)])


def test_hot_anchors_are_dealt_by_string(spark, monkeypatch):
    """One piece with many surroundings: the same result, and no key has more than one string."""
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    rng = random.Random(3)
    rule = "-" * 90
    some = ["".join(rng.choice("ab \u00e9") for _ in range(70)) for _ in range(12)]
    docs = [(i, rng.choice(some)[: rng.randint(20, 70)] + rule + rng.choice(some) + str(i) + rule * rng.randint(0, 2)) for i in range(80)]
    docs += [docs[3], (3, docs[5][1]), (None, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    hot = suffix_dedup.suffix_dedup(df).drop("kept").collect()
    monkeypatch.setattr(suffix_dedup, "HOT", 1 << 40)
    assert sorted(map(str, hot)) == sorted(map(str, suffix_dedup.suffix_dedup(df).drop("kept").collect()))
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(docs[:80], df.schema).repartition(3)).drop("kept").collect()
    assert sorted(map(tuple, got)) == brute_bytes([(d, t.encode()) for d, t in docs[:80]])
    texts = [t.encode() for _, t in docs[:80]]
    owner, start, _, _ = suffix_dedup.segments(texts)
    found = [[int(x) for x in suffix_dedup.tags(texts)[n] << 32 | start[owner == n] << 1 | 1] for n in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(80), pa.int64()), pa.array([t for _, t in docs[:80]]), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text", "found"])
    sent = Counter(r["k"] for b in suffix_dedup.contexts(iter([batch])) for r in b.to_pylist() if r["text"] is not None)
    assert max(sent.values()) == 1


def test_pieces_of_long_texts(monkeypatch):
    """Cut texts have every start of a string once, under the anchor that the whole text gives it."""
    rng = random.Random(6)
    some = ["".join(rng.choice("ab c") for _ in range(n)) for n in (0, 99, 100, 400, 3_950, 1_000, 2_099)]

    def keys(batches):
        out = {}
        for ids, texts, tag, base in suffix_dedup.pieces(batches, 99):
            for o, s, c, k in zip(*map(np.ndarray.tolist, suffix_dedup.segments(texts)), strict=True):
                for p in range(s + int(base[o]), s + int(base[o]) + c):
                    assert out.setdefault((ids[o], int(tag[o]), p), k) == k
                    assert p < len(some[ids[o]]) - 99
        return out

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some)), pa.int64()), pa.array(some)], names=["doc_id", "text"])
    whole = keys(iter([batch]))
    assert len(whole) == sum(max(0, len(t) - 99) for t in some)
    monkeypatch.setattr("lodestone.llm.blocks.BLOCK", 1_000)
    assert keys(iter([batch])) == whole


def test_passage_over_the_cut_of_a_long_text(spark):
    """A text of several blocks: a passage over the cut is found in a later text and within the text, and nothing else."""
    letters = np.frombuffer(b"abcdefghijklmnop", np.uint8)
    long = letters[np.random.default_rng(9).integers(0, 16, 4_600_000)].tobytes().decode()
    cut = 2 << 20
    passage = long[cut - 300 : cut + 300]
    docs = [(1, long + "#" + passage), (2, "!" + passage + "!"), (3, "# no copy #" * 5), (4, "#" + long[2 * cut - 60 : 2 * cut + 39]), (5, "?" + long[2 * cut - 60 : 2 * cut + 40])]
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got} == {1: (4_600_601, 600, 1), 2: (602, 600, 1), 3: (55, 0, 0), 4: (100, 0, 0), 5: (101, 100, 1)}
    assert {r["doc_id"]: r["kept_sha256"] for r in got}[1] == hashlib.sha256((long + "#").encode()).hexdigest()


def test_strings_across_shards(monkeypatch):
    """One anchor's texts over many small shards: found by binary search among those carried on."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 1000)
    rng = random.Random(8)
    base = bytes(rng.choice(b"abcdef") for _ in range(176))
    rows = []
    for doc in range(60):
        text = bytearray(base)
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(176)] = rng.choice(b"abcdef")
        rows.append((5, doc, 0, 77, bytes(text)))
    shards, got = suffix_dedup.Shards(), []
    for r in rows:
        got += shards.add(r)
    got += shards.flush()
    gone = {(d, (at & 0xFFFFFFFF) // 2 + k) for d, at, n in got for k in range(n)}
    seen, want = set(), set()
    for _, doc, _, _, text in rows:
        own = [text[i : i + 100] for i in range(77)]
        want |= {(doc, i) for i, w in enumerate(own) if w in seen}
        seen |= set(own)
    assert gone == want


def test_suffix_array_and_prefixes():
    rng = random.Random(6)
    parts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 150))) for _ in range(20)]
    size = np.array([len(p) for p in parts])
    lanes = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(b"".join(parts), np.uint8)
    end = np.repeat(lanes + size, size)
    order = suffix_dedup.suffix_array(data, end)
    suffix = [data[i : end[i]].tobytes() for i in order]
    assert suffix == sorted(suffix)
    height = suffix_dedup.common_prefixes(data, end, lanes, order, 100)
    for k in range(1, len(order)):
        a, b = suffix[k - 1], suffix[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert height[k] == min(n, 100)


def test_cover_brings_any_two_positions_together():
    assert all(any((i + s) % 7 in cover_dedup.COVER and (j + s) % 7 in cover_dedup.COVER for s in range(7)) for i in range(7) for j in range(7))
    assert cover_dedup.PERIOD + cover_dedup.GRAM - 1 == cover_dedup.WINDOW


def brute_lines(docs):
    every = sorted((d, i, frozenset(w)) for d, t in docs for i, x in enumerate(t.split("\n")) if (w := re.findall("[^\x20\x09-\x0d]+", x)))
    found = {d: [0, []] for d, _ in docs}
    for k, (d, i, s) in enumerate(every):
        found[d][0] += 1
        if any(5 * len(s & q) >= 4 * len(s | q) for _, _, q in every[:k]):
            found[d][1].append(i)
    return sorted((d, n, len(gone), ",".join(map(str, gone))) for d, (n, gone) in found.items())


@pytest.mark.parametrize("frequent", [512, 16384, 1])
def test_lines_of_hot_words(spark, monkeypatch, frequent):
    """All pairs by Jaccard, over lines most of whose words are in many others, whatever the number of words held to be frequent."""
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rng = random.Random(5)
    common, docs = [f"c{i}" for i in range(14)], []
    for d in range(60):
        own = []
        for _ in range(rng.randint(0, 9)):
            words = [rng.choice(common) for _ in range(rng.randint(1, 12))] + [f"r{rng.randint(0, 30)}" for _ in range(rng.choice((0, 0, 1, 3)))]
            own.append(rng.choice((" ", "  ", "\t")).join(words))
            if rng.random() < 0.3:
                own.append(" ".join(words[:-1] + [f"n{rng.randint(0, 3)}"]))
        docs.append((d, rng.choice(("\n", "\n\n", "\n \r")).join(own)))
    got = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute_lines(docs)


def test_lines_of_one_id_and_of_many_words(spark):
    """All pairs by Jaccard: rows of one id and of null ids, and sets on both sides of the size from which signatures have 128 bits."""
    rng, docs = random.Random(8), []
    for k in range(60):
        size = rng.choice((12, line_dedup.LARGE - 4, line_dedup.LARGE + 12))
        words = [[f"t{rng.randint(0, 5)}x{i}" if rng.random() < 0.08 else f"t{i}" for i in range(size + rng.randint(-3, 3))] for _ in range(rng.randint(1, 4))]
        docs.append((rng.choice((None, rng.randint(-9, 9), k)), f"{k} of its own\n" + "\n".join(map(" ".join, words))))
    got = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    place = lambda d, i: ((1, 0) if d is None else (0, d), i)
    every = [(place(d, i), frozenset(x.split())) for d, t in docs for i, x in enumerate(t.split("\n"))]
    want = []
    for d, t in docs:
        gone = [i for i, x in enumerate(t.split("\n")) if any(p < place(d, i) and 5 * len(s & q) >= 4 * len(s | q) for s in [frozenset(x.split())] for p, q in every)]
        want.append((str(d), t.count("\n") + 1, len(gone), ",".join(map(str, gone))))
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(want)


def test_remove_and_redact(spark):
    text = "alpha beta gamma delta eps zeta eta theta iota kappa"
    d = spark.createDataFrame([(1, f"{text}\nother"), (2, f"keep\n{text} lambda\nmail a@b.c or +1 (743) 555-3824")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(d).collect()} == {1: f"{text}\nother", 2: "keep\nmail a@b.c or +1 (743) 555-3824"}
    assert {r["text"].split("\n")[-1] for r in pii.redact(d).collect()} == {"other", "mail <email> or <phone>"}


def test_kept_texts_lose_common_lines(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(70))
    rows = [(i, f"All rights  reserved\n{own(i)}\n\nALL rights reserved\n", "a") for i in range(25)] + [(99, f"all rights reserved\n{own(99)}", "b")]
    rows += [(100, rows[0][1], "a"), (101, "all rights reserved\n" * 40, "a")]
    got = quality_rules.keep_good(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = {i: f"{own(i)}\n\n" for i in range(25)} | {99: rows[25][1], 100: f"{own(0)}\n\n"}
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(want.items())


def test_depletion_alone_rejects(spark):
    """Lines that a host's documents share are counted and taken out; a text that is mostly such lines goes."""
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    shared = "\n".join(f"a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(12))
    rows = [(i, f"{shared}\n{own(i, 90)}", "a") for i in range(8)] + [(50, f"{own(50, 20)}\n{shared}", "a"), (51, f"{own(51, 20)}\n{shared}", "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(d).collect()}
    assert {k for k, r in got.items() if not r["kept"]} == {50} and not got[50]["base_failed"] and got[50]["n_common_words"] == 72 and got[51]["n_common_words"] == 0
    assert {r["doc_id"]: r["text"] for r in quality_rules.keep_good(d).collect()} == {i: own(i, 90) for i in range(8)} | {51: rows[9][1]}


def test_redact_merges_overlapping_spans(spark):
    text = "pay 4111 1111 1111 1111 or call +1 (743) 555-3824, mail 10.0.0.1@ab.cd now"
    d = spark.createDataFrame([(1, text), (2, None), (None, "plain"), (4, "x 1.2.3.4")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert got[2] is None and got[None] == "plain" and got[4] == "x <ip>"
    assert got[1] == "pay <card> or call <phone>, mail <email><ip> now"


def test_hot_copies_take_the_broadcast_route(spark):
    rows = [(i, "Hot" if i % 2 else "hOT", "a") for i in range(9)] + [(20 + i, "other", "b") for i in range(3)] + [(30, "one", "c"), (31, None, "c"), (32, "", "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    usual, hot = ({tuple(r) for r in exact_dedup.exact_dedup(d, heavy_rows=n).collect()} for n in (1000, 2))
    assert usual == hot and {(r[0], r[1], r[2]) for r in hot if r[3]} == {(8, 8, 9), (22, 22, 3), (30, 30, 1), (32, 32, 2)}


def test_mixing_cuts_text(spark):
    d = spark.createDataFrame([(i, "a  b\nc d", "s" if i else "t") for i in range(12)], "doc_id long, text string, source string")
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(d).collect()}
    got = Counter()
    for r in mixing.mixed_documents(d).collect():
        got[r["doc_id"]] += len(r["text"].split())
        assert "a  b\nc d".startswith(r["text"])
    assert dict(got) == {k: v for k, v in plan.items() if v}


def test_sharding_moves_little():
    names = [f"shard-{k}" for k in range(16)]
    full, less = sharding.fill(names), sharding.fill(names[:-1])
    assert max(Counter(full).values()) - min(Counter(full).values()) <= 1
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 15)
    assert moved < 0.1 * len(full)
    with pytest.raises(ValueError):
        sharding.fill(names, 100)


def test_pipeline(spark, texts):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = docs.collect()
    judged = {r["doc_id"]: r["kept"] for r in quality_rules.op6_quality_rules(spark, DATA).collect()}
    kept = [r for r in kept if judged[r["doc_id"]]]
    best = {}
    for r in kept:
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
        if k not in best or best[k]["doc_id"] < r["doc_id"]:
            best[k] = r
    prints = {r["doc_id"]: brute_simhash(r["text"]) for r in best.values()}
    alone = [r for r in best.values() if brute_components(prints)[r["doc_id"]] == r["doc_id"]]
    frame = spark.createDataFrame(alone, docs.schema)
    want = Counter({r["doc_id"]: r["taken"] for r in mixing.mix(frame).collect() if r["taken"]})
    got = corpus_pipeline.run(spark, DATA).collect()
    check_packing([r for r in got], texts)
    assert {r["doc_id"] for r in got} == set(want)
    assert got[0].asDict().keys() == set(packing.COLUMNS)


def test_nothing_else_imports_these():
    import pathlib

    root = pathlib.Path(packing.__file__).parents[1]
    for f in root.rglob("*.py"):
        if f.parent.name != "llm":
            assert not re.search(r"\bllm\b", f.read_text())
