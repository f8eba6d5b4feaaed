"""Exact search, ranked search and conversation repair against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import conversation_repair as repair
from lodestone.llm import mtree, ranked_search

VECTORS = "vec_id long, embedding array<float>, row long, v string, rank int, query long, cell int, least long, asked boolean"


def best_products(rows, k, every):
    whole = []
    for number, (name, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((number, name, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for number, name, x in whole:
        if name is not None and name % every == 0:
            found = [(-sum(a * b for a, b in zip(x, y)), n is None, n or 0, m) for m, n, y in whole if m != number]
            out += [(name, r + 1, None if none else n, -s) for r, (s, none, n, _) in enumerate(sorted(found)[:k])]
    return sorted(map(str, out))


def searched(spark, rows, k=5, every=50):
    df = spark.createDataFrame([(n, v, 1, "v", 1, 1, 1, 1, True) for n, v in rows], VECTORS)
    return sorted(str(tuple(r)) for r in mtree.mtree_search(df, F.col("vec_id") % every == 0, k).collect())


ODD_VECTORS = [
    (0, [0.5, -0.25, 0.125]), (0, [0.5, -0.25, 0.125]), (1, [0.5, -0.25, 0.125]), (50, None), (100, []), (2, [0.0, 0.0, 0.0]), (3, [float("nan"), 1.0, 1.0]),
    (4, [float("inf"), 1.0, 1.0]), (5, [None, 1.0, 1.0]), (None, [0.5, -0.25, 0.125]), (150, [9.0, 0.001, -0.001]), (7, [1.0, 1.0]), (200, [-1.0, 1.0, 1.0]), (8, [1e30, 0.0, 0.0]),
]


def test_products_of_odd_rows(spark):
    """Vectors too long for whole scores are left out as well."""
    assert searched(spark, ODD_VECTORS) == best_products([r for r in ODD_VECTORS if r[0] != 8], 5, 50)
    assert searched(spark, []) == []
    assert searched(spark, [(1, [1.0])]) == searched(spark, [(0, [1.0])]) == []
    assert len(searched(spark, [(0, [1.0]), (1, [1.0]), (2, [1.0])])) == 2


def test_products_over_many_subtrees(spark, monkeypatch):
    """A third of all rows is one vector, queries come in several parts, and most subtrees are not the query's own."""
    monkeypatch.setattr(mtree, "SUBTREE", 60)
    monkeypatch.setattr(mtree, "QUERIES", 7)
    monkeypatch.setattr(mtree, "ROOT", 4)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + 0.2 * rng.normal(size=8)).round(2).tolist()) for i in range(700)]
    rows += [(700 + i, rows[12][1]) for i in range(350)]
    assert searched(spark, rows, 5, 10) == best_products(rows, 5, 10)


@pytest.mark.parametrize("scale", [3, 300, 10**7])
def test_tree_against_all_products(scale, monkeypatch):
    monkeypatch.setattr(mtree, "LEAF", 5)
    monkeypatch.setattr(mtree, "FANOUT", 3)
    rng = np.random.default_rng(scale)
    vectors = np.unique(rng.integers(-scale, scale, (400, 3)), axis=0)
    space = mtree.Space(3, int((vectors**2).sum(axis=1).max()))
    rows = [[(False, 2 * i, 0), (False, 2 * i + 1, 0)] for i in range(len(vectors))]
    tree = mtree.Tree(space, vectors, rows)
    assert len(tree.first) > 50 and np.array_equal(np.sort(tree.vector[tree.below < 0]), np.arange(len(vectors)))
    for q in vectors[::20]:
        scores = sorted(((int(v @ q), *r) for v, own in zip(vectors, rows, strict=True) for r in own), key=lambda r: (-r[0], r[1:]))
        assert tree.search(q, 7, None) == scores[:7]
        assert tree.search(q, 7, scores[3][0]) == [r for r in scores[:7] if r[0] >= scores[3][0]] or scores[3][0] == scores[6][0]


def test_tree_rules_pages_out():
    """Clustered vectors: most pages are never opened."""
    rng = np.random.default_rng(1)
    vectors = (1000 * rng.normal(size=(40, 1, 4)) + 5 * rng.normal(size=(1, 100, 4))).reshape(-1, 4).astype(np.int64)
    space = mtree.Space(4, int((vectors**2).sum(axis=1).max()))
    tree = mtree.Tree(space, vectors, [[(False, i, i)] for i in range(len(vectors))])
    opened = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            opened.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    tree.exact = tree.exact.view(Counted)
    tree.search(vectors[int((vectors**2).sum(axis=1).argmax())], 5, None)
    assert sum(opened) < len(vectors) / 3


DOCUMENTS = "doc_id long, text string, item_id long, item long, score long, rank int, n long, terms string, part int"


def ranking(docs, items, k=20):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(d, Counter(pattern.findall((t or "").translate(low)))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for name, text in items:
        scores = []
        for d, c in found:
            score = 0
            for t, times in Counter(pattern.findall((text or "").translate(low))).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * (100 - 25 + (25 * sum(c.values()) * n_docs) // total)))
            if score:
                scores.append((-score, d is None, d or 0))
        out += [(name, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(map(str, out))


def ranked(spark, docs, items, k=20):
    d = spark.createDataFrame([(i, t, 1, 1, 1, 1, 1, "t", 1) for i, t in docs], DOCUMENTS)
    q = spark.createDataFrame([(1, t, i, 1, 1, 1, 1, "t", 1) for i, t in items], DOCUMENTS)
    return sorted(str(tuple(r)) for r in ranked_search.ranked_search(d, q, k).collect())


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t .!"), (4, "alpha beta beta " * 5000), (4, "alpha"), (4, "alpha"), (None, "Alpha\x00BETA gamma_delta"), (6, "é ß alpha-É"), (7, "gamma " * 30 + "alpha"), (8, "alpha"), (9, "alphA"),
]
ODD_ITEMS = [(1, "alpha"), (1, "alpha"), (2, None), (3, "?!"), (None, "BETA beta gamma"), (5, "é ß unheard"), (6, "unheard")]


def test_ranking_of_odd_rows(spark):
    assert ranked(spark, ODD_TEXTS, ODD_ITEMS) == ranking(ODD_TEXTS, ODD_ITEMS)
    assert ranked(spark, ODD_TEXTS, ODD_ITEMS, 2) == ranking(ODD_TEXTS, ODD_ITEMS, 2)
    assert ranked(spark, [], ODD_ITEMS) == ranked(spark, ODD_TEXTS, []) == ranked(spark, ODD_TEXTS[:3], ODD_ITEMS) == []


def test_ranking_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "ROUND_TERMS", 4)
    assert ranked(spark, ODD_TEXTS, ODD_ITEMS) == ranking(ODD_TEXTS, ODD_ITEMS)


@pytest.mark.parametrize("leaf", [1, 40])
def test_intervals_against_all_scores(leaf, monkeypatch):
    """Frequent and rare terms, a run of equal documents, ties; the best documents stand far apart."""
    monkeypatch.setattr(ranked_search, "LEAF_POSTINGS", leaf)
    rng = np.random.default_rng(leaf)
    docs = [rng.zipf(1.3, 40) % 90 for _ in range(400)] + [np.arange(30)] * 200
    pairs = [(d, t, c) for d, words in enumerate(docs) for t, c in Counter(words.tolist()).items()]
    doc, term, times = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
    sizes = np.array([len(w) for w in docs])
    block = ranked_search.Block(np.arange(600) * 3, np.zeros(600, bool), sizes, doc, term, times, 600, int(sizes.sum()))
    part = 75 + (25 * sizes * 600) // int(sizes.sum())
    for trial in range(12):
        own = np.unique(rng.integers(0, 90, 6 + trial))
        weight = rng.integers(1, 5000, len(own))
        scores = np.zeros(600, np.int64)
        for t, w in zip(own, weight, strict=True):
            for d, c in zip(doc[term == t], times[term == t], strict=True):
                scores[d] += w * ((10**9 * c) // (1000 * c + 12 * part[d]))
        want = sorted((-s, 3 * d) for d, s in enumerate(scores.tolist()) if s)[:9]
        top = ranked_search.Top(9)
        block.search(own, weight, top)
        assert sorted((-s, d) for s, d in top.rows()) == want


def cheapest(symbols):
    """(cost, edits) of all ways to edit, the least of the cheapest first."""
    best = None
    names = "sua?"
    for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
        if sum(inserts) > 4:
            continue
        slots = [["I"] * inserts[0]] + [[e] + ["I"] * n for n, e in zip(inserts[1:], ["?"] * len(symbols), strict=True)]
        for edits in itertools.product("DKR", repeat=len(symbols)):
            text = "".join(slots[0]) + "".join(e + "I" * (len(s) - 1) for e, s in zip(edits, slots[1:], strict=True))
            cost = 5 * sum(inserts)
            row, shape, ok = 0, [], True
            for e in text:
                if e == "I":
                    shape.append("*")
                    continue
                kind, fault = divmod(symbols[row], 3)
                row += 1
                if e == "D":
                    cost += 2
                    continue
                ok &= fault != repair.BAD
                cost += 5 * (fault == repair.CUT) + (e == "R")
                shape.append("*" if e == "R" else names[kind])
            if not ok or best and (cost, text) >= best:
                continue
            odd = len(shape) % 2
            fits = all(c == w or c == "*" for c, w in zip(shape[odd:], "ua" * len(shape), strict=False)) and (not odd or shape[0] == "s" and len(shape) > 2)
            if fits:
                best = cost, text
    return best


def test_edits_are_the_least_of_the_cheapest():
    rng = random.Random(3)
    every = [list(s) for n in range(1, 4) for s in itertools.product(range(12), repeat=n)]
    for symbols in [*rng.sample(every, 250), *([rng.randrange(12) for _ in range(4)] for _ in range(30))]:
        got = "".join(repair.walk(symbols, repair.START, repair.LAST, True))
        want = cheapest(symbols)
        assert got == want[1], symbols
        costs = repair.LAST
        for s in reversed(symbols):
            costs = repair.before(s, costs)
        assert costs[repair.START] == want[0]


def test_segments_join_to_the_whole():
    """Any cuts: costs at the borders from the matrices, edits for the state a segment begins in, the same as in one piece."""
    rng = random.Random(8)
    symbols = [rng.randrange(12) for _ in range(3000)]
    whole = "".join(repair.walk(symbols, repair.START, repair.LAST, True))
    cuts = [0, *sorted(rng.sample(range(1, 3000), 9)), 3000]
    parts = [symbols[a:b] for a, b in itertools.pairwise(cuts)]
    import pyarrow as pa

    group = pa.table({"conv": [1] * 10, "part": pa.array(range(10), pa.int32()), "matrix": [repair.matrix(p) for p in parts]})
    ends = repair.borders(group)
    state, out = repair.START, ""
    for part, end, last in zip(parts, ends["end"].to_pylist(), ends["last"].to_pylist(), strict=True):
        done = repair.walk(part, state, tuple(end), last)
        for symbol, edits in zip(part, done, strict=True):
            for e in edits:
                if e != "D":
                    state = repair.NEXT[state][symbol // 3] if e == "K" else repair.FITTING[state]
        out += "".join(done)
    assert out == whole


CHAT = "conv_id long, turn long, role string, text string, conv long, row long, kind int, digest string, copy int, at long, part int, h long"


def chat(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, "d", 1, 1, 1, 1) for r in rows], CHAT)


def audited(rows):
    """The same by plain Python, for rows after damage."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, symbols, faults = set(), [], Counter()
        for _, role, text in own:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            kind = "sua".find(role[0]) if role and role[0] in "sua" else 3
            symbols.append(3 * kind + (repair.BAD if fault in ("blank", "duplicate") else repair.CUT if fault else repair.SOUND))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        edits = "".join(repair.walk(symbols, repair.START, repair.LAST, True))
        cost = repair.LAST
        for s in reversed(symbols):
            cost = repair.before(s, cost)
        roles = itertools.cycle(["user", "assistant"])
        n = sum(e != "D" for e in edits)
        lines, left = [], iter(own)
        for e in edits:
            row = next(left) if e != "I" else (None, "", "")
            if e != "D":
                role = row[1] if n % 2 and not lines else next(roles)
                lines.append(f"{row[1] if e == 'K' else role}:{row[2]}")
        out.append(str((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost[0], edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())))
    return sorted(out)


ODD_CHAT = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes?"), (2, 0, "user", " \n"), (2, 0, "user", " \n"), (3, None, None, None), (3, 5, "user", "cut off"), (3, 9, "assistant", "Done. \n"),
    (None, 1, "user", "No id."), (None, None, "assistant", "No id."), (4, 1, "uber", "Kept name!"), (4, 2, "A", "Not an a."), (4, 2, "", "No role."), (5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 2, "user", "Same."),
    (5, 3, "assistant", "Fine ."), (6, 1, "user", "x" * 300_000 + "?"), (6, 2, "assistant", " "), (7, -3, "assistant", "Alone."), (7, 2**40, "user", "Far."),
]


def test_audit_of_odd_rows(spark):
    got = repair.audit(chat(spark, ODD_CHAT))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == audited(ODD_CHAT)
    assert repair.audit(chat(spark, [])).count() == repair.repair(chat(spark, [])).count() == 0
    rows = [tuple(r)[2:] for r in repair.repair(chat(spark, ODD_CHAT)).orderBy("position").where("conv_id = 1").collect()]
    assert rows == [("system", "Be kind."), ("user", "Hi."), ("assistant", "Yes?")]


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["Yes.", "No", "Why not?", " ", f"Number {i}.", f"Cut {i}"])) for i in range(1500)]
    rows += [(k, i, r, "So.") for k in range(2, 40) for i, r in enumerate(["user", "assistant", "user"])]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = sorted(str(tuple(r)) for r in repair.audit(chat(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == audited(rows)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in (0, 1, None) for t in (*range(40), None)]
    want = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h:
            want += [str((c, t, "user" if h == 4 else role, {1: "", 2: "One Two Three"}.get(h, text)))] * (2 if h == 3 else 1)
    got = repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(want)
