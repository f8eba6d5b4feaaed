"""Personal data by weak supervision.

Patterns with checks give the base spans.  Further candidates (credentials, long identity numbers, names) are judged by labelers: a
pattern, a gazetteer and the words around, each of which votes for, against, or abstains.  Expectation-maximisation over the vote
patterns of the whole corpus estimates how reliable each labeler is, without labels; its posteriors train a logistic span classifier
on votes and shape, which has the last word.  Spark counts the patterns, of which there is a bounded number; only these counts
come to the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, table

#: In the order in which spans at one start are listed.
KINDS = ("email", "ip", "card", "phone", "secret", "number", "name")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
# The looks behind and possessive repeats keep long runs of digits linear; they exclude no match.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches.  The part before an @ has no @, so each @ is tried once, with all the fitting characters before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            free = found.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


# Word lists of the labelers.
NAMES = frozenset("James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Maria Peter Paul Hans Karl Jean Pierre Marie Juan Carlos Jose".split())
CREDENTIALS = ("ghp_", "gho_", "sk_", "pk_", "AKIA", "xoxb-", "xoxp-", "eyJ", "AIza")
SECRET_WORDS = re.compile(r"(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|auth|bearer|credential)\W{0,6}$", re.I)
NUMBER_WORDS = re.compile(r"(?:ssn|passport|account|iban|tax id|social security|customer|patient|license no|id number|id no)\W{0,6}(?:\w{1,8}\W{1,3})?$", re.I)
NAME_WORDS = re.compile(r"(?:mr|mrs|ms|dr|prof|name|dear|contact|signed|sincerely|herr|frau|monsieur|madame|senor|señora)\W{1,3}$", re.I)
AGAINST = re.compile(r"(?:version|page|chapter|figure|table|isbn|commit|sha256|sha1|md5|checksum|revision|license)\W{0,4}(?:\w{1,8}\W{1,3})?$", re.I)
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}+")
NUMBER = re.compile(r"(?<![0-9A-Za-z.,-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])|(?<![0-9A-Za-z.,-])[0-9]{9,13}+(?![0-9A-Za-z-])")
NAME = re.compile(r"(?<!\w)(" + "|".join(sorted(NAMES)) + r") [A-Z][a-z]{1,20}(?!\w)")
HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
LABELERS = ("pattern", "gazetteer", "context", "against", "mixture")
SHAPES = ("long", "quoted", "many_digits", "assigned")


def judge(kind: int, text: str, start: int, end: int) -> int:
    """The votes of the labelers, base 3 (0 abstains, 1 against, 2 for), and the shape bits above them."""
    span, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 1]
    digits = sum(c.isdigit() for c in span)
    if kind == 4:
        votes = [
            2 if HEX.fullmatch(span) else 0, 2 if span.startswith(CREDENTIALS) else 0, 2 if SECRET_WORDS.search(before) else 0, 1 if AGAINST.search(before) else 0,
            2 if len(set(span)) >= 12 and 3 <= digits < len(span) else 1,
        ]
    elif kind == 5:
        votes = [2 if "-" in span else 0, 0 if len(set(span)) > 3 else 1, 2 if NUMBER_WORDS.search(before) else 1, 1 if AGAINST.search(before) else 0, 0]
    else:
        votes = [0, 2, 2 if NAME_WORDS.search(before) else 0, 1 if AGAINST.search(before) else 0, 0 if after.isspace() or after in ",.;" else 1]
    shapes = [len(span) >= 32, before[-1:] in "\"'`" and before != "", digits * 2 > len(span), before.rstrip(" \"'`")[-1:] in ("=", ":")]
    return sum(v * 3**k for k, v in enumerate(votes)) + 3 ** len(LABELERS) * sum(1 << k for k, s in enumerate(shapes) if s)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, votes) of further spans that overlap no base span."""
    found = []
    if DIGIT.search(text):
        found += [(m.start(), 4, m.end()) for m in TOKEN.finditer(text)]
        found += [(m.start(), 5, m.end()) for m in NUMBER.finditer(text)]
    found += [(m.start(), 6, m.end()) for m in NAME.finditer(text)]
    out, busy, k = [], taken, 0
    for start, kind, end in sorted(found):
        while k < len(busy) and busy[k][2] <= start:
            k += 1
        if (k == len(busy) or busy[k][0] >= end) and (not out or out[-1][2] <= start):
            out.append((start, kind, end, judge(kind, text, start, end)))
    return out


FOUND = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("kind", "start", "stop", "votes")]
)
FOUND_SQL = "row long, doc_id long, kind array<long>, start array<long>, stop array<long>, votes array<long>"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            spans = sorted([(a, k, b, -1) for a, k, b in base] + candidates(text or "", base)) if text else []
            for column, values in zip(out, ([s[1] for s in spans], [s[0] for s in spans], [s[2] for s in spans], [s[3] for s in spans]), strict=True):
                column.append(values)
        columns = [batch.column("row"), batch.column("doc_id"), *(pa.array(c, pa.list_(pa.int64())) for c in out)]
        yield pa.RecordBatch.from_arrays(columns, schema=FOUND)


def votes_of(pattern: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(len(LABELERS))]


def reliabilities(patterns: list[int], counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior that a span with each vote pattern is personal data, by expectation-maximisation.

    Per labeler and class a distribution over its three votes, with prior counts that hold a labeler to be right more often than not.
    """
    votes = np.array([votes_of(p) for p in patterns])
    prior = np.array([[2.0, 3.0, 1.0], [2.0, 1.0, 3.0]])  # of votes 0, 1, 2 in the classes no, yes
    theta = np.repeat((prior / prior.sum(axis=1, keepdims=True))[:, None, :], len(LABELERS), axis=1)
    share = 0.5
    for _ in range(rounds):
        fit = [np.log(w) + np.log(theta[c, np.arange(len(LABELERS)), votes]).sum(axis=1) for c, w in ((0, 1 - share), (1, share))]
        yes = 1 / (1 + np.exp(np.clip(fit[0] - fit[1], -50, 50)))
        for c, weight in ((0, counts * (1 - yes)), (1, counts * yes)):
            for k in range(len(LABELERS)):
                own = np.bincount(votes[:, k], weight, 3) + prior[c]
                theta[c, k] = own / own.sum()
        share = float((counts @ yes + 1) / (counts.sum() + 2))
    return yes


def features(patterns: list[int]) -> np.ndarray:
    rows = []
    for p in patterns:
        votes, shapes = votes_of(p), p // 3 ** len(LABELERS)
        rows.append([1.0, *(float(v == 2) for v in votes), *(float(v == 1) for v in votes), *(float(shapes >> k & 1) for k in range(len(SHAPES)))])
    return np.array(rows)


def classifier(patterns: list[int], counts: np.ndarray, soft: np.ndarray, rounds: int = 200, penalty: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression on the soft labels: each pattern weighs by the square root of its count."""
    x, weight = features(patterns), np.sqrt(counts)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - soft)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """For each (kind, pattern) the classifier's probability."""
    out = {}
    for kind in sorted({k for k, _ in counts}):
        patterns = sorted(p for k, p in counts if k == kind)
        n = np.array([counts[kind, p] for p in patterns], float)
        w = classifier(patterns, n, reliabilities(patterns, n))
        out |= {(kind, p): float(v) for p, v in zip(patterns, 1 / (1 + np.exp(-np.clip(features(patterns) @ w, -30, 30))), strict=True)}
    return out


def finish(accepted: frozenset[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kinds, starts, stops, votes in zip(*(batch.column(c).to_pylist() for c in ("kind", "start", "stop", "votes")), strict=True):
                base, every, n = [], [], [0] * 4
                for k, a, b, v in zip(kinds, starts, stops, votes, strict=True):
                    if v < 0:
                        n[k] += 1
                        base.append(f"{KINDS[k]}:{a}:{b}")
                    if v < 0 or (k, v) in accepted:
                        every.append(f"{KINDS[k]}:{a}:{b}")
                out.append((*n, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(every)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds_of = [pa.int64()] * 4 + [pa.string()] * 2
            own = [pa.array(c, t) for c, t in zip(columns, kinds_of, strict=True)]
            names = ["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *own], names=names)

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind.  Matches of one kind don't overlap, those of
    different base kinds may; added spans (probability ``threshold`` or more) overlap no base span.  A null or empty text has no
    spans; null and repeated ids are judged like others; an empty table gives an empty result; other columns are ignored.
    """
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = table(given.mapInArrow(scan, FOUND_SQL), "spans")
    judged = found.select(F.explode(F.arrays_zip("kind", "votes")).alias("s")).where("s.votes >= 0")
    # at most 3 kinds x 243 votes x 16 shapes
    counts = {(r.kind, r.votes): r.n for r in judged.groupBy("s.kind", "s.votes").agg(F.count("*").alias("n")).collect()}
    accepted = frozenset(k for k, p in train(counts).items() if p >= threshold)
    return found.mapInArrow(finish(accepted), "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with each stretch of spans in its text replaced by the kinds in it, in angle brackets; other columns are unchanged.

    Spans that overlap are one stretch, so that no part of any of them stays.  A null text stays null, null and repeated ids are
    treated like others, an empty table gives an empty result.
    """
    rows = table(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("at")), "whole")
    found = find_pii(rows.select("at", F.col("whole").getField(text_col).alias("t")), "at", "t", threshold).select(F.col("doc_id").alias("at"), "spans")
    given = F.col("whole").getField(text_col).cast("string")
    part = lambda t, start, end: F.substring(t, (start + 1).cast("int"), (end - start).cast("int"))
    field = lambda s, k: F.split(s, ":")[k]

    def add(acc, s):
        start, end, kind = field(s, 1).cast("long"), field(s, 2).cast("long"), field(s, 0)
        inside = start < acc["upto"]
        name = F.when(inside & acc["last"].contains(kind), F.lit("")).otherwise(F.concat(F.lit("<"), kind, F.lit(">")))
        text = F.concat(acc["out"], F.when(inside, F.lit("")).otherwise(part(acc["text"], acc["upto"], start)), name)
        last = F.when(inside, F.concat(acc["last"], kind)).otherwise(kind)
        return F.struct(acc["text"].alias("text"), text.alias("out"), F.greatest(end, acc["upto"]).alias("upto"), last.alias("last"))

    first = F.struct(given.alias("text"), F.lit("").alias("out"), F.lit(0).cast("long").alias("upto"), F.lit("").alias("last"))
    done = F.aggregate(F.split("spans", ","), first, add, lambda acc: F.concat(acc["out"], part(acc["text"], acc["upto"], F.char_length(acc["text"]))))
    text = F.when(F.coalesce("spans", F.lit("")) == "", F.col("whole").getField(text_col)).otherwise(done)
    return rows.join(found, "at").select(F.col("whole").withField(text_col, text).alias("whole")).select("whole.*")


def op5_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
