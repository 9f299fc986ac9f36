"""Personal data by fixed patterns and a semi-Markov conditional random field.

The base patterns are exact (see ``base_spans``).  The random field then
reads the stretches of a text that hold digits or an at sign, cuts them into
atoms (letter runs, digit runs, single signs) and scores whole candidate
segments: digit count, grouping, shape, check digit, octets, neighbours.
Dynamic programming over segments of at most ``MAX_ATOMS`` atoms chooses
boundaries and kinds together.  Segments it finds that touch no base span are
added; base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import drawn

KINDS = ("email", "ip", "card", "phone")
#: atoms in one entity at most
MAX_ATOMS = 24
#: documents whose stretches may be used for training (a documented bound)
SAMPLE_DOCS = 20_000
SAMPLE_STRETCHES = 600
EPOCHS = 4
#: least marginal probability of an added segment
LEAST = 0.9

_HINT = re.compile(r"[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern, in time linear
    in the text: a match holds the run of local characters before an at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by start, then kind.
    Matches that fail their check are dropped and not tried again."""
    if not _HINT.search(text):
        return []
    out = [(s, e, 0) for s, e in emails(text)]
    if "." in text:
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        digits = _NON_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Maximal sequences of words that hold a digit or an at sign, one blank
    apart."""
    start = end = -1
    hint = _HINT.search(text)
    while hint:
        lo = hi = hint.start()
        while lo > max(end, 0) and not text[lo - 1].isspace():
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        if start >= 0 and lo == end + 1 and text[end] == " ":
            end = hi
        else:
            if start >= 0:
                yield start, end
            start, end = lo, hi
        hint = _HINT.search(text, hi)
    if start >= 0:
        yield start, end


_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_NUMERIC = re.compile(r"[0-9 ()+.\-]+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")


def shape(text: str) -> str:
    out = []
    for m in _ATOM.finditer(text[:64]):
        a = m.group()
        out.append(f"9{min(len(a), 6)}" if a[0].isdigit() else "a" if a[0].isalpha() else a)
    return "".join(out)


def side(text: str) -> str:
    """Neighbouring characters by class: digit, letter, or themselves."""
    return "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in text)


def segment_features(text: str, kind: str, before: str, after: str) -> list[str]:
    digits = _NON_DIGIT.sub("", text)
    out = [f"{kind} n{len(digits)}", f"{kind} groups{len(re.findall('[0-9]+', text))}",
           f"{kind} first{text[0] if not text[0].isalnum() else 'x'}",
           f"{kind} before{side(before)}", f"{kind} after{side(after)}",
           f"{kind} shape{shape(text)}"]
    if kind == "card":
        out.append(f"card check{luhn(digits) and 12 <= len(digits) <= 19}")
    elif kind == "ip":
        out.append(f"ip octets{octets(text)}")
    elif kind == "phone":
        out.append(f"phone plus{text[0] == '+'} length{9 <= len(digits) <= 15}")
    else:
        name, _, domain = text.partition("@")
        out.append(f"email name{bool(name)} dots{min(domain.count('.'), 3)}")
    return out


def possible(text: str) -> Iterator[str]:
    """Kinds whose characters the segment has."""
    if not text[-1].isalnum():
        return
    if "@" in text[1:]:
        if text.count("@") == 1 and " " not in text and text[0] in _LOCAL:
            yield "email"
        return
    if not (text[0].isdigit() or text[0] in "+(") or not _NUMERIC.fullmatch(text):
        return
    n = sum(c.isdigit() for c in text)
    if _QUAD.fullmatch(text):
        yield "ip"
    if 10 <= n <= 20 and text[0].isdigit() and not set(text) & set("().+"):
        yield "card"
    if 7 <= n <= 16:
        yield "phone"


class Lattice:
    """All segments of one stretch: (first atom, end atom, kind or "", features)."""

    def __init__(self, text: str, start: int, end: int):
        self.cuts = [m.start() for m in _ATOM.finditer(text, start, end)] + [end]
        n = self.n = len(self.cuts) - 1
        self.edges: list[tuple[int, int, str, list[str]]] = []
        for j in range(1, n + 1):
            a, b = self.cuts[j - 1], self.cuts[j]
            self.edges.append((j - 1, j, "", [f"none {shape(text[a:b])}"]))
            after = text[b:b + 2]
            for i in range(j - 1, max(-1, j - 1 - MAX_ATOMS), -1):
                s = self.cuts[i]
                before = text[max(0, s - 2):s]
                for kind in possible(text[s:b]):
                    self.edges.append((i, j, kind, segment_features(text[s:b], kind, before, after)))

    def sums(self, score: list[float]) -> tuple[list[float], list[float]]:
        """Log sums over all ways to cut the stretch, from either side."""
        ahead, back = [-math.inf] * (self.n + 1), [-math.inf] * (self.n + 1)
        ahead[0] = back[self.n] = 0.0
        for (i, j, _, _), s in zip(self.edges, score):
            ahead[j] = log_add(ahead[j], ahead[i] + s)
        for (i, j, _, _), s in zip(reversed(self.edges), reversed(score)):
            back[i] = log_add(back[i], back[j] + s)
        return ahead, back

    def best(self, score: list[float]) -> list[int]:
        """Edges of the best cutting."""
        top, via = [-math.inf] * (self.n + 1), [-1] * (self.n + 1)
        top[0] = 0.0
        for e, ((i, j, _, _), s) in enumerate(zip(self.edges, score)):
            if top[i] + s > top[j]:
                top[j], via[j] = top[i] + s, e
        path, at = [], self.n
        while at:
            path.append(via[at])
            at = self.edges[via[at]][0]
        return path[::-1]


def log_add(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi)) if lo > -math.inf else hi


def scores(lattice: Lattice, weights: dict[str, float]) -> list[float]:
    return [sum(weights.get(f, 0.0) for f in e[3]) for e in lattice.edges]


def variants(text: str, start: int, end: int, gold: list[tuple[int, int, int]]):
    """The sample itself and, where it is one phone number with a country
    code or one plain card number, a local or grouped way to write it."""
    yield text, start, end, gold
    if len(gold) == 1 and gold[0][:2] == (start, end):
        piece, kind = text[start:end], KINDS[gold[0][2]]
        other = None
        if kind == "phone" and " " in piece:
            other = piece.split(" ", 1)[1]
        elif kind == "card" and piece.isdigit() and len(piece) == 16:
            other = " ".join(piece[i:i + 4] for i in range(0, 16, 4))
        if other and any(c.isdigit() for c in other):
            changed = text[:start] + other + text[end:]
            yield changed, start, start + len(other), [(start, start + len(other), gold[0][2])]


def neighbours(samples: list) -> list:
    """Pairs of stretches that are one entity each, written one blank apart:
    the base patterns may run over such a border and then find neither."""
    alone = [s for s in samples if len(s[3]) == 1 and s[3][0][:2] == (s[1], s[2])]
    out = []
    for (text, start, end, gold), (other, a, b, more) in zip(alone[::2], alone[1::2]):
        shift = end + 1 - a
        out.append((text[:end] + " " + other[a:], start, b + shift, [*gold, (a + shift, b + shift, more[0][2])]))
    return out


def train(samples: list[tuple[str, int, int, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> dict[str, float]:
    """Maximum likelihood by stochastic gradient steps.  ``samples``: text,
    start and end of a stretch, and the labelled spans inside."""
    weights: dict[str, float] = {}
    lattices = []
    for text, start, end, gold in [v for sample in samples + neighbours(samples) for v in variants(*sample)]:
        lattice = Lattice(text, start, end)
        wanted = {(s, e): KINDS[k] for s, e, k in gold}
        inside = [wanted_span for wanted_span in wanted]
        truth = []
        for n, (i, j, kind, _) in enumerate(lattice.edges):
            s, e = lattice.cuts[i], lattice.cuts[j]
            if kind and wanted.get((s, e)) == kind:
                truth.append(n)
            elif not kind and not any(a < e and s < b for a, b in inside):
                truth.append(n)
        if len(lattice.edges) <= 4000:
            lattices.append((lattice, truth))
    rng = np.random.default_rng(7)
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for at in rng.permutation(len(lattices)).tolist():
            lattice, truth = lattices[at]
            score = scores(lattice, weights)
            ahead, back = lattice.sums(score)
            total = ahead[lattice.n]
            step: dict[str, float] = {}
            for n in truth:
                for f in lattice.edges[n][3]:
                    step[f] = step.get(f, 0.0) + 1.0
            for (i, j, _, feats), s in zip(lattice.edges, score):
                p = math.exp(min(0.0, ahead[i] + s + back[j] - total))
                if p > 1e-6:
                    for f in feats:
                        step[f] = step.get(f, 0.0) - p
            for f, g in step.items():
                weights[f] = weights.get(f, 0.0) * (1 - 1e-4) + rate * g
    return weights


def added_spans(text: str, base: list[tuple[int, int, int]], weights: dict[str, float],
                least: float = LEAST) -> list[tuple[int, int, int]]:
    """Segments of the best cutting that touch no base span and have marginal
    probability ``least`` or more."""
    out = []
    for start, end in stretches(text):
        lattice = Lattice(text, start, end)
        if len(lattice.edges) == lattice.n:
            continue
        score = scores(lattice, weights)
        path = [e for e in lattice.best(score) if lattice.edges[e][2]]
        if not path:
            continue
        ahead, back = lattice.sums(score)
        for e in path:
            i, j, kind, _ = lattice.edges[e]
            s, t = lattice.cuts[i], lattice.cuts[j]
            p = math.exp(min(0.0, ahead[i] + score[e] + back[j] - ahead[lattice.n]))
            if p >= least and not any(a < t and s < b for a, b, _ in base):
                out.append((s, t, KINDS.index(kind)))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_stretches: int = SAMPLE_STRETCHES) -> dict[str, float]:
    """Weights learned from at most ``sample_stretches`` stretches of about
    ``sample_docs`` documents, both chosen by id hash, labelled by the base
    patterns."""
    n = docs.count()
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.lit(9))
    chosen = docs.where(drawn(hashed, sample_docs / max(n, 1))).select("doc_id", "text")

    def cut(frames):
        for pdf in frames:
            rows = []
            for key, text in zip(pdf["doc_id"], pdf["text"]):
                if not isinstance(text, str):
                    continue
                base = base_spans(text)
                for s, e in stretches(text):
                    if e - s > 400:
                        continue
                    gold = [b for b in base if s <= b[0] and b[1] <= e]
                    if any(a[0] < b[1] and b[0] < a[1] for i, a in enumerate(gold) for b in gold[:i]):
                        continue
                    lo = max(0, s - 2)
                    rows.append((key if key == key else -1, s, text[lo:e + 2], s - lo, e - lo,
                                 ",".join(f"{k}:{a - lo}:{b - lo}" for a, b, k in gold)))
            yield pd.DataFrame(rows, columns=["doc_id", "at", "piece", "s", "e", "gold"])

    pieces = chosen.mapInPandas(cut, "doc_id double, at long, piece string, s long, e long, gold string")
    # labelled stretches first: they are rarer than other numbers
    rank = [F.col("gold") == "", F.xxhash64("piece"), "piece", "gold", "s", "e"]
    half = sample_stretches // 2
    rows = pieces.where("gold != ''").orderBy(*rank).limit(half).collect() \
        + pieces.where("gold = ''").orderBy(*rank).limit(half).collect()
    samples = []
    for r in rows:
        gold = [tuple(map(int, g.split(":"))) for g in r["gold"].split(",") if g]
        samples.append((r["piece"], r["s"], r["e"], [(a, b, k) for k, a, b in gold]))
    return train(samples)


def find(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (all).

    One pass without a shuffle.  A null text is empty: no spans, the digest
    of the empty string.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in tb.slices(batches):
            counts, digests, listed = [], [], []
            for text in b.column("text").to_pylist():
                base = base_spans(text) if text else []
                counts.append([sum(s[2] == k for s in base) for k in range(len(KINDS))])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                more = added_spans(text, base, shared.value) if text and _HINT.search(text) else []
                listed.append(joined(base + more))
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(table[:, k]) for k in range(len(KINDS))), pa.array(digests, pa.string()),
                 pa.array(listed, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def op9(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of documents."""
    return find(docs, fit(docs))
