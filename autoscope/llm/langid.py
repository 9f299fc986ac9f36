"""Language identification by segmentation-marginalised unigrams.

Every language has one probability per piece of a fixed public vocabulary.
A word's probability under a language is the sum over all ways of cutting it
into pieces, which a forward pass over its bytes computes.  The piece
probabilities are trained per language by expectation maximisation on a
bounded sample of labelled documents; prediction reads every whole text.

Words are runs of letters (ASCII letters lower-cased, all bytes of non-ASCII
characters), each with a leading blank.  Each distinct word of a batch is
scored once, so a text costs little more than hashing its words.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import bounded, id_remainder

UNKNOWN = "und"
#: expected labelled documents per language that training may read (a documented bound)
SAMPLE_PER_LANG = 300
EM_ROUNDS = 4
SMOOTHING = 0.1
SLOT_BITS = 20
CACHE_BITS = 17
#: bytes of a run that are scored with others in one matrix; longer runs (texts
#: without spaces, encoded data) go one by one, at a cost linear in their length
LONG_RUN = 96
#: training cuts longer runs into stretches of at most so many bytes
TRAIN_RUN = 64
_LETTER = regex.compile(r"\p{L}")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_pieces(path: str) -> list[bytes]:
    """Pieces that can occur in a lower-cased word with its leading blank:
    letters only, the blank only in front; single bytes are always there."""
    word = regex.compile(rb" ?[a-z\x80-\xff]*")
    with open(path, "rb") as f:
        listed = (base64.b64decode(line.split()[0]) for line in f if line.strip())
        pieces = {p for p in listed if word.fullmatch(p)}
    pieces |= {bytes([b]) for b in range(256) if tb.LETTERISH[b] or b == tb.SPACE}
    return sorted(pieces)


class Vocabulary:
    """Piece lookup by span hash: two direct-mapped tables, the second for
    pieces whose slot in the first is taken, the rest by binary search."""

    def __init__(self, path: str):
        self.pieces = read_pieces(path)
        self.size, self.longest = len(self.pieces), max(map(len, self.pieces))
        joined = np.frombuffer(b"".join(self.pieces), np.uint8)
        ends = np.cumsum([len(p) for p in self.pieces])
        starts = np.r_[0, ends[:-1]]
        self.key = np.r_[tb.span_hashes(tb.prefix_sums(joined), starts, ends), np.uint64(0)]
        self.tables, rest = [], np.arange(self.size)
        for shift in (64 - SLOT_BITS, 64 - 2 * SLOT_BITS):
            t = np.full(1 << SLOT_BITS, self.size, np.int32)
            slot = (self.key[rest] >> np.uint64(shift)) & np.uint64((1 << SLOT_BITS) - 1)
            t[slot] = rest
            self.tables.append((shift, t))
            rest = rest[t[slot] != rest]
        self.rest = rest

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash's piece; ``size`` where there is none."""
        found = np.full(len(h), self.size, np.int32)
        for shift, t in self.tables:
            at = t[(h >> np.uint64(shift)) & np.uint64((1 << SLOT_BITS) - 1)]
            hit = self.key[at] == h
            found[hit] = at[hit]
        for i in self.rest:
            found[h == self.key[i]] = i
        return found


def vocabulary(path: str) -> Vocabulary:
    return tb.held("langid", path, lambda: Vocabulary(path))


def letter_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: rows lo..hi, lower-cased bytes, word starts and ends, and
    the bounds of each row's words."""
    for lo, hi, buf, rows in tb.chunks(column, tb.SMALL_CHUNK):
        buf = tb.LOWER[buf]
        starts, ends = tb.spans(buf, tb.LETTERISH)
        yield lo, hi, buf, starts, ends, tb.per_row(rows, starts)


def word_block(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words as rows of a byte matrix with a leading blank, and lengths."""
    n = ends - starts + 1
    width = int(n.max())
    m = np.full((len(n), width), tb.SPACE, np.uint8)
    at = starts[:, None] + np.arange(width - 1)
    inside = at < ends[:, None]
    m[:, 1:][inside] = buf[at[inside]]
    return m, n


def blocks_of(starts: np.ndarray, ends: np.ndarray, cells: int = 1 << 17) -> Iterator[np.ndarray]:
    """Word indexes by rising length in blocks of bounded matrix size."""
    n = ends - starts + 1
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        take = max(1, cells // int(n[order[at]]))
        block = order[at:at + take]
        longest = int(n[block[-1]])
        while len(block) > 1 and longest * len(block) > 2 * cells:
            block = block[:len(block) // 2]
            longest = int(n[block[-1]])
        yield block
        at += len(block)


def arcs(voc: Vocabulary, m: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(end, length, words, pieces): pieces that end at byte ``end`` of words."""
    width = m.shape[1]
    c = np.zeros((len(m), width + 1), np.uint64)
    np.cumsum(tb.BYTE_CODE[m] * tb.powers(tb._P, width), axis=1, out=c[:, 1:])
    inverse = tb.powers(tb._P_INV, width + 1)
    for end in range(1, width + 1):
        live = np.flatnonzero(n >= end)
        for length in range(1, min(end, voc.longest) + 1):
            h = (c[live, end] - c[live, end - length]) * inverse[end - length]
            piece = voc.find(h)
            hit = piece < voc.size
            if hit.any():
                yield end, length, live[hit], piece[hit]


def forward(voc: Vocabulary, prob: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language: the sum over all
    segmentations.  ``prob`` is (pieces, languages)."""
    words, langs = len(m), prob.shape[1]
    keep = voc.longest + 1
    ring = np.zeros((keep, words, langs))
    ring[0] = 1.0
    scale = np.zeros((words, langs))
    out = np.zeros((words, langs))
    at = 0

    def close(end: int) -> None:
        done = n == end
        if done.any():
            out[done] = np.log(ring[end % keep][done]) + scale[done]
        if end % 16 == 0:  # keep the numbers in range on long words
            top = ring.max(axis=0)
            top[top <= 0] = 1.0
            np.divide(ring, top, out=ring)
            scale[...] += np.log(top)

    for end, length, word, piece in arcs(voc, m, n):
        while at < end:
            if at:
                close(at)
            at += 1
            ring[at % keep] = 0.0
        ring[end % keep, word] += ring[(end - length) % keep, word] * prob[piece]
    while at <= m.shape[1]:
        if at:
            close(at)
        at += 1
        if at <= m.shape[1]:
            ring[at % keep] = 0.0
    return out


def forward_long(voc: Vocabulary, prob: np.ndarray, word: np.ndarray, ends: int = 2048) -> np.ndarray:
    """``forward`` of one word (bytes with the blank in front): the pieces of
    ``ends`` end positions are looked up at once, then one step a byte."""
    reach, langs = voc.longest, prob.shape[1]
    known = np.vstack([prob, np.zeros(langs)])  # no piece, no probability
    alpha = np.zeros((reach + ends, langs))  # the last ``reach`` sums come first
    alpha[reach - 1] = 1.0
    scale = np.zeros(langs)
    back = np.arange(reach, 0, -1)  # piece lengths, longest first
    for at in range(0, len(word), ends):
        lo = max(0, at - reach)
        c = tb.prefix_sums(word[lo:at + ends])
        end = np.arange(at + 1, min(at + ends, len(word)) + 1) - lo
        start = end[:, None] - back
        inside = start >= 0
        start = np.maximum(start, 0)
        h = (c[end][:, None] - c[start]) * tb.powers(tb._P_INV, len(c))[start]
        piece = np.where(inside, voc.find(h.ravel()).reshape(h.shape), voc.size)
        p = known[piece]
        for i in range(len(end)):
            alpha[reach + i] = (alpha[i:reach + i] * p[i]).sum(axis=0)
            if i % 16 == 15:  # keep the numbers in range
                top = alpha[i:reach + i + 1].max(axis=0)
                top[top <= 0] = 1.0
                alpha[i:reach + i + 1] /= top
                scale += np.log(top)
        alpha[:reach] = alpha[len(end):reach + len(end)].copy()
    return np.log(alpha[reach - 1]) + scale


def train_pieces(voc: Vocabulary, texts: list[str], rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation."""
    column = pa.array([t or "" for t in texts], pa.large_string())
    words: dict[bytes, int] = {}
    for _, _, buf, starts, ends, _ in letter_words(column):
        raw = buf.tobytes()
        for s, e in zip(starts.tolist(), ends.tolist()):
            while s < e:
                cut = e if e - s <= TRAIN_RUN else s + TRAIN_RUN
                while cut < e and raw[cut] & 0xC0 == 0x80:  # between characters
                    cut -= 1
                w = raw[s:cut]
                words[w] = words.get(w, 0) + 1
                s = cut
    listed = sorted(words)
    joined = np.frombuffer(b"".join(listed), np.uint8)
    ends = np.cumsum([len(w) for w in listed], dtype=np.int64)
    starts = np.r_[0, ends[:-1]].astype(np.int64) if len(listed) else ends
    times = np.array([words[w] for w in listed], float)
    graphs = []
    for block in blocks_of(starts, ends, 1 << 20):
        m, n = word_block(joined, starts[block], ends[block])
        graphs.append((times[block], n, list(arcs(voc, m, n))))
    prob = np.full(voc.size, 1.0 / voc.size)
    for _ in range(rounds):
        counts = np.full(voc.size, SMOOTHING)
        for weight, n, edges in graphs:
            width = int(n.max())
            alpha = np.zeros((len(n), width + 1))
            alpha[:, 0] = 1.0
            shift = np.zeros((len(n), width + 1))  # log of what alpha[:, j] was divided by
            by_end: dict[int, list] = {}
            for e in edges:
                by_end.setdefault(e[0], []).append(e)
            for end in range(1, width + 1):
                # every earlier column enters relative to the column before
                for _, length, word, piece in by_end.get(end, []):
                    rel = np.exp(shift[word, end - length] - shift[word, end - 1])
                    alpha[word, end] += alpha[word, end - length] * rel * prob[piece]
                top = np.where(alpha[:, end] > 0, alpha[:, end], 1.0)
                alpha[:, end] /= top
                shift[:, end] = shift[:, end - 1] + np.log(top)
            beta = np.zeros((len(n), width + 1))
            back = np.zeros((len(n), width + 1))
            beta[np.arange(len(n)), n] = 1.0
            for end in range(width, 0, -1):
                # beta[:, end] is complete once all later arcs were spread
                top = np.where(beta[:, end] > 0, beta[:, end], 1.0)
                beta[:, end] /= top
                back[:, end] += np.log(top)
                for _, length, word, piece in by_end.get(end, []):
                    start = end - length
                    first = (back[word, start] == 0) & (beta[word, start] == 0)
                    back[word[first], start] = back[word[first], end]
                    rel = np.exp(np.clip(back[word, end] - back[word, start], -700, 700))
                    beta[word, start] += beta[word, end] * rel * prob[piece]
            total = shift[np.arange(len(n)), n]
            for end, length, word, piece in edges:
                start = end - length
                log_mass = shift[word, start] + back[word, end] - total[word]
                mass = alpha[word, start] * beta[word, end] * prob[piece] * np.exp(np.clip(log_mass, -700, 700))
                counts += np.bincount(piece, weights=mass * weight[word], minlength=voc.size)
        prob = counts / counts.sum()
    return prob


@dataclass
class Model:
    languages: list[str]
    prob: np.ndarray  # (pieces, languages)
    vocabulary: str

    def __post_init__(self):
        digest = hashlib.sha256(self.prob.tobytes()).hexdigest()
        self.key = f"{self.vocabulary} {self.languages} {digest}"


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, vocabulary_path: str | None = None) -> Model:
    """Train on about ``per_lang`` documents of each language.

    Reads ``doc_id, text, lang`` of rows whose id remainder by 3 is not 1 and
    whose lang is not null.  The sample is chosen by id hash against each
    language's row count; the counts come from all rows.  What reaches the
    driver is one probability vector per language.
    """
    path = vocabulary_path or default_vocabulary()
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder(F.col("doc_id"), 3) != 1))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    rate = F.lit(float(per_lang)) / F.col("n")
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = (rows.join(bounded(sizes), "lang").where(draw < rate)
              .select("lang", "text"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        prob = train_pieces(vocabulary(path), pdf["text"].tolist())
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "prob": [prob.tobytes()]})

    learned = sorted((r["lang"], r["prob"]) for r in
                     sample.groupBy("lang").applyInPandas(learn, "lang string, prob binary").collect())
    prob = np.array([np.frombuffer(p) for _, p in learned]).T if learned else np.zeros((0, 0))
    return Model([k for k, _ in learned], np.ascontiguousarray(prob), path)


def score_column(model: Model, column: pa.Array) -> tuple[list[str], list[float]]:
    """Predicted language and its posterior probability for each text."""
    count = len(column)
    if not model.languages:
        return [UNKNOWN] * count, [0.0] * count
    voc = vocabulary(model.vocabulary)
    cache = tb.held("langid", model.key, lambda: tb.WordCache(CACHE_BITS, len(model.languages)))
    total = np.zeros((count, len(model.languages)))
    n_words = np.zeros(count, np.int64)
    ascii_letter = np.zeros(count, bool)
    for lo, hi, buf, starts, ends, bounds in letter_words(column):
        if not len(starts):
            continue
        letters = np.r_[0, np.cumsum((buf >= 97) & (buf <= 122))]
        in_words = np.r_[0, np.cumsum(letters[ends] > letters[starts])]
        ascii_letter[lo:hi] = in_words[bounds[1:]] > in_words[bounds[:-1]]

        def word_logs(first: np.ndarray) -> np.ndarray:
            logs = np.empty((len(first), len(model.languages)))
            head, tail = starts[first], ends[first]
            short = np.flatnonzero(tail - head <= LONG_RUN)
            for block in blocks_of(head[short], tail[short]):
                block = short[block]
                logs[block] = forward(voc, model.prob, *word_block(buf, head[block], tail[block]))
            for i in np.flatnonzero(tail - head > LONG_RUN).tolist():
                logs[i] = forward_long(voc, model.prob, np.r_[np.uint8(tb.SPACE), buf[head[i]:tail[i]]])
            return logs

        h = tb.mix(tb.span_hashes(tb.prefix_sums(buf), starts, ends))
        run = np.zeros((len(starts) + 1, len(model.languages)))
        np.cumsum(cache.get(h, word_logs), axis=0, out=run[1:])
        total[lo:hi] = run[bounds[1:]] - run[bounds[:-1]]
        n_words[lo:hi] = bounds[1:] - bounds[:-1]
    best = total.argmax(axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    score = odds.max(axis=1) / odds.sum(axis=1)
    lang, out = [], []
    for i in range(count):
        # a run of non-ASCII bytes may be symbols only
        if n_words[i] == 0 or not (ascii_letter[i] or _LETTER.search(column[i].as_py())):
            lang.append(UNKNOWN)
            out.append(0.0)
        else:
            lang.append(model.languages[best[i]])
            out.append(float(score[i]))
    return lang, out


def predict(docs: DataFrame, model: Model, pass_through: list[str]) -> DataFrame:
    """``pass_through`` columns of docs plus lang_pred and score.

    A null text or one without a letter is ``und`` with score 0.  One pass,
    no shuffle; ties between languages go to the first by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = docs.select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(pass_through)], F.col("text").alias("t"))
    schema = ", ".join(f"p{i} {f.dataType.simpleString()}" for i, f in
                       enumerate(docs.select(*pass_through).schema.fields))

    def run(batches):
        for b in tb.slices(batches):
            lang, score = score_column(shared.value, b.column("t"))
            kept = [b.column(f"p{i}") for i in range(len(pass_through))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*[f"p{i}" for i in range(len(pass_through))], "lang_pred", "score"])

    out = inner.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(f"p{i}").alias(c) for i, c in enumerate(pass_through)], "lang_pred", "score")


def op7(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of documents."""
    held = id_remainder(F.col("doc_id"), 3) == 1
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    return predict(rows, fit(docs), ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose language is known with posterior ``least`` or more; all
    columns of ``docs`` as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of any kind
    text = docs.columns.index("text")

    def run(batches):
        for b in tb.slices(batches):
            lang, score = score_column(shared.value, b.column(text))
            keep = [k != UNKNOWN and s >= least for k, s in zip(lang, score)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
