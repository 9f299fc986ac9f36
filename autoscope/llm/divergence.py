"""Divergence audit of sources: how each source of a language departs from the
language's other sources and from the language as a whole, term by term.

In-mapper stripes: a task folds whole documents into a hash of stripes, one a
(language, term), each with the term's document frequency and its count by
source.  When the hash holds ``SPILL_ENTRIES`` counts it is handed to the
shuffle and begun anew, so memory is bounded whatever a task reads, and a term
costs a task few rows however often it occurs.  Stripes are merged by key;
those of too rare terms end there.  Each merged stripe then emits its
divergences directly: its part of every pair of sources, summed inside the task,
and its place among a source's ``TOP`` most over-represented terms.

All arithmetic is on integers: shares are in billionths of smoothed counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize

from . import textbytes as tb
from .wordids import column_words

MIN_DOCS = 30
TOP = 50
SMOOTH = 5
SCALE_STEPS = 3  # shares are in 1000 ** 3 parts
SPILL_ENTRIES = 150_000
#: sources of a language whose pairs are summed in one pass (8 MB a task)
TILE = 1024
#: cells of pair sums that a task holds over all languages
HELD_CELLS = 1 << 21
#: counts of kept stripes that one task emits from: a task gives a row for
#: every pair of sources, so tasks must not be many for few stripes
EMIT_ENTRIES = 250_000
#: cells of the (term, source) block that is worked on at a time
CELLS = 1 << 19
#: ASCII letters (lower-cased) and every byte of a non-ASCII character
TERM = tb.LETTERISH
STRIPE = "lang string, term string, counts array<struct<source:string,n:long>>"


# ---- stripes ----------------------------------------------------------------

def _spilled(stripes: dict, langs: list[str], sources: list[str]) -> pa.RecordBatch:
    """Stripes as rows; the entry without a source is the document frequency."""
    sizes = np.fromiter(map(len, stripes.values()), np.int32, len(stripes))
    who = np.fromiter((s for stripe in stripes.values() for s in stripe), np.int32)
    n = np.fromiter((c for stripe in stripes.values() for c in stripe.values()), np.int64)
    names = pa.array(sources, pa.string()).take(pa.array(who, mask=who < 0))
    entries = pa.StructArray.from_arrays([names, pa.array(n)], ["source", "n"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), entries)
    lang = pa.array(langs, pa.string()).take(pa.array([k[0] for k in stripes], pa.int32()))
    term = pa.array([k[1] for k in stripes], pa.binary()).cast(pa.string())
    return pa.record_batch([lang, term, lists], names=["lang", "term", "counts"])


def _number(values: pa.Array, known: dict[str, int]) -> np.ndarray:
    """A number for each value, the same in the whole task."""
    coded = values.dictionary_encode()
    numbers = np.array([known.setdefault(v, len(known)) for v in coded.dictionary.to_pylist()], np.int64)
    return numbers[coded.indices.to_numpy()] if len(values) else np.zeros(0, np.int64)


def _fold(batches, spill: int) -> Iterator[pa.RecordBatch]:
    langs: dict[str, int] = {}
    sources: dict[str, int] = {}
    stripes: dict[tuple[int, bytes], dict[int, int]] = {}
    held = 0
    for batch in tb.slices(batches):
        lang, source = _number(batch.column(0), langs), _number(batch.column(1), sources)
        for w in column_words(batch.column(2), TERM):
            size = len(w.first)
            # a document's terms once each, then the terms of each (language, source)
            each, count = np.unique(w.row() * size + w.ids, return_counts=True)
            row, term = each // max(size, 1) + w.lo, each % max(size, 1)
            key = (lang[row] * len(sources) + source[row]) * size + term
            group, which = np.unique(key, return_inverse=True)
            n = np.bincount(which, weights=count).astype(np.int64).tolist()
            docs = np.bincount(which).tolist()
            pair, term = group // max(size, 1), (group % max(size, 1)).tolist()
            text, head, tail = w.buf.tobytes(), w.starts[w.first].tolist(), w.ends[w.first].tolist()
            words = [text[s:e] for s, e in zip(head, tail)]
            for g, s, t, c, d in zip((pair // len(sources)).tolist(), (pair % len(sources)).tolist(), term, n, docs):
                stripe = stripes.get((g, words[t]))
                if stripe is None:
                    stripe = stripes[g, words[t]] = {-1: 0}
                    held += 1
                stripe[-1] += d
                if s in stripe:
                    stripe[s] += c
                else:
                    stripe[s] = c
                    held += 1
            if held >= spill:
                yield _spilled(stripes, list(langs), list(sources))
                stripes, held = {}, 0
    if stripes:
        yield _spilled(stripes, list(langs), list(sources))


def kept_stripes(docs: DataFrame, min_docs: int = MIN_DOCS, spill: int = SPILL_ENTRIES) -> DataFrame:
    """lang, term, counts (source, n) of the terms that at least ``min_docs``
    documents of the language hold; null columns are empty text."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    entries = texts.mapInArrow(lambda batches: _fold(batches, spill), STRIPE).repartition("lang", "term").select(
        "lang", "term", F.explode("counts").alias("e"))
    merged = entries.groupBy("lang", "term", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("n"))
    return merged.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("docs"),
        F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n"))).alias("counts"),
    ).where(F.col("docs") >= min_docs).select("lang", "term", "counts")


# ---- divergences ------------------------------------------------------------

def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * count / total) in exact integers, for count <= total
    < 9 * 10**15: long division by steps of 1000."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


class _Lang:
    """Divergences of one language, for the sources of stretch a against
    those of stretch b, each ``width`` long; terms only with the first b."""

    def __init__(self, name: str, sources: dict[str, int], terms: int, tile: tuple[int, int], width: int):
        self.name, self.names = name, list(sources)
        self.place = {s: i for i, s in enumerate(self.names)}
        totals = np.array(list(sources.values()), np.int64)
        self.total = totals + SMOOTH * terms
        self.all = int(totals.sum()) + SMOOTH * terms
        self.a, self.b = (range(len(sources))[k * width:(k + 1) * width] for k in tile)
        self.pairs = np.zeros((len(self.a), len(self.b)), np.int64)
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in self.a]
        self.terms_too = tile[1] == 0

    def add(self, terms: list[str], offsets: np.ndarray, who: np.ndarray, n: np.ndarray) -> None:
        step = max(1, CELLS // max(1, len(self.a) + len(self.b)))
        for lo in range(0, len(terms), step):
            hi = min(lo + step, len(terms))
            part = slice(offsets[lo], offsets[hi])
            row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
            counts, p = self._shares(row, who[part], n[part], hi - lo, self.a)
            q = p if self.b == self.a else self._shares(row, who[part], n[part], hi - lo, self.b)[1]
            for i in range(len(self.a)):
                self.pairs[i] += np.abs(q - p[:, i:i + 1]).sum(axis=0)
            if self.terms_too:
                whole = np.zeros(hi - lo, np.int64)
                np.add.at(whole, row, n[part])
                self._terms(terms[lo:hi], counts, p, shares(whole + SMOOTH, np.int64(self.all)))

    def _shares(self, row, who, n, size, sources):
        counts = np.zeros((size, len(sources)), np.int64)
        own = (who >= sources.start) & (who < sources.stop)
        counts[row[own], who[own] - sources.start] = n[own]
        return counts, shares(counts + SMOOTH, self.total[sources.start:sources.stop])

    def _terms(self, terms, counts, p, q):
        over = np.where(counts > 0, p - q[:, None], 0)
        for i, best in enumerate(self.best):
            value = over[:, i]
            there = np.flatnonzero(value > 0)
            if len(there) > TOP:  # ties with the last place stay in until terms decide
                there = there[value[there] >= np.partition(value[there], len(there) - TOP)[len(there) - TOP]]
            best += [(-int(value[t]), terms[t].encode()) for t in there.tolist()]
            best.sort()
            del best[TOP:]

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = np.array(self.names, object)
        for i, g in enumerate(self.a):
            others = [j for j in range(len(self.b)) if self.b[j] != g]
            yield self._batch(g, "pair", names[[self.b[j] for j in others]].tolist(), self.pairs[i, others])
            if self.terms_too and self.best[i]:
                yield self._batch(g, "term", [t.decode() for _, t in self.best[i]], np.array([-v for v, _ in self.best[i]]))

    def _batch(self, g: int, part: str, items: list[str], values: np.ndarray) -> pa.RecordBatch:
        n = len(items)
        return pa.record_batch([pa.array([self.name] * n, pa.string()), pa.array([self.names[g]] * n, pa.string()),
                                pa.array([part] * n, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())],
                               names=["lang", "source", "part", "item", "value"])


def _emitter(groups: dict[str, dict[str, int]], terms: dict[str, int], tile: tuple[int, int], width: int):
    """Task function: kept stripes (those of a language near each other) to
    divergences, one row a pair of sources and task unless languages have so
    many that ``HELD_CELLS`` is not enough for those of a task."""
    def emit(batches):
        open_langs: dict[str, _Lang] = {}
        for batch in tb.slices(batches, 4096):
            lang, term = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            entries = lists.values
            source, n = entries.field("source").to_pylist(), entries.field("n").to_numpy()
            at = 0
            while at < len(lang):
                now = open_langs.get(lang[at])
                if now is None:
                    now = _Lang(lang[at], groups[lang[at]], terms[lang[at]], tile, width)
                    if now.pairs.size + sum(x.pairs.size for x in open_langs.values()) > HELD_CELLS:
                        for x in open_langs.values():
                            yield from x.rows()
                        open_langs.clear()
                    open_langs[now.name] = now
                end = at + 1
                while end < len(lang) and lang[end] == now.name:
                    end += 1
                part = slice(offsets[at], offsets[end])
                who = np.array([now.place[s] for s in source[part]], np.int64)
                now.add(term[at:end], offsets[at:end + 1] - offsets[at], who, n[part])
                at = end
        for x in open_langs.values():
            yield from x.rows()

    return emit


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, spill: int = SPILL_ENTRIES, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: item is each other source of the language, value the summed
    difference of their shares over all kept terms.  ``term``: item is a
    kept term that the source has more often than the language, value the
    difference, up to rank ``top`` (``TOP`` at most).  A rank counts from 1 in
    each (lang, source, part), values descending, items ascending.

    Null lang, source and text are empty text; rows repeated in the table
    are documents of their own.  A language without a kept term has its pairs
    with value 0; a source alone in its language has none.  An empty table
    gives no rows.  The groups (one a language and source) pass through the driver:
    the result holds a row for every two of them.
    """
    spark = docs.sparkSession
    kept = materialize(kept_stripes(docs, min_docs, spill).sortWithinPartitions("lang"), "stripes")
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.select("lang", F.explode("counts").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("n"))
    groups: dict[str, dict[str, int]] = {}
    for r in found.join(sums, ["lang", "source"], "left").orderBy("lang", "source").toLocalIterator():
        groups.setdefault(r["lang"], {})[r["source"]] = r["n"] or 0
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.size("counts")).alias("entries")).collect()
    terms, tasks = {r["lang"]: r["n"] for r in sizes}, -(-sum(r["entries"] for r in sizes) // EMIT_ENTRIES)
    tiles = -(-max(map(len, groups.values()), default=0) // tile)
    schema = "lang string, source string, part string, item string, value long"
    g, h = found.alias("g"), found.alias("h")
    parts = g.join(h, (F.col("g.lang") == F.col("h.lang")) & (F.col("g.source") != F.col("h.source"))).select(
        "g.lang", "g.source", F.lit("pair").alias("part"), F.col("h.source").alias("item"), F.lit(0).cast("long").alias("value"))
    for a in range(tiles):  # one pass, but for languages of more than ``tile`` sources
        for b in range(tiles):
            parts = parts.union(kept.coalesce(max(1, tasks)).mapInArrow(_emitter(groups, terms, (a, b), tile), schema))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= min(top, TOP)))


def op13(docs: DataFrame) -> DataFrame:
    return audit(docs)


#: DuckDB: the dense (kept term, source) table
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT n, lang, source, term, count(*) AS c FROM (SELECT n, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY ALL HAVING count(*) >= 30),
grp AS (SELECT DISTINCT lang, source FROM d),
dense AS MATERIALIZED (SELECT lang, source, term, coalesce(sum(c), 0)::HUGEINT AS c FROM kept JOIN grp USING (lang)
    LEFT JOIN t USING (lang, source, term) GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, c, (1 + 1000000000 * (c + 5) // (sum(c) OVER g + 5 * count(*) OVER g))::BIGINT AS p
    FROM dense WINDOW g AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, (1 + 1000000000 * (c + 5) // (sum(c) OVER l + 5 * count(*) OVER l))::BIGINT AS q
    FROM (SELECT lang, term, sum(c) AS c FROM dense GROUP BY ALL) WINDOW l AS (PARTITION BY lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(r AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM rows)
WHERE part = 'pair' OR r <= 50
"""
