"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII
characters.  A window is ``WINDOW`` consecutive words of a benchmark item, or
the whole item if it has fewer.  Fingerprints of whole windows are the least
hashes of ``GRAM`` words in every run of neighbouring ones, so any shared
window holds a fingerprint at the same place in both texts.  Fingerprints are
joined, and each match is extended word by word in both directions; a match
that reaches a whole window is a hit.

An item of fewer words is one gram of its own length, in a class by that
length, and meets the documents' grams of the same length.  It changes nothing
for longer items.

Texts are split into words once.  While the benchmark's fingerprints can be
broadcast, a document's words around a fingerprint are only looked at where it
matches; beyond that each fingerprint carries the few words that an extension
can need, so that whole texts are never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize

from .common import bounded

WINDOW = 10
GRAM = 5
#: benchmark fingerprints that may be broadcast (about 50 MB)
BROADCAST_FINGERPRINTS = 200_000
# fixed values: the ASCII characters that are in no word, and the letters to lower-case
_BREAKS = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Every break becomes a blank; splitting there is far cheaper than
    matching words by a regular expression."""
    plain = F.translate(F.coalesce(text, F.lit("")), _BREAKS + _UPPER, " " * len(_BREAKS) + _LOWER)
    return F.array_remove(F.split(plain, " "), "")


def fingerprints(rows: DataFrame, needs: list[int], header: bool = False) -> DataFrame:
    """``rows`` (any columns and ``words``) to one row per fingerprint:
    ``need`` its class (the window's length), ``p`` the first word's index,
    ``h`` its hash.  Rows of fewer than ``need`` words have none of a class.
    With ``header``, each row comes once more with a null ``need``, and a hash
    that spreads these rows.

    One row per run (one per gram in the classes of short items) is exploded and most are
    filtered at once, in generated code; a lambda would be interpreted."""
    kept = rows.columns
    rows = rows.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    runs = [F.array(F.lit(-1).cast("long"))] if header else []
    for need in needs:
        k = GRAM if need == WINDOW else need
        rows = rows.withColumn(f"g{need}", F.when(F.size("words") >= need, F.transform(
            F.sequence(F.lit(0), F.size("words") - k), _gram_at(k))))
        # a class and a place in one number: the place itself for whole windows
        base, number = (0 if need == WINDOW else need << 32), F.size("words") - need
        runs.append(F.when(number >= 0, F.sequence(F.lit(base).cast("long"), base + number.cast("long"))).otherwise(
            F.array().cast("array<bigint>")))
    rows, at = rows.withColumn("at", F.explode(F.concat(*runs))), F.col("at")
    place, h = F.greatest(at, F.lit(0)).bitwiseAND(0x7FFFFFFF).cast("int"), F.xxhash64(*[c for c in kept if c != "words"])
    need = F.shiftright(at, 32).cast("int")
    for n in needs:
        if n < WINDOW:
            h = F.when(need == n, F.get(f"g{n}", place)).otherwise(h)
    if WINDOW in needs:
        # by place, not at: both sides of | may be computed, and a class in at is more than an int holds
        grams, whole = [F.get(f"g{WINDOW}", place + j) for j in range(-1, WINDOW - GRAM + 1)], (at >= 0) & (at < 1 << 32)
        least = F.least(*grams[1:])
        # the least (of equal ones the first) is not that of the run before
        rows = rows.where(~whole | (at == 0) | (grams[0] <= least) | (grams[-1] < F.least(*grams[1:-1])))
        place = F.when(whole, place + F.array_position(F.slice(f"g{WINDOW}", place + 1, WINDOW - GRAM + 1), least).cast("int") - 1).otherwise(place)
        h = F.when(whole, least).otherwise(h)
    return rows.select(*kept, F.when(at >= 0, F.when(need == 0, WINDOW).otherwise(need)).alias("need"), place.alias("p"), h.alias("h"))


def _gram_at(k: int):
    return lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(k)])


def _before() -> Column:
    return F.when(F.col("need") == WINDOW, F.least(F.col("p"), F.lit(WINDOW - GRAM))).otherwise(0)


def around(rows: DataFrame) -> DataFrame:
    """Fingerprints with ``near``, the words that an extension can need, in
    place of ``words``."""
    return rows.withColumn("near", F.slice("words", F.col("p") - _before() + 1, _before() + F.coalesce("need", F.lit(0)))).drop("words")


def sides(rows: DataFrame) -> DataFrame:
    """``near`` as ``left``, the words before a fingerprint, nearest first, and
    ``right``, those from it on."""
    return rows.withColumns({"left": F.reverse(F.slice("near", 1, _before())),
                             "right": F.slice("near", _before() + 1, F.coalesce("need", F.lit(0)))}).drop("near")


def common_start(a: Column, b: Column) -> Column:
    """Number of equal elements from the start of two arrays."""
    same = F.zip_with(a, b, lambda x, y: x.isNotNull() & x.eqNullSafe(y))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def scan(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, known).  ``found``: per row of ``docs`` one with a null ``ctx``
    (doc_id, th the text hash, n_words), and one per hit: ctx, and p, l, r,
    where the words [p - l, p + r) are those of a benchmark passage.
    ``known``: the items of each ctx.  One pass over the texts."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words(F.col("text")).alias("words"))
    size = items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("size"), "item", "words")
    needs = sorted(r[0] for r in size.select("size").distinct().collect() if r[0])  # ten values at most
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    if not needs:
        plain = rows.select("doc_id", "th", "n_words", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("ctx", "long"), ("p", "int"), ("l", "int"), ("r", "int"))])
        return plain, items.select(F.lit(0).cast("long").alias("ctx"), "item").limit(0)
    # an item belongs to the class of its size alone
    marks = sides(around(fingerprints(size, needs).where(F.col("need") == F.col("size"))))
    known = materialize(marks.select("h", "left", "right", "need", "item").distinct()
                        .withColumn("ctx", F.xxhash64("h", "left", "right", "need")), "benchmark")
    contexts = known.select("h", "left", "right", "need", "ctx").distinct()
    few = contexts.count() <= BROADCAST_FINGERPRINTS
    places = fingerprints(rows, needs, header=True)
    d, b = (places if few else around(places)).alias("d"), (F.broadcast(contexts) if few else contexts).select(
        "h", "need", "ctx", F.col("left").alias("b_left"), F.col("right").alias("b_right")).alias("b")
    both = d.join(b, (F.col("d.h") == F.col("b.h")) & (F.col("d.need") == F.col("b.need")), "left").where(
        F.col("d.need").isNull() | F.col("ctx").isNotNull()).drop(F.col("b.need"), F.col("b.h"))
    both = around(both) if few else both
    # written before the comparison: its lambdas would keep a document's words
    # in every fingerprint's row, if they became part of the filter after the join
    met = materialize(both.select("doc_id", "th", "n_words", "need", "ctx", "p", "near", "b_left", "b_right"), "met")
    spans = sides(met).select("doc_id", "th", "n_words", "need", "ctx", "p", common_start(F.col("left"), F.col("b_left")).alias("l"),
                       common_start(F.col("right"), F.col("b_right")).alias("r"))
    k = F.when(F.col("need") == WINDOW, GRAM).otherwise(F.col("need"))
    hits = spans.where(F.col("need").isNull() | ((F.col("r") >= k) & (F.col("l") + F.col("r") >= F.col("need")))).drop("need")
    return hits, known.select("ctx", "item").distinct()


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_words, n_hit, n_items,
    items_sha256, contaminated.

    Null and empty texts have no words; items without words match nothing; a
    null item_id counts as one item with an empty name.  Rows repeated in the
    table are each reported.  A text of any length is one row until its
    fingerprints are taken.  An empty ``docs`` gives an empty result, an empty
    benchmark no hits; other columns of either are not read.
    """
    found, known = scan(docs, benchmark)
    base, hits = found.where("ctx is null").select("doc_id", "th", "n_words"), found.where("ctx is not null")
    # one span per place, then the length of the union of a document's spans
    spans = hits.groupBy("doc_id", "th", "p").agg(F.max("l").alias("l"), F.max("r").alias("r")).select(
        "doc_id", "th", (F.col("p") - F.col("l")).alias("s"), (F.col("p") + F.col("r")).alias("e"))
    before = Window.partitionBy("doc_id", "th").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.withColumn("past", F.coalesce(F.max("e").over(before), F.lit(0)))
    hit = fresh.groupBy("doc_id", "th").agg(
        F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "past"))).cast("long").alias("n_hit"))
    named = hits.select("doc_id", "th", "ctx").distinct().join(bounded(known), "ctx").select("doc_id", "th", "item").distinct().groupBy(
        "doc_id", "th").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    b, h, n = base.alias("b"), hit.alias("h"), named.alias("n")

    def same(x: str) -> Column:
        return (F.col("b.th") == F.col(f"{x}.th")) & F.col("b.doc_id").eqNullSafe(F.col(f"{x}.doc_id"))

    return b.join(h, same("h"), "left").join(n, same("n"), "left").select(
        "b.doc_id", "b.th", "b.n_words", F.coalesce("h.n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n.n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("n.items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("h.n_hit", F.lit(0)) > 0).alias("contaminated"))


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return report(docs, benchmark).drop("th")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all columns.

    Null and empty texts stay; an empty benchmark keeps all; rows are matched
    by id (a null id too) and text, so an id on two texts loses only the hit one.
    """
    hits = scan(docs, benchmark)[0].where("ctx is not null")
    gone = materialize(hits.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")).distinct(), "gone")
    d, g = docs.alias("d"), bounded(gone).alias("g")
    return d.join(g, (F.xxhash64("d.text") == F.col("g.gone_th")) & F.col("d.doc_id").eqNullSafe(F.col("g.gone_id")), "left_anti")


#: DuckDB: every window of every item against every place in every document
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
need AS (SELECT DISTINCT least(len(w), 10) AS m FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, need WHERE len(w) >= m)),
hit AS (SELECT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
