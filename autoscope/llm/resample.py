"""Importance resampling towards a target distribution.

Every text is a bag of word n-grams, hashed into buckets by crc32.  A bucket's
gain compares how often the target and the corpus hold it; a document's weight
is the mean gain of its features, and Gumbel noise derived from its id turns
the best scores into a draw without replacement.

The crc32 of features is taken in bulk: the distinct features of a chunk are
grouped by their length in bytes, each group is a two-dimensional uint8 array
with one feature a column, and all checksums of a group advance by one byte at
a time, row by row of the array.  The buckets are then scattered back to the
places where the features occur.  Counting and weighing are one pass each; what
moves between tasks is one row per bucket and task, and the scored ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autoscope.operators.stats import dense_row_key
from autoscope.session import materialize

from . import textbytes as tb
from .wordids import Words, column_words, span_index

BUCKETS = 10_000
ORDER = 2  # words in the longest feature
MIN_WORDS = 20
SHARE = (25, 100)
SEED = 7
#: bytes of an array of equally long features; features longer than LONG bytes
#: are few and go one by one
CELLS = 1 << 20
LONG = 256
#: digits, letters (lower-cased) and every byte of a non-ASCII character
WORD = tb.byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def _crc_steps() -> np.ndarray:
    """crc32 of every byte value, by the reversed polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_STEP = _crc_steps()


def crc32s(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each span of bytes."""
    out = np.empty(len(starts), np.uint32)
    n = ends - starts
    order = np.argsort(n, kind="stable")
    lengths, at = np.unique(n[order], return_index=True)
    for length, lo, hi in zip(lengths.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
        if length > LONG:
            for i in order[lo:hi].tolist():
                out[i] = zlib.crc32(buf[starts[i]:ends[i]])
            continue
        step = max(1, CELLS // max(length, 1))
        for k in range(lo, hi, step):
            which = order[k:min(k + step, hi)]
            matrix = buf[starts[which] + np.arange(length)[:, None]]
            crc = np.full(len(which), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = _STEP[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[which] = ~crc
    return out


def features(w: Words, order: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words 1 .. ``order``: (n, starts, bucket): the words at
    which a feature of n words starts, and its bucket."""
    # the words with one space between them, so that every feature is a span
    n = w.ends - w.starts
    ends = np.cumsum(n + 1) - 1
    line = np.full(len(w.buf) + len(n), tb.SPACE, np.uint8)
    line[span_index(ends - n, n)] = w.buf[span_index(w.starts, n)]
    starts, last = np.arange(len(n)), np.repeat(w.bounds[1:], np.diff(w.bounds))
    ids, first = w.ids, w.first
    for size in range(1, order + 1):
        if size > 1:  # a feature is its first size - 1 words and one more
            longer = starts + size <= last[starts]
            key = ids[longer] * len(w.first) + w.ids[starts[longer] + size - 1]
            starts = starts[longer]
            _, first, ids = np.unique(key, return_index=True, return_inverse=True)
        if not len(starts):
            return
        head = starts[first]
        crc = crc32s(line, (ends - n)[head], ends[head + size - 1])
        yield size, starts, (crc % np.uint32(buckets)).astype(np.int64)[ids]


def bucket_counts(texts: DataFrame, column: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): occurrences of features in each occurring bucket over all
    texts; null texts have none."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in tb.slices(batches):
            for w in column_words(batch.column(0), WORD):
                for _, _, bucket in features(w, order, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there.astype(np.int64)), pa.array(total[there])], names=["bucket", "n"])

    return texts.select(F.col(column).cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy(
        "bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket (a list of fixed length)."""
    spark = docs.sparkSession
    both = bucket_counts(docs, order=order, buckets=buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        bucket_counts(target, order=order, buckets=buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))).union(
        spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t")))
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    totals = sum(r["s"] for r in rows), sum(r["t"] for r in rows)
    s_all, t_all = (F.lit(float(x + buckets)) for x in totals)
    counts = spark.createDataFrame([(r["bucket"], float(r["s"] + 1), float(r["t"] + 1)) for r in rows], "bucket long, s double, t double")
    gain = F.floor(1000 * F.log(F.col("t") * s_all / (F.col("s") * t_all))).cast("long")
    out = [0] * buckets
    for r in counts.select("bucket", gain.alias("gain")).collect():
        out[r["bucket"]] = r["gain"]
    return out


def weights(docs: DataFrame, gains: list[int], order: int = ORDER) -> DataFrame:
    """doc_id (as it is), n_words, n_features and weight of every row."""
    table = np.array(gains, np.int64)

    def weigh(batches):
        for batch in tb.slices(batches):
            n_words, n_features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for w in column_words(batch.column(1), WORD):
                here = slice(w.lo, w.hi)
                n_words[here] = np.diff(w.bounds)
                row = w.row()
                for _, starts, bucket in features(w, order, len(table)):
                    n_features[here] += np.bincount(row[starts], minlength=w.hi - w.lo)
                    run = np.concatenate([[0], np.cumsum(table[bucket])])
                    edge = np.searchsorted(starts, w.bounds)
                    total[here] += run[edge[1:]] - run[edge[:-1]]
            weight = total // np.maximum(n_features, 1)
            yield pa.record_batch([batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                                  names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()
    return rows.mapInArrow(weigh, f"doc_id {id_type}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, rounded down; null is empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS,
             order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``share`` (a fraction, rounded
    down) is drawn: the highest scores, ties to the smaller doc_id, null last;
    rank counts them from 1 and is null for others.  Null and empty texts
    have no features and weight 0.  Rows repeated in the table are scored alike
    and drawn one by one, among equal ones in any order.  Without a target
    text or without documents nothing fails: gains are then those of empty counts.
    """
    gains = bucket_gains(docs, target, order, buckets)
    # a place in the written table ends all ties, so that no range of the sort is one key
    scored = materialize(weights(docs, gains, order).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
                         .withColumn("_place", F.monotonically_increasing_id()), "scored")
    enough = scored.where(F.col("n_words") >= min_words)
    drawn = share[0] * enough.count() // share[1]
    ranked = dense_row_key(enough, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_place")], "rank")
    few = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    out = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long"))).unionByName(few)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op12(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).drop("n_words")


#: DuckDB: crc32 byte by byte over the distinct features
ORACLE = r"""
WITH RECURSIVE crc(b, k, v) AS (SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b) UNION ALL
  SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM crc WHERE k < 8),
steps AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM crc WHERE k = 8),
w AS (SELECT 0 AS side, row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS MATERIALIZED (SELECT side, n, unnest(w) AS g FROM w
  UNION ALL SELECT side, n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1),
g AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM f)),
bucket AS MATERIALIZED (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b FROM g, steps),
counts AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN bucket USING (g) GROUP BY b),
total AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS v FROM counts, total),
weight AS (SELECT n, count(*) AS n_features, floor(sum(v) / count(*))::BIGINT AS weight
  FROM f JOIN bucket USING (g) JOIN gain USING (b) WHERE side = 0 GROUP BY n),
scored AS (SELECT n, doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weight USING (n) WHERE side = 0),
placed AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS total FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * total // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (n)
"""
