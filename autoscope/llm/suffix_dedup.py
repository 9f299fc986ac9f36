"""Removal of bytes covered by long strings that occur again, by a sparse
suffix array sorted deep-shallow.

Suffixes are taken at anchors only: positions whose ``GRAM``-byte hash is the
least in some run of neighbouring positions, so that every string of ``SPAN``
bytes holds an anchor at the same place wherever it occurs.  Anchors meet by
their gram.  Their surroundings, ``SPAN - GRAM`` bytes before and after the
gram, are sorted in both directions (see ``suffix_sort``); a string of ``SPAN``
bytes that starts x bytes before an anchor occurs again if another anchor of
the gram has the same x bytes before it and ``SPAN - GRAM - x`` after, which
the two orders and their common-prefix lengths tell.

Equal surroundings are one row from the first aggregation on, so copies cost
one comparison however many there are.  Grams with more different
surroundings than one task should hold are settled by counting the hashes of
all their strings of ``SPAN`` bytes, without a limit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize

from . import textbytes as tb
from .common import BROADCAST_ROWS, bounded
from .suffix_sort import sort_groups

SPAN, GRAM = 200, 100
LEFT = SPAN - GRAM
RUN = SPAN - GRAM + 1
#: different surroundings of one gram that are sorted in one task
SORTED_AT_ONCE = 20_000
#: places whose surroundings are looked up by a broadcast list (28 bytes each)
BROADCAST_PLACES = 2_000_000
#: surroundings sorted together in a task
BATCH = 50_000


def _sliding(values: np.ndarray, run: int, pick, fill) -> np.ndarray:
    """pick (minimum or maximum) over every ``run`` neighbouring values."""
    n = len(values)
    blocks = -(-n // run)
    padded = np.full(blocks * run, fill, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, run)
    ahead = pick.accumulate(grid, axis=1).reshape(-1)
    back = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(back[:n - run + 1], ahead[run - 1:n])


def anchors(buf: np.ndarray, rows: np.ndarray):
    """(positions, grams, surroundings, row, left length, right length) of the
    anchors in a chunk; rows are ``buf[rows[i]:rows[i + 1] - 1]``."""
    none = np.zeros(0, np.int64)
    if len(buf) < SPAN:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    c = tb.prefix_sums(buf)
    inverse = tb.powers(tb._P_INV, len(c))
    n = len(buf) - GRAM + 1
    grams = tb.mix((c[GRAM:] - c[:-GRAM]) * inverse[:n])
    least = _sliding(grams, RUN, np.minimum, np.uint64(2**64 - 1))  # of the string of SPAN bytes from each position
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    ends = rows[1:] - 1
    least[np.arange(len(least)) + SPAN > ends[owner[:len(least)]]] = 0  # strings must not leave their row
    # chosen: the least of some string that holds the position
    around = np.concatenate([np.zeros(RUN - 1, np.uint64), least, np.zeros(RUN - 1, np.uint64)])
    most = _sliding(around, RUN, np.maximum, np.uint64(0))[:n]
    at = np.flatnonzero((most == grams) & (grams > 0))
    row = owner[at]
    lo, hi = np.maximum(rows[row], at - LEFT), np.minimum(ends[row], at + SPAN)
    left, right = at - lo, hi - at
    around_hash = tb.mix((c[hi] - c[lo]) * inverse[lo] + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                         + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return at, grams[at], around_hash, row, left, right


_ANCHORS = "gram long, ctx long, doc long, pos long, l int, r int"


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, text): texts with their hash; null is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("doc"), text.alias("text"))


def _emit(wanted=None):
    def run(batches):
        only = wanted.value if wanted is not None else None
        seen: set[int] = set()
        for b in tb.slices(batches):
            keys = b.column("doc").to_numpy()
            new = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool)
            b = b.filter(pa.array(new))
            keys = keys[new]
            for lo, _, buf, rows in tb.chunks(b.column("text")):
                at, gram, ctx, row, left, right = anchors(buf, rows)
                if only is not None:
                    keep = np.zeros(len(at), bool)
                    if len(only):
                        keep = only[np.minimum(np.searchsorted(only, gram), len(only) - 1)] == gram
                    at, gram, ctx, row, left, right = (x[keep] for x in (at, gram, ctx, row, left, right))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(keys[lo + row]),
                     pa.array(at - rows[row]), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32))],
                    ["gram", "ctx", "doc", "pos", "l", "r"])
    return run


def candidates(docs: DataFrame) -> DataFrame:
    """Anchors whose gram occurs at two places or more."""
    texts = _documents(docs)
    place = F.struct("doc", "pos")
    again = materialize(texts.mapInArrow(_emit(), _ANCHORS).groupBy("gram").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                        .where("a <> b").select("gram"), "grams")
    if again.count() <= BROADCAST_ROWS:
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(again.toArrow()["gram"].to_numpy().view(np.uint64)))
        found = texts.mapInArrow(_emit(wanted), _ANCHORS)
    else:
        found = texts.mapInArrow(_emit(), _ANCHORS).join(again, "gram", "left_semi")
    return materialize(found.distinct(), "anchors")


def surroundings(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(gram, ctx, left, right): the bytes before (reversed) and after the
    gram at each of ``places`` (gram, ctx, doc, pos), one place a ctx."""
    texts, schema = _documents(docs), "gram long, ctx long, left binary, right binary"

    def cut(gram, ctx, raw, pos):
        return [(g, c, raw[max(0, p - LEFT):p][::-1], raw[p + GRAM:p + SPAN]) for g, c, p in zip(gram, ctx, pos)]

    def packed(out):
        gram, ctx, left, right = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(ctx), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                                          ["gram", "ctx", "left", "right"])

    if places.count() > BROADCAST_PLACES:
        spread = places.groupBy("doc").agg(F.collect_list(F.struct("gram", "ctx", "pos")).alias("at"))

        def run(batches):
            for b in tb.slices(batches, 256):
                out = []
                for text, at in zip(b.column("text").to_pylist(), b.column("at").to_pylist()):
                    out += cut([x["gram"] for x in at], [x["ctx"] for x in at], text.encode(), [x["pos"] for x in at])
                if out:
                    yield packed(out)

        return texts.dropDuplicates(["doc"]).join(spread, "doc").select("text", "at").mapInArrow(run, schema)

    listed = places.select("doc", "pos", "gram", "ctx").toArrow()
    doc = listed["doc"].to_numpy()
    order = np.argsort(doc, kind="stable")
    wanted = docs.sparkSession.sparkContext.broadcast(
        (doc[order], listed["pos"].to_numpy()[order].astype(np.int32), listed["gram"].to_numpy()[order], listed["ctx"].to_numpy()[order]))

    def look_up(batches):
        doc, pos, gram, ctx = wanted.value
        seen: set[int] = set()
        for b in tb.slices(batches, 256):
            keys = b.column("doc").to_numpy()
            lo, hi = np.searchsorted(doc, keys), np.searchsorted(doc, keys, "right")
            out = []
            for i in np.flatnonzero(hi > lo).tolist():
                if int(keys[i]) not in seen:
                    seen.add(int(keys[i]))
                    own = slice(lo[i], hi[i])
                    out += cut(gram[own].tolist(), ctx[own].tolist(), b.column("text")[i].as_py().encode(), pos[own].tolist())
            if out:
                yield packed(out)

    # copies of a text in several tasks give the same row
    return texts.mapInArrow(look_up, schema).dropDuplicates(["gram", "ctx"])


def reach(gram: np.ndarray, left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each surrounding, how far to the left and right of its anchor
    strings of SPAN bytes reach that occur around another one of its gram
    too; 0, 0 if there is none."""
    m = len(gram)
    label = np.unique(gram, return_inverse=True)[1]
    (by_right, shared_right), (by_left, shared_left) = sort_groups(right, label), sort_groups(left, label)
    most_left, least_left = np.full(m, -1), np.full(m, SPAN + 1)
    size_left, size_right = np.fromiter(map(len, left), np.int64, m), np.fromiter(map(len, right), np.int64, m)
    class_left, class_right = np.empty(m, np.int64), np.empty(m, np.int64)
    for x in range(LEFT + 1):
        class_right[by_right] = np.cumsum(shared_right < LEFT - x)
        class_left[by_left] = np.cumsum(shared_left < x)
        key = class_right * (m + 1) + class_left
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(m, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        again &= (size_left >= x) & (size_right >= LEFT - x)
        most_left[again] = x
        least_left[again & (least_left > x)] = x
    hit = most_left >= 0
    return np.where(hit, most_left, 0), np.where(hit, SPAN - least_left, 0)


def _sorted_reach(rows: DataFrame) -> DataFrame:
    """(gram, ctx, a, b) by suffix sorting; a gram's rows are in one task."""

    def run(batches):
        grams, ctxs, lefts, rights = [], [], [], []

        def settle(keep_last: bool):
            """Solve the held grams; the last may still have rows to come."""
            nonlocal grams, ctxs, lefts, rights
            end = len(grams)
            if keep_last:
                while end and grams[end - 1] == grams[-1]:
                    end -= 1
            if not end:
                return None
            a, b = reach(np.array(grams[:end], np.int64), lefts[:end], rights[:end])
            out = pa.RecordBatch.from_arrays([pa.array(grams[:end]), pa.array(ctxs[:end]), pa.array(a), pa.array(b)],
                                             ["gram", "ctx", "a", "b"])
            grams, ctxs, lefts, rights = grams[end:], ctxs[end:], lefts[end:], rights[end:]
            return out

        for batch in tb.slices(batches, 4096):
            grams += batch.column("gram").to_pylist()
            ctxs += batch.column("ctx").to_pylist()
            lefts += batch.column("left").to_pylist()
            rights += batch.column("right").to_pylist()
            if len(grams) >= BATCH:
                done = settle(True)
                if done is not None:
                    yield done
        done = settle(False)
        if done is not None:
            yield done

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "gram long, ctx long, a long, b long")


def _counted_reach(rows: DataFrame) -> DataFrame:
    """(gram, ctx, a, b) by counting the strings of SPAN bytes by hash."""

    def run(batches):
        for batch in tb.slices(batches, 64):
            for gram, ctx, left, right in zip(*(batch.column(c).to_pylist() for c in ("gram", "ctx", "left", "right"))):
                raw = np.frombuffer(left[::-1] + right, np.uint8)
                n = len(raw) - LEFT + 1  # the gram, equal for all, is left out
                if n < 1:
                    continue
                c = tb.prefix_sums(raw)
                at = np.arange(n)
                h = tb.mix(tb.span_hashes(c, at, at + LEFT))
                x = len(left) - at
                at = np.flatnonzero((x >= 0) & (x <= LEFT))
                size = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, gram)), pa.array(np.full(size, ctx)), pa.array(h[at].view(np.int64)), pa.array(x[at])],
                    ["gram", "ctx", "h", "x"])

    strings = rows.mapInArrow(run, "gram long, ctx long, h long, x long")
    key = ["gram", "h", "x"]
    again = strings.groupBy(key).agg(F.min("ctx").alias("p"), F.max("ctx").alias("q")).where("p <> q").select(key)
    return strings.join(again, key).groupBy("gram", "ctx").agg(F.max("x").alias("a"), (F.lit(SPAN) - F.min("x")).alias("b"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, s, e): maximal byte runs to remove from each text, by text hash."""
    found = candidates(docs)
    place = F.struct("doc", "pos")
    alike = materialize(found.groupBy("gram", "ctx").agg(
        F.min(F.struct("doc", "pos", "l", "r")).alias("one"), (F.min(place) != F.max(place)).alias("again")), "alike")
    # a surrounding that occurs twice is covered as far as it reaches
    whole = alike.where(F.col("again") & (F.col("one.l") + F.col("one.r") >= SPAN)).select(
        "gram", "ctx", F.col("one.l").cast("long").alias("a"), F.col("one.r").cast("long").alias("b"))
    kinds = alike.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    compare = materialize(alike.join(kinds, "gram").select("gram", "ctx", "one.doc", "one.pos"), "compare")
    around = surroundings(docs, compare)
    large = materialize(kinds.where(F.col("kinds") > SORTED_AT_ONCE).select("gram"), "large")
    n_large = large.count()
    if n_large:  # few by nature: each has so many surroundings
        around = materialize(around, "around")
        many, around = around.join(bounded(large, n_large), "gram", "left_semi"), around.join(bounded(large, n_large), "gram", "left_anti")
    reached = _sorted_reach(around).where("a + b > 0")
    if n_large:
        reached = reached.union(_counted_reach(many))
    best = whole.union(reached).groupBy("gram", "ctx").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    spans = found.join(best, ["gram", "ctx"]).select("doc", (F.col("pos") - F.col("a")).alias("s"), (F.col("pos") + F.col("b")).alias("e"))
    # texts that occur twice go as a whole
    copies = _documents(docs).groupBy("doc").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("e")).where(
        (F.col("n") > 1) & (F.col("e") >= SPAN)).select("doc", F.lit(0).cast("long").alias("s"), "e")
    everything = spans.union(copies).distinct()
    order = Window.partitionBy("doc").orderBy("s", "e")
    past = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = everything.withColumn("island", F.sum(F.when(past.isNull() | (F.col("s") > past), 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def op6(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null and empty texts have no bytes; texts shorter than SPAN lose none.
    Repeated rows of SPAN bytes or more lose all theirs.  Texts are told
    apart by a 64-bit hash.  Other columns are not read.
    """
    spans = materialize(repeated_spans(docs), "spans")
    lists = spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cut"))
    key = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("doc")).join(bounded(lists, spans.count()), "doc", "left")

    def run(batches):
        for b in tb.slices(batches):
            out = []
            for raw, cut in zip(b.column("text"), b.column("cut").to_pylist()):
                raw = raw.as_py().encode()
                keep, at, gone = hashlib.sha256(), 0, 0
                for span in cut or []:
                    keep.update(raw[at:span["s"]])
                    at = span["e"]
                    gone += span["e"] - span["s"]
                keep.update(raw[at:])
                out.append((len(raw), gone, len(cut or []), keep.hexdigest()))
            n, gone, count, digest = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.select("doc_id", "text", "cut").mapInArrow(
        run, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
