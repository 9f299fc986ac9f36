"""Exact Jaccard join of documents on five-word shingles, by adaptive
multi-match prefixes.

Shingles have one global order: rare ones first, by a corpus-wide count
sketch, then by hash.  Two sets with Jaccard similarity t or more share at
least l shingles within the first ``n - ceil(t * n) + l`` of each, for every
l.  Each document picks its own l: a longer prefix costs more entries, but a
pair needs min(l, l') common entries before it is verified, so documents full
of frequent passages ask for many.  Once both sizes n, n' are known, the pair's
own least overlap o is, and only entries among the first ``n - o + l`` count.
Every candidate is verified exactly on the whole shingle sets.

Only components are needed, so no group of copies is expanded:

* documents with equal sets are one class from the start;
* per shingle, members are first paired with a few representatives only
  (least and greatest under several hash orders), in two rounds, the second
  between components that are still apart;
* then pairs are formed only between members whose components still differ
  and whose sets may be similar by their sizes and parities (a bound that no
  similar pair fails), with the match count applied, which makes the result exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.session import materialize, small_batches

from . import shingles
from . import textbytes as tb
from .common import BROADCAST_ROWS, bounded, named
from .components import components

THRESHOLD = (4, 5)
#: sketch buckets: 2**SKETCH_BITS counts, one byte each once they are levels
SKETCH_BITS = 24
SEGMENT_BITS = 16
#: numbers of shared prefix entries a document may ask for
MATCHES = (1, 2, 4, 8, 16, 32, 64)
#: entries a verified candidate is worth
CANDIDATE_COST = 1.0
#: (id, text hash) pairs that may be broadcast
PAIR_ROWS = 1_000_000
#: hash orders under which a shingle's least and greatest member represent it
ORDERS = 3
#: longs of parity bits of a set (see ``shingles.parities``)
PARITY = 16
_PARITY = [f"p{i}" for i in range(PARITY)]


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def survey(docs: DataFrame) -> DataFrame:
    """One pass: per document its id, set size, set key, text hash and parities
    (rows without ``seg``), and the task's shingle counts by sketch segment."""
    key = docs.schema["doc_id"].dataType.simpleString()
    size = 1 << SEGMENT_BITS
    names = ["doc_id", "n", "k", "th", "seg", "counts", "odd"]

    def run(batches):
        tb.keep_only("jaccard_join")
        held, pending = [], 0
        press = zstandard.ZstdCompressor(level=1)

        def counts():
            bucket = np.sort(np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
            n = 1 << (SKETCH_BITS - SEGMENT_BITS)
            cut = np.searchsorted(bucket, np.arange(n + 1) * size)
            blobs = [press.compress(np.bincount(bucket[cut[i]:cut[i + 1]] - i * size, minlength=size).astype(np.uint32).tobytes())
                     for i in range(n)]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, b.column("doc_id").type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(blobs, pa.binary()),
                 pa.nulls(n, pa.list_(pa.int64()))], names)

        for b in tb.slices(batches):
            sets, offs = shingles.column_sets(b.column("text"))
            n = np.diff(offs)
            k = shingles.set_keys(sets, offs)
            odd = pa.array(shingles.parities(sets, offs, PARITY).ravel())
            held.append(sets)
            pending += len(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(k.view(np.int64), mask=n == 0), b.column("th"), pa.nulls(len(n), pa.int32()),
                 pa.nulls(len(n), pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * PARITY, pa.int32()), odd)], names)
            if pending > 1 << 20:
                yield counts()
                held, pending = [], 0
        if pending:
            yield counts()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(
        run, f"doc_id {key}, n long, k long, th long, seg int, counts binary, odd array<bigint>")


def sketch_levels(parts: DataFrame) -> np.ndarray:
    """Level of each sketch bucket: 0 for counts within four deviations of the
    mean load, then one more for each factor of sqrt(2).  Summed in tasks by segment; what reaches the
    driver is one byte per bucket, a fixed size."""
    size = 1 << SEGMENT_BITS
    segments = 1 << (SKETCH_BITS - SEGMENT_BITS)

    def add(batches):
        unpress = zstandard.ZstdDecompressor()
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for seg, blob in zip(b.column("seg").to_pylist(), b.column("counts")):
                part = np.frombuffer(unpress.decompress(blob.as_py()), np.uint32)
                total[seg] = total[seg] + part if seg in total else part.astype(np.int64)
        for seg, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                             ["seg", "counts"])

    sums = materialize(parts.where("seg is not null").select("seg", "counts")
                       .repartition("seg").mapInArrow(add, "seg int, counts binary"), "sketch")

    def mass(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(np.frombuffer(x.as_py(), np.int64).sum()) for x in b.column("counts")])], ["mass"])

    total = sums.mapInArrow(mass, "mass double").agg(F.sum("mass")).first()[0] or 0.0
    mean = total / (1 << SKETCH_BITS)
    light = mean + 4.0 * mean ** 0.5 + 1.0

    def grade(batches):
        for b in batches:
            out = []
            for x in b.column("counts"):
                c = np.frombuffer(x.as_py(), np.int64)
                level = np.where(c <= light, 0, 1 + 2 * np.log2(np.maximum(c, 1) / light))
                out.append(zstandard.compress(level.astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("seg"), pa.array(out, pa.binary())], ["seg", "levels"])

    levels = np.zeros((segments, size), np.uint8)
    for r in sums.mapInArrow(grade, "seg int, levels binary").collect():
        levels[r["seg"]] = np.frombuffer(zstandard.decompress(r["levels"]), np.uint8)
    return levels.reshape(-1)


def least_overlap(n: int) -> int:
    """Fewest common shingles of a set of n with any similar set."""
    a, b = THRESHOLD
    return -(-n * a // b)


def prefix(tokens: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, int]:
    """(the document's prefix in global order, matches it asks for)."""
    n = len(tokens)
    order = np.lexsort((tokens, level))
    base = n - least_overlap(n)
    # estimated other holders of each entry: none at level 0, doubling every second level
    cost = np.cumsum(np.where(level[order] > 0, 2.0 ** (level[order] / 2), 0.0))
    best, price = 1, None
    for match in MATCHES:
        if match > 1 and (base + match > n or match > n // 10):
            break
        at = base + match
        total = at + CANDIDATE_COST * cost[at - 1] / match
        if price is None or total < price:
            best, price = match, total
    return order[:base + best], best


def entries(docs: DataFrame, levels, wanted=None) -> DataFrame:
    """(token, k, n, match, pos): the prefix entries of every document and
    their places in the global order within it.
    ``wanted``: broadcast sorted tokens to keep, if given."""

    def run(batches):
        tb.keep_only("jaccard_join")
        table = levels.value
        only = wanted.value if wanted is not None else None
        shift = np.uint64(64 - SKETCH_BITS)
        for b in tb.slices(batches):
            sets, offs = shingles.column_sets(b.column("text"))
            keys = shingles.set_keys(sets, offs)
            grade = table[(sets >> shift).astype(np.int64)]
            token, key, size, match, place, seen = [], [], [], [], [], set()
            for i in range(len(keys)):
                s, e = int(offs[i]), int(offs[i + 1])
                if s == e or int(keys[i]) in seen:
                    continue
                seen.add(int(keys[i]))
                pick, asked = prefix(sets[s:e], grade[s:e])
                chosen = sets[s:e][pick]
                at = np.arange(len(pick))
                if only is not None:
                    there = np.searchsorted(only, chosen)
                    keep = only[np.minimum(there, len(only) - 1)] == chosen if len(only) else np.zeros(len(chosen), bool)
                    chosen, at = chosen[keep], at[keep]
                token.append(chosen)
                place.append(at)
                key.append(np.full(len(chosen), keys[i]))
                size.append(np.full(len(chosen), e - s))
                match.append(np.full(len(chosen), asked))
            if token:
                yield pa.RecordBatch.from_arrays(
                    [_long(np.concatenate(token)), _long(np.concatenate(key)), pa.array(np.concatenate(size), pa.int32()),
                     pa.array(np.concatenate(match), pa.int32()), pa.array(np.concatenate(place), pa.int32())],
                    ["token", "k", "n", "match", "pos"])

    return docs.select("text").mapInArrow(run, "token long, k long, n int, match int, pos int")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of set keys whose shingle sets are similar enough."""
    keys = materialize(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "keys")
    n = keys.count()
    if not n:
        return pairs.select("a", "b")
    spark = docs.sparkSession
    few = None
    if n <= BROADCAST_ROWS:
        few = spark.sparkContext.broadcast(np.sort(keys.toArrow()["k"].to_numpy()))

    def texts(batches):
        seen = set()
        for b in tb.slices(batches):
            sets, offs = shingles.column_sets(b.column("text"))
            k = shingles.set_keys(sets, offs).view(np.int64)
            keep = np.diff(offs) > 0
            if few is not None and len(few.value):
                at = np.minimum(np.searchsorted(few.value, k), len(few.value) - 1)
                keep &= few.value[at] == k
            elif few is not None:
                keep[:] = False
            new = [i for i in np.flatnonzero(keep).tolist() if k[i] not in seen and not seen.add(k[i])]
            yield pa.RecordBatch.from_arrays([pa.array(k[new]), b.column("text").take(pa.array(new, pa.int64()))], ["k", "text"])

    held = docs.select("text").mapInArrow(texts, "k long, text string")
    if few is None:
        held = held.join(keys, "k", "left_semi")
    held = held.dropDuplicates(["k"])
    left = held.select(F.col("k").alias("a"), F.col("text").alias("ta"))
    right = held.select(F.col("k").alias("b"), F.col("text").alias("tb"))

    def check(batches):
        a, b = THRESHOLD
        for batch in tb.slices(batches, 256):
            (x, xo), (y, yo) = shingles.column_sets(batch.column("ta")), shingles.column_sets(batch.column("tb"))
            keep = []
            for i in range(batch.num_rows):
                p, q = x[xo[i]:xo[i + 1]], y[yo[i]:yo[i + 1]]
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(b * common >= a * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(check, "a long, b long")


def _sizes_fit(x: str, y: str) -> F.Column:
    a, b = THRESHOLD
    return (F.col(x) * b >= F.col(y) * a) & (F.col(y) * b >= F.col(x) * a)


def _enough(pairs: DataFrame) -> DataFrame:
    """Pairs that share as many entries as the less demanding of the two asks,
    among the entries that count for sets of their sizes."""
    a, b = THRESHOLD
    both = F.col("n_a") + F.col("n_b")
    overlap = F.ceil(both * a / (a + b) - 1e-9)
    asked = F.least("match_a", "match_b")
    return (pairs.where((F.col("pos_a") < F.col("n_a") - overlap + asked) & (F.col("pos_b") < F.col("n_b") - overlap + asked)
                        & _sizes_fit("n_a", "n_b"))
            .groupBy("a", "b").agg(F.count("*").alias("shared"), F.first(asked).alias("asked"))
            .where("shared >= asked").select("a", "b"))


def _sides(members: DataFrame, side: str) -> DataFrame:
    return members.select("token", *[F.col(c).alias(f"{c}_{side}" if c != "k" else side) for c in members.columns if c != "token"])


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, k, th) per document and (node, component) over the set keys k
    that have a link to another."""
    spark = small_batches(docs.sparkSession)
    parts = materialize(survey(docs), "survey")
    levels = spark.sparkContext.broadcast(sketch_levels(parts))
    info = parts.where("seg is null").select("doc_id", "n", "k", "th")

    shared = materialize(entries(docs, levels).select("token", "k").groupBy("token")
                         .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo < hi").select("token"), "tokens")
    if shared.count() <= BROADCAST_ROWS:
        wanted = spark.sparkContext.broadcast(np.sort(shared.toArrow()["token"].to_numpy().view(np.uint64)))
        members = materialize(entries(docs, levels, wanted).distinct(), "members")
        wanted.unpersist()
    else:
        members = materialize(entries(docs, levels).join(shared, "token", "left_semi").distinct(), "members")
    levels.unpersist()

    # a representative may differ between shingles, so a pair's count here is
    # a lower bound; pairs that this hides are formed in the last step
    first = materialize(_with_representatives(members, 0), "pairs")
    links = materialize(verified(docs, first), "links")
    again = _apart(members, components(links))
    second = materialize(_with_representatives(again, ORDERS).join(first, ["a", "b"], "left_anti"), "pairs")
    links = materialize(links.union(verified(docs, second)), "links")
    rest = _apart(again.drop("c"), components(links))
    odd = parts.where("k is not null").select("k", *[F.get("odd", F.lit(i)).alias(c) for i, c in enumerate(_PARITY)])
    pairs = _pairs_apart(rest.join(odd.dropDuplicates(["k"]), "k"))
    third = materialize(_enough(pairs).join(first.union(second), ["a", "b"], "left_anti"), "pairs")
    return info, components(materialize(links.union(verified(docs, third)), "links"))


def _with_representatives(members: DataFrame, seed: int) -> DataFrame:
    """Candidate pairs (a < b) of members of a shingle and its least and
    greatest members under ``ORDERS`` hash orders; if components ``c`` are
    given, only pairs across them."""
    columns = [c for c in members.columns if c != "token"]
    orders = [F.xxhash64("k", F.lit(seed + i)) for i in range(ORDERS)]
    reps = members.groupBy("token").agg(*[f(F.struct(o.alias("o"), *columns)).alias(f"r{i}{j}")
                                          for i, o in enumerate(orders) for j, f in enumerate((F.min, F.max))])
    listed = reps.select("token", F.explode(F.array_distinct(F.array(*[
        F.struct(*[F.col(f"{r}.{c}") for c in columns]) for r in reps.columns if r != "token"]))).alias("r")).select("token", "r.*")
    pairs = _sides(members, "a").join(_sides(listed, "b"), "token").where("a <> b")
    if "c" in columns:
        pairs = pairs.where("c_a <> c_b")
    once = pairs.withColumns({"p": F.least("a", "b"), "q": F.greatest("a", "b")}).dropDuplicates(["token", "p", "q"]).drop("p", "q")
    return _enough(once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs_apart(members: DataFrame) -> DataFrame:
    """Pairs (a < b) of members of a shingle, in components that differ, whose
    sets may be similar.  Sets of similarity 4/5 have 9 |A xor B| <= |A| + |B|,
    and every bit in which the parities differ stands for a member of A xor B."""
    a, b = THRESHOLD
    differ = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in _PARITY), F.lit(0))
    near = (a + b) * differ <= (b - a) * (F.col("n_a") + F.col("n_b"))
    pairs = _sides(members, "a").join(_sides(members, "b"), "token")
    return pairs.where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & _sizes_fit("n_a", "n_b") & near)


def _apart(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of shingles that are in more than one component, with their
    component c."""
    labelled = materialize(members.join(comp.withColumnRenamed("node", "k"), "k", "left")
                           .withColumn("c", F.coalesce("component", "k")).drop("component"), "labelled")
    split = labelled.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("token")
    return labelled.join(split, "token", "left_semi")


def op1(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Null, empty and wordless texts have the empty set and are alone.  Rows
    with equal sets (repeated rows among them) are linked.  A null id takes
    part but never names a component unless it has no other id.  An empty
    table gives an empty result; other columns are not read.
    """
    info, comp = classes(docs)
    known = info.join(comp.withColumnRenamed("node", "k"), "k", "left").withColumn("c", F.coalesce("component", "k"))
    least = known.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("least"))
    return known.join(least, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component
    stays, that with the least id (null last), of equal ids the one with the
    least text hash, of equal rows any one.

    Rows are matched by id and text, so an id that stands on two unlike texts
    loses only the copy.  Rows without words (null and empty texts among them)
    are in no component and all stay.  An empty table stays empty; all columns
    of ``docs`` are kept as they are.
    """
    info, comp = classes(docs)
    known = materialize(info.where("n > 0").join(comp.withColumnRenamed("node", "k"), "k", "left")
                        .select("doc_id", "th", F.coalesce("component", "k").alias("c")), "near")
    stays = known.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("stays"))
    rows = known.groupBy("c", "doc_id", "th").agg(F.count("*").alias("rows")).join(stays, "c")
    chosen = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("th") == F.col("stays.th"))
    told = materialize(rows.select("doc_id", "th", chosen.alias("keep"), "rows").where(~F.col("keep") | (F.col("rows") > 1)), "near")

    def among(which: DataFrame, how: str) -> DataFrame:
        d, w = docs.alias("d"), bounded(which.select("doc_id", "th"), most=PAIR_ROWS).alias("w")
        match = (F.xxhash64("d.text") == F.col("w.th")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
        return d.join(w, match, how).select(named(docs))

    repeated = told.where("keep")
    kept = among(told, "left_anti")
    if not repeated.limit(1).count():
        return kept
    place = "_place" + "_" * max(map(len, docs.columns))  # a name that no column has
    once = among(repeated, "left_semi").withColumn(place, F.xxhash64("text"))
    return kept.unionByName(once.dropDuplicates(["doc_id", place]).drop(place))
