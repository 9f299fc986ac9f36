"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a word budget (its target).  Whole multiples of the source
are taken first; the rest of the budget is filled by a subset of its
documents.  Documents are counted by exact length; lengths are taken in
proportion, then greedily, and a bounded-knapsack over the lengths left over
closes the remaining budget.  Which documents of a length are taken follows a
seeded hash of id and text, so reruns agree.

The unit is the row: rows with the same source, id and text are counted, not
added up, so a unit's length is never more than one document's.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize

from .common import bounded, named

# fixed values of the mix
WEIGHTS = (3, 1, 2)
SHARE, LIMIT = 1.5, 2
SEED = 17
#: hash buckets in which the documents of one length are ranked
BUCKETS = 1024
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def source_key(source: Column) -> Column:
    """Joins on it match null sources too."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def targets(units: DataFrame) -> DataFrame:
    """Per source key: source_size, target.

    Sources in code-point order, null last, weigh ``WEIGHTS`` in turn.  The
    water level at which capped sources take their cap and the others their
    weight's share is the largest over all prefixes of the sources in order
    of cap per weight.  One row per source meets in one task here.
    """
    sizes = units.groupBy("skey").agg(F.sum("length").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("skey") == "n", "skey")) - 1
    weighed = sizes.withColumn("w", F.get(F.array(*map(F.lit, WEIGHTS)), place % len(WEIGHTS)).cast("double"))
    ranked = weighed.withColumn("cap", (F.col("source_size") * LIMIT).cast("double"))
    ahead = Window.orderBy(F.col("cap") / F.col("w"), F.col("skey")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(ahead), F.lit(0.0))))
    return (ranked.withColumn("level", level).withColumn("water", F.max("level").over(everything))
            .select("skey", "source_size", F.least("cap", F.col("water") * F.col("w")).alias("target")))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their total is as
    near below ``budget`` as the bounded knapsack can bring it."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    spare = int(lengths.max())
    bulk = max(0, budget - 4 * spare)  # the knapsack keeps room to choose
    take[:] = [c * bulk // total for c in counts.tolist()]
    left = budget - int((take * lengths).sum())
    for i in order.tolist():  # large ones while the budget is far from used up
        size = int(lengths[i])
        if size and left > 4 * spare:
            more = min(int(counts[i] - take[i]), (left - 3 * spare) // size)
            take[i] += more
            left -= more * size
    # bounded knapsack: sums reached so far, and the step that first reached each
    reach = np.zeros(left + 1, bool)
    reach[0] = True
    via = np.full(left + 1, -1, np.int64)
    steps: list[tuple[int, int]] = []
    for i in order[::-1].tolist():
        size, free = int(lengths[i]), int(counts[i] - take[i])
        if not 0 < size <= left:
            continue
        free, pack = min(free, left // size), 1
        while free and not reach[left]:
            pack = min(pack, free)
            step = pack * size
            new = np.zeros(left + 1, bool)
            new[step:] = reach[:left + 1 - step]
            new &= ~reach
            via[new] = len(steps)
            reach |= new
            steps.append((i, pack))
            free -= pack
            pack *= 2
        if reach[left]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, pack = steps[via[at]]
        take[i] += pack
        at -= pack * int(lengths[i])
    return take


def decide(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per source: skey, source_size, target, base copies; per distinct
    skey, doc_id, size and text hash: m rows, of which ``extra`` get one more copy)."""
    rows = docs.select(source_key(F.col("source")).alias("skey"), "doc_id", word_count(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("th"))
    units = materialize(rows.groupBy("skey", "doc_id", "size", "th").agg(F.count("*").alias("m")), "units")
    sources = materialize(targets(units.withColumn("length", F.col("size") * F.col("m"))).withColumn(
        "base", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
        .withColumn("budget", F.greatest(F.lit(0).cast("long"), F.round("target").cast("long") - F.col("base") * F.col("source_size"))),
        "sources")
    counted = units.where("size > 0").groupBy("skey", "size").agg(F.sum("m").alias("n")).join(
        bounded(sources.select("skey", "budget")), "skey")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        take = fit_lengths(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), int(pdf["budget"].iloc[0]))
        return pd.DataFrame({"skey": pdf["skey"], "size": pdf["size"], "n": pdf["n"], "take": take})

    wanted = materialize(counted.groupBy("skey").applyInPandas(fit, "skey string, size long, n long, take long")
                         .where("take > 0"), "wanted")
    # the text counts too: rows without an id, or of one id, spread over the buckets
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "th", F.lit(SEED))
    among = units.join(wanted, ["skey", "size"]).withColumn("draw", draw).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)))
    whole = among.where("take = n")
    part = among.where("take < n")
    # ranked by bucket first: only the bucket in which the count runs out is
    # ranked unit by unit
    per = part.groupBy("skey", "size", "bucket").agg(F.sum("m").alias("here")).withColumn("before", F.coalesce(
        F.sum("here").over(Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    placed = part.join(per, ["skey", "size", "bucket"]).where("before < take")
    inside = placed.where("before + here <= take")
    ahead = F.sum("m").over(Window.partitionBy("skey", "size", "bucket").orderBy("draw", "doc_id", "th")
                            .rowsBetween(Window.unboundedPreceding, -1))
    edge = (placed.where("before + here > take").withColumn("left", F.col("take") - F.col("before") - F.coalesce(ahead, F.lit(0)))
            .where("left > 0").withColumn("extra", F.least("m", "left")))
    columns = ["skey", "doc_id", "size", "th"]
    chosen = whole.union(inside.select(whole.columns)).withColumn("extra", F.col("m")).select(*columns, "extra").union(
        edge.select(*columns, "extra"))
    u, c = units.alias("u"), chosen.alias("c")
    same = ((F.col("u.skey") == F.col("c.skey")) & (F.col("u.size") == F.col("c.size"))
            & F.col("u.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("u.th") == F.col("c.th")))
    return sources, u.join(c, same, "left").select(
        "u.skey", "u.doc_id", "u.size", "u.th", "u.m", F.coalesce("c.extra", F.lit(0)).cast("long").alias("extra"))


def op8(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``.

    Null texts have size 0 and nothing of them is taken; null sources are one
    source, last in order; an empty table gives an empty result.  Rows
    without an id, or of a repeated one, are documents like any other; which
    of several rows with the same source, id and text takes the extra copy
    makes no difference.  Only doc_id, source and text are read.
    """
    sources, units = decide(docs)
    rows = units.join(bounded(sources), "skey").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    more = (F.col("copy") <= F.col("extra")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("base") + more)).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows without words (null and empty texts among them) stay as they are:
    they use no budget.  Of rows with the same source, id and text all, some
    or none take an extra copy; where only some do, the extra copies are of
    the row that is least as JSON.  An empty table stays empty; all columns
    are kept as they are.
    """
    sources, units = decide(docs)
    picked = materialize(units.where("extra > 0").select(
        F.col("skey").alias("mix_key"), F.col("doc_id").alias("mix_id"), F.col("size").alias("mix_size"), F.col("th").alias("mix_th"),
        (F.col("extra") == F.col("m")).alias("all"), "extra"), "picked")
    base = bounded(sources.select(F.col("skey").alias("base_key"), "base"))
    marked = docs.select(F.struct(*named(docs)).alias("row")).select(
        "row", source_key(F.col("row.source")).alias("skey"), word_count(F.col("row.text")).alias("size"),
        F.xxhash64("row.text").alias("th"))
    same = ((F.col("skey") == F.col("mix_key")) & (F.col("size") == F.col("mix_size"))
            & F.col("row.doc_id").eqNullSafe(F.col("mix_id")) & (F.col("th") == F.col("mix_th")))
    joined = marked.join(base, F.col("skey") == F.col("base_key")).join(bounded(picked), same, "left")
    copies = F.when(F.col("size") == 0, 1).otherwise((F.col("base") + F.when(F.col("all"), 1).otherwise(0)).cast("int"))
    every = joined.select("row", copies.alias("copies")).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
    # at most one such unit a source and size
    some = bounded(picked.where(~F.col("all")))
    least = marked.join(some, same).groupBy("mix_key", "mix_id", "mix_size", "mix_th").agg(
        F.min_by("row", F.to_json("row")).alias("row"), F.first("extra").alias("extra"))
    return every.union(least.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "extra"))).select("row.*"))
