"""Sampling and splitting.

``random_split`` is Spark's ``randomSplit``: each partition is sorted and
Bernoulli-sampled, so the outcome depends on the partition layout and the
input must be deterministic (persisted or re-read) between the actions
that consume the splits.  ``hash_split`` assigns each row by a hash of its
key: same answer under any layout, no sort, no shuffle, repeatable in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The seed of every split and sample.
SEED = 651


def random_split(df: DataFrame, weights: list[float], seed: int = SEED) -> list[DataFrame]:
    """Seeded weighted random split."""
    return df.randomSplit(weights, seed)


def hash32(key: str | Column) -> Column:
    """The first 32 bits of md5(key); a null key counts as the empty text."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(k.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bounds(weights: list[float]) -> list[tuple[int, int]]:
    """Normalised weights as adjoining ranges of 32-bit hashes."""
    total, acc, bounds = float(sum(weights)), 0.0, []
    for w in weights:
        lo, acc = round(acc / total * 2**32), acc + w
        bounds.append((lo, round(acc / total * 2**32)))
    return bounds


def hash_split(df: DataFrame, key: str | Column, weights: list[float]) -> list[DataFrame]:
    """Layout-independent split by key hash; parts are disjoint and
    cover every row, those with a null key included."""
    h = hash32(key)
    return [df.filter((h >= lo) & (h < hi)) for lo, hi in hash_bounds(weights)]


def with_split_label(df: DataFrame, key: str | Column, weights: list[float],
                     names: list[str]) -> DataFrame:
    """J3 as one column: ``split`` names the part each row falls in."""
    h, expr = hash32(key), None
    for (lo, hi), name in zip(hash_bounds(weights), names):
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr)
