"""Shared pieces of the llm queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def drawn(key: Column, rate: float) -> Column:
    """Whether a 62-bit hash of ``key`` (a hash of 64 bits) lies in the first
    ``rate`` of its range: fine enough that a few of 10**15 rows can be drawn.
    The hash's low 20 bits come first."""
    place = F.pmod(key, F.lit(1 << 20)) * F.lit(1 << 42) + F.shiftrightunsigned(key, 22)
    return place < F.lit(int(min(1.0, rate) * (1 << 62)))


def named(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


#: rows of a key list that may be broadcast (long keys: tens of megabytes);
#: longer lists are joined by shuffle
BROADCAST_ROWS = 4_000_000


def bounded(keys: DataFrame, rows: int | None = None, most: int | None = None) -> DataFrame:
    """``keys`` with a broadcast hint if it has at most ``most`` rows
    (``BROADCAST_ROWS``; counted here), else unchanged for a shuffled join."""
    n = keys.count() if rows is None else rows
    return F.broadcast(keys) if n <= (BROADCAST_ROWS if most is None else most) else keys
