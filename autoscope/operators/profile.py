"""Profiling and data-quality operators.

All are single-pass aggregates (one partial row per task) or filters; the
caller decides whether to collect the small result.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from autoscope.operators.stats import running_total
from autoscope.session import materialize


def shape(df: DataFrame) -> DataFrame:
    """B1: row count and column count as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column the null count and its ratio to the row count.

    One aggregation over all columns (a single scan), then an unpivot of
    that single row into ``(col_name, null_count, ratio)``, sorted by ratio
    descending, then column name.  An empty table has null ratios.
    """
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("col_name"), F.col(f"n{i}").alias("null_count"))
               for i, c in enumerate(cols)]
    long = wide.select("__n", F.explode(F.array(*entries)).alias("e"))
    return (long.select("e.col_name", "e.null_count",
                        F.try_divide("e.null_count", "__n").alias("ratio"))
                .orderBy(F.desc("ratio"), F.asc("col_name")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of one column (nulls first)."""
    return df.select(col).distinct().orderBy(F.asc_nulls_first(col))


#: relative rank error of the quantile sketch is one over this
ACCURACY = 2000
_LEAST, _MOST = float("-inf"), float("nan")  # NaN is the greatest double in Spark's order


#: points of a column that a task keeps at each level of its sketch; a column of
#: at most twice as many distinct values in every task is counted exactly
POINTS = 1 << 13
#: a sketched rank's bracket reaches this share of the rows to both sides
MARGIN = 1 / 400


def summary(df: DataFrame, numbers: list[str], texts: list[str]) -> DataFrame:
    """One row per column.

    Numbers: count, mean, stddev, min, exact quartiles, max.  Texts and other
    types: count, min_text, max_text.  A column without values has count 0
    and nulls.

    One pass: a task sums each column's moments over Arrow batches and counts
    its distinct values, thinned to a sketch where they are many.  Columns
    that no task thinned have their quartiles from these counts; of the
    others, the values bracketed by the sketch are counted in a second pass.
    """
    probs = [0.25, 0.5, 0.75]
    plain = df.select(*[F.col(f"`{c}`").cast("double").alias(f"n{i}") for i, c in enumerate(numbers)],
                      *[F.col(f"`{c}`").cast("string").alias(f"t{i}") for i, c in enumerate(texts)])
    names = numbers + texts
    parts = materialize(plain.mapInArrow(partial(_column_parts, len(numbers), POINTS), _PARTS), "parts")
    columns = materialize(parts.groupBy("c").applyInArrow(lambda t: _column_whole(probs, t), _WHOLE), "moments")
    thinned = {r.c: r.q for r in columns.where("thinned").select("c", "q").collect()}  # a row a column
    at: dict = {}
    if thinned:
        cols = [names[c] for c in thinned]
        at = _at_ranks(df, cols, [_disjoint(_brackets(q, probs)) for q in thinned.values()], probs)
        again = sorted({c for (c, _), v in at.items() if v is None})
        if again:
            at |= _at_ranks(df, again, [[(_LEAST, _MOST)]] * len(again), probs)
    spark = df.sparkSession
    later = spark.createDataFrame([(c, [at[names[c], p] for p in probs]) for c in thinned], "c int, later array<double>")
    listed = spark.createDataFrame(list(enumerate(names)), "c int, col_name string")
    q = F.when(F.col("thinned"), F.col("later")).otherwise(F.col("q"))
    return (listed.join(columns, "c", "left").join(later, "c", "left").select(
        "col_name", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "mean", "stddev", "min", "max", "min_text", "max_text",
        *[F.get(q, F.lit(i)).alias(f"p{round(100 * p)}") for i, p in enumerate(probs)]))


_PARTS = ("c int, v double, n double, thinned boolean, count long, mean double, m2 double, min double, max double, min_text string, max_text string")
_WHOLE = ("c int, count long, mean double, stddev double, min double, max double, min_text string, max_text string, "
          "thinned boolean, q array<double>")


def _merged(v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order (NaN last) and their numbers."""
    v, which = np.unique(v, return_inverse=True)
    return v, np.bincount(which, n, len(v))


class _Counts:
    """Distinct values of a column and their numbers; of more than twice
    ``points``, a sketch: level k holds ``points`` of them for 2^k times as many values, so that a rank
    moves by half a point a level."""

    def __init__(self, points: int):
        self.points, self.levels = points, [None]

    def add(self, v: np.ndarray, n: np.ndarray) -> None:
        if self.levels[0] is not None:
            v, n = _merged(*(np.concatenate(x) for x in zip(self.levels[0], (v, n))))
        if len(v) <= 2 * self.points:
            self.levels[0] = v, n
            return
        self.levels[0], k = None, 1
        v, n = self._thin(v, n)
        while k < len(self.levels) and self.levels[k] is not None:
            v, n = self._thin(*_merged(*(np.concatenate(x) for x in zip(self.levels[k], (v, n)))))
            self.levels[k], k = None, k + 1
        self.levels += [None] * (k + 1 - len(self.levels))
        self.levels[k] = v, n

    def _thin(self, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upto = np.cumsum(n)
        at = np.searchsorted(upto, (np.arange(self.points) + 0.5) * (upto[-1] / self.points))
        kept, times = np.unique(np.minimum(at, len(v) - 1), return_counts=True)
        return v[kept], times * (upto[-1] / self.points)


def _pooled(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """(count, mean, sum of squared deviations) of two sets of rows together."""
    n, shift = a[0] + b[0], b[1] - a[1]
    if not a[0] or not b[0]:
        return a if a[0] else b
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + shift * shift * (a[0] * b[0] / n)


def _column_parts(n_numbers: int, points: int, batches):
    """One task: a row a text column; for a number its moments, in the first row, and its counts."""
    moments: dict[int, tuple] = {}
    counts: dict[int, _Counts] = {}
    ends: dict[int, tuple] = {}
    texts: dict[int, tuple] = {}
    for b in batches:
        for c in range(b.num_columns):
            x = b.column(c)
            if x.null_count == len(x):
                continue
            if c >= n_numbers:
                low_high = pc.min_max(x)
                n, low, high = len(x) - x.null_count, low_high["min"].as_py(), low_high["max"].as_py()
                old = texts.get(c)
                # code points order as UTF-8 bytes do
                texts[c] = (n, low, high) if old is None else (old[0] + n, min(old[1], low), max(old[2], high))
                continue
            v = (x.drop_null() if x.null_count else x).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                mean = float(v.mean())
                moments[c] = _pooled(moments.get(c, (0, 0.0, 0.0)), (len(v), mean, float(((v - mean) ** 2).sum())))
            values, n = np.unique(v, return_counts=True)
            low, high = ends.get(c, (values[0], values[-1]))
            ends[c] = min(low, values[0], key=_above), max(high, values[-1], key=_above)
            counts.setdefault(c, _Counts(points)).add(values, n.astype(np.float64))
    names = _PARTS_NAMES
    for c, (n, low, high) in texts.items():
        yield pa.record_batch([pa.array([c], pa.int32()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64()), pa.array([False]),
                               pa.array([n]), *[pa.nulls(1, pa.float64())] * 4, pa.array([low]), pa.array([high])], names=names)
    for c, held in counts.items():
        v, n = (np.concatenate(x) for x in zip(*[x for x in held.levels if x is not None]))
        told = *moments[c], *map(float, ends[c])
        first = lambda value, kind: pa.array([value] + [None] * (len(v) - 1), kind)
        yield pa.record_batch([pa.array(np.full(len(v), c, np.int32)), pa.array(v), pa.array(n), pa.array([len(held.levels) > 1] * len(v)),
                               first(told[0], pa.int64()), *[first(x, pa.float64()) for x in told[1:]],
                               pa.nulls(len(v), pa.string()), pa.nulls(len(v), pa.string())], names=names)


_PARTS_NAMES = [x.split()[0] for x in _PARTS.split(", ")]


def _column_whole(probs: list[float], t: pa.Table) -> pa.Table:
    """One column from all tasks' parts: ``q`` are the exact quantiles, or the
    ends of their brackets if a task thinned its values."""
    told = t.filter(pc.is_valid(t.column("count")))
    out = {x.split()[0]: None for x in _WHOLE.split(", ")}
    out |= {"c": t.column("c")[0].as_py(), "count": pc.sum(told.column("count")).as_py(), "thinned": pc.any(t.column("thinned")).as_py()}
    if told.column("min_text")[0].is_valid:
        out |= {"min_text": min(told.column("min_text").to_pylist()), "max_text": max(told.column("max_text").to_pylist())}
    else:
        n, mean, m2 = reduce(_pooled, zip(*(told.column(k).to_pylist() for k in ("count", "mean", "m2"))))
        out |= {"mean": mean, "stddev": (m2 / (n - 1)) ** 0.5 if n > 1 else None,
                "min": min(told.column("min").to_pylist(), key=_above), "max": max(told.column("max").to_pylist(), key=_above)}
        v, k = _merged(t.column("v").to_numpy(), t.column("n").to_numpy())
        upto = np.cumsum(k)
        if out["thinned"]:
            ends = [min(max(p + side * MARGIN, 0.0), 1.0) * upto[-1] for p in probs for side in (-1, 1)]
            out["q"] = [float(v[min(np.searchsorted(upto, x), len(v) - 1)]) for x in ends]
        else:
            rank = lambda r: float(v[np.searchsorted(upto, r, "right")])
            out["q"] = []
            for lo, hi, frac in (_ranks(n, p) for p in probs):
                x, y = rank(lo), rank(hi)
                out["q"].append(x if x == y or not frac else x + frac * (y - x))
    return pa.Table.from_pylist([out], schema=pa.schema([(k, {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(),
                                                               "boolean": pa.bool_()}.get(kind, pa.list_(pa.float64())))
                                                         for k, kind in (x.split() for x in _WHOLE.split(", "))]))


def _sketches(cols: list[str], probs: list[float]) -> list[Column]:
    """Per column the values a little before and after each probability, from
    Spark's mergeable quantile sketch: what a task sends has a fixed size."""
    at = [min(max(p + side * 2 / ACCURACY, 0.0), 1.0) for p in probs for side in (-1, 1)]
    return [F.percentile_approx(F.col(f"`{c}`").cast("double"), at, ACCURACY).alias(f"q{i}") for i, c in enumerate(cols)]


def _brackets(ends: list[float] | None, probs: list[float]) -> list[tuple[float, float]]:
    """The interval of values that should hold each probability's ranks."""
    if not ends:
        return [(_LEAST, _MOST)] * len(probs)
    return [(_LEAST if p <= 2 / ACCURACY else ends[2 * i], _MOST if p >= 1 - 2 / ACCURACY else ends[2 * i + 1])
            for i, p in enumerate(probs)]


def _above(x: float) -> tuple[bool, float]:
    """Sort key of a double in Spark's order, NaN last."""
    return (x != x, 0.0 if x != x else x)


def _disjoint(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Intervals that meet become one."""
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(intervals, key=lambda t: (_above(t[0]), _above(t[1]))):
        if merged and _above(lo) <= _above(merged[-1][1]):
            merged[-1] = (merged[-1][0], max(merged[-1][1], hi, key=_above))
        else:
            merged.append((lo, hi))
    return merged


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """The two 0-based ranks ``quantile_cont`` interpolates, and how far."""
    pos = (n - 1) * p
    lo = math.floor(pos)
    return lo, min(math.ceil(pos), n - 1), pos - lo


def value_counts(df: DataFrame, cols: list[str], intervals: list[list[tuple[float, float]]] | None = None) -> DataFrame:
    """``(col_name, part, v, n)``: every distinct value of several numeric
    columns with its frequency.  With disjoint ascending ``intervals`` a column,
    values outside them are only counted: part 2j holds those before interval
    j (without ``v``), part 2j + 1 the values inside it.  Ties -- one value may
    hold most of a column -- collapse in the map-side step, and so does
    everything outside the intervals."""
    entries = []
    for c, parts in zip(cols, intervals or [[(_LEAST, _MOST)]] * len(cols)):
        x = F.col(f"`{c}`").cast("double")
        part = F.lit(2 * len(parts))
        for j, (lo, hi) in reversed(list(enumerate(parts))):
            part = F.when(x < F.lit(lo), 2 * j).when(x <= F.lit(hi), 2 * j + 1).otherwise(part)
        entries.append(F.struct(F.lit(c).alias("col_name"), part.alias("part"), x.alias("v")))
    inside = F.when(F.col("e.part") % 2 == 1, F.col("e.v"))
    return (df.select(F.explode(F.array(*entries)).alias("e")).where("e.v is not null")
            .select("e.col_name", "e.part", inside.alias("v")).groupBy("col_name", "part", "v").agg(F.count(F.lit(1)).alias("n")))


def _at_ranks(df: DataFrame, cols: list[str], intervals: list[list[tuple[float, float]]], probs: list[float]) -> dict:
    """{(column, probability): quantile, or None where a rank is outside the
    column's intervals}; columns without values are left out."""
    spark = df.sparkSession
    counts = running_total(value_counts(df, cols, intervals), "n", ["col_name", "part", "v"], "upto")
    sizes = counts.groupBy("col_name").agg(F.sum("n").alias("total"), F.max("upto").alias("last"))
    wanted, before = {}, []
    for r in sizes.collect():  # a row a column
        before.append((r.col_name, r["last"] - r.total))
        wanted |= {(r.col_name, p): _ranks(r.total, p) for p in probs}
    if not wanted:
        return {}
    ranks = spark.createDataFrame([(c, rank) for c, rank in {(c, rank) for (c, _), w in wanted.items() for rank in w[:2]}],
                                  "col_name string, rank long")
    starts = spark.createDataFrame(before, "col_name string, start long")
    after = F.col("upto") - F.col("start")
    found = counts.join(F.broadcast(starts), "col_name").join(F.broadcast(ranks), "col_name").where(
        (F.col("rank") >= after - F.col("n")) & (F.col("rank") < after)).select("col_name", "rank", "v")
    at = {(r.col_name, r["rank"]): r.v for r in found.collect()}  # at most two rows a column and probability
    out = {}
    for (c, p), (lo, hi, frac) in wanted.items():
        x, y = at[c, lo], at[c, hi]
        out[c, p] = None if x is None or y is None else x if x == y or not frac else x + frac * (y - x)
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], sketch: Row | None = None) -> DataFrame:
    """Exact interpolated quantiles (``quantile_cont``) of several columns:
    ``(col_name, p, value)``, null for a column without values.

    A quantile sketch brackets each wanted rank.  Then values inside a bracket
    are counted by value, about ``6 / ACCURACY`` of a column for each
    probability, and all others by the gap they are in, so that a distributed
    prefix sum gives every bracketed value its ranks.  A column of which a
    rank falls into a gap is counted again without brackets.

    ``df`` is read twice, or once if the row of ``_sketches`` is handed in.
    The driver sees a row a column and probability.
    """
    asked = [(c, p) for c in cols for p in probs]
    at: dict = {}
    if asked:
        sketch = sketch or df.agg(*_sketches(cols, probs)).first()
        at = _at_ranks(df, cols, [_disjoint(_brackets(sketch[f"q{i}"], probs)) for i in range(len(cols))], probs)
        again = sorted({c for (c, _), v in at.items() if v is None})
        if again:
            at |= _at_ranks(df, again, [[(_LEAST, _MOST)]] * len(again), probs)
    return df.sparkSession.createDataFrame([(c, p, at.get((c, p))) for c, p in asked], "col_name string, p double, value double")


def all_present(cols: list[str]) -> Column:
    """AND of ``isNotNull`` over columns."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def any_missing(cols: list[str]) -> Column:
    """D3: OR of ``isNull`` over columns."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows with every listed column present."""
    return df.filter(all_present(cols))


def spot_check(df: DataFrame, before: str, cols: list[str], missing: bool = True) -> DataFrame:
    """Rows where ``before`` was (or was not) null, with chosen columns."""
    cond = F.col(before).isNull() if missing else F.col(before).isNotNull()
    return df.filter(cond).select(*cols)


def groups_still_missing(means: DataFrame, cols: list[str]) -> DataFrame:
    """Group-mean rows where any mean is null (imputation cannot help)."""
    return means.filter(any_missing(cols))
