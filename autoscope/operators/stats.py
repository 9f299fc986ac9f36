"""Group statistics, share tables, top-k and correlation.

Every aggregate here has a partial (map-side) step, so a hot key -- one state
or make holding a third of all rows -- ships one partial row per task, not its
rows.  (The second step of ``top_per_group`` sorts, over counted rows.)  No window runs without a partition key
over unbounded input: the running share is an exact distributed prefix sum.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize


def _order_cols(order: list[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def running_total(df: DataFrame, value: str, order: list[Column | str], out: str,
                  partitions: int | None = None) -> DataFrame:
    """Exact running sum of ``value`` in ``order`` order, without a global window.

    1. range-partition on the order keys (rows of one range stay together,
       ranges are ordered);
    2. running sum inside each range (a window partitioned by range id);
    3. materialise that once in the shared folder (``materialize``) so the
       range layout is fixed -- re-running a range exchange could sample
       other bounds -- and executor loss cannot change it;
    4. per-range totals (at most one row per range, bounded by the shuffle
       partition setting, so broadcasting them is safe) -> exclusive prefix
       -> add.
    ``order`` must be a total order (include a unique tie-breaker).
    """
    cols = _order_cols(order)
    # without an explicit count AQE may coalesce adjacent ranges (a small
    # table does not become hundreds of tiny ranges); coalesced ranges stay
    # contiguous and ordered, which is all the prefix logic needs
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = ranged.withColumn("_rid", F.spark_partition_id())
    w_in = (Window.partitionBy("_rid").orderBy(*cols)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = materialize(ranged.withColumn("_run", F.sum(value).over(w_in)), "running")
    totals = within.groupBy("_rid").agg(F.sum(value).alias("_tot"))
    # at most n rows: ordering them in one task is bounded by configuration
    w_prev = Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_rid", F.coalesce(F.sum("_tot").over(w_prev), F.lit(0)).alias("_off"))
    return (within.join(F.broadcast(offsets), "_rid")
                  .withColumn(out, F.col("_run") + F.col("_off"))
                  .drop("_rid", "_run", "_off"))


def dense_row_key(df: DataFrame, order: list[Column | str], out: str = "row_key") -> DataFrame:
    """C1, dense variant: 1..n in ``order`` order (a total order), layout
    independent, with one shuffle.

    Rows are range-partitioned and sorted; the position inside a range comes
    from ``monotonically_increasing_id``.  The numbered rows are written once,
    which fixes the ranges; ranges then add the counts of those before them
    (one row per range).
    """
    cols = _order_cols(order)
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    numbered = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    rid, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(rid.alias("_rid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_rid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (numbered.withColumn("_rid", rid).join(F.broadcast(offsets), "_rid")
                    .withColumn(out, place + 1 + F.col("_off")).drop("_id", "_rid", "_off"))


def group_stats(df: DataFrame, key: str = "state_id") -> DataFrame:
    """mean price, mean mileage and row count per key, null key excluded."""
    return (df.filter(F.col(key).isNotNull())
              .groupBy(key)
              .agg(F.avg("price").alias("mean_price"),
                   F.avg("mileage").alias("mean_mileage"),
                   F.count(key).alias("trans_count")))


def top_n(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """First n rows in an order (TakeOrderedAndProject, k rows per task)."""
    return df.orderBy(*_order_cols(order)).limit(n)


def category_share(df: DataFrame, key: str, total_rows: Column | None = None,
                   drop_null: bool = False, running: bool = True,
                   count_col: str = "rowno") -> DataFrame:
    """F2 + F3 + C18: frequency of each category, its percent of ALL rows
    (nulls included, even when the null group is dropped), and the running
    percent in descending-frequency order (ties by key).

    ``count_col`` is counted like the original (non-null surrogate keys);
    pass ``None`` to count rows.  The running percent is computed from the
    running *count* (exact integer arithmetic), then scaled.
    """
    counted = F.count(F.lit(1)) if count_col is None else F.count(count_col)
    groups = df.filter(F.col(key).isNotNull()) if drop_null else df
    freq = groups.groupBy(key).agg(counted.alias("n"))
    # the denominator is a scalar subquery: one value computed once, inlined
    total = total_rows if total_rows is not None else df.select(F.count(F.lit(1))).scalar()
    freq = freq.withColumn("n_total", total)
    freq = freq.withColumn("percent", F.col("n") * 100.0 / F.col("n_total"))
    if running:
        freq = running_total(freq, "n", [F.desc("n"), F.asc_nulls_first(key)], "cum_n")
        freq = freq.withColumn("cum_percent", F.col("cum_n") * 100.0 / F.col("n_total")).drop("cum_n")
    return freq.drop("n_total")


def top_per_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """Most frequent ``key`` per ``group`` (ties -> smallest key).

    Two aggregates instead of a window: counts per (group, key), then per
    group the minimum of ``(-n, key)`` -- a partial aggregate, so a group
    holding a third of all rows is still reduced map-side.
    """
    counts = (df.filter(F.col(group).isNotNull() & F.col(key).isNotNull())
                .groupBy(group, key).agg(F.count(F.lit(1)).alias("n")))
    best = (counts.groupBy(group)
                  .agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(key).alias("k"))).alias("b")))
    return best.select(group, F.col("b.k").alias(key), (-F.col("b.neg_n")).alias("n"))


def means_by(df: DataFrame, keys: list[str], cols: list[str], prefix: str = "mean_") -> DataFrame:
    """Mean of each column per key (null keys form their own group)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(prefix + c) for c in cols])


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """F8: pairwise Pearson correlation in long form ``(col_a, col_b, corr)``.

    Pairwise-complete like pandas: a row counts for a pair only when both
    columns are present.  Instead of one online ``corr`` aggregate per pair
    (several divisions per row each), rows are grouped by their null
    pattern and each group keeps plain moment sums -- count, sums and
    cross-products of mean-shifted values -- in one partial aggregate
    (a handful of groups, so skew-proof).  A pair's statistics are then
    the sums over the patterns that contain both columns: a second
    aggregate over (patterns x pairs) rows, a table of a few thousand rows.
    The diagonal and the mirrored half are emitted for the full matrix.
    """
    k = len(cols)
    x = [F.col(c).cast("double") for c in cols]
    # shift by the column means (one cheap pass) for numerical stability
    means = df.agg(*[F.avg(xc).alias(f"m{i}") for i, xc in enumerate(x)]).first()
    shift = [float(means[f"m{i}"]) if means[f"m{i}"] is not None else 0.0 for i in range(k)]
    d = [(x[i] - F.lit(shift[i])).alias(f"d{i}") for i in range(k)]
    mask = sum((F.when(x[i].isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(k)), F.lit(0))
    centred = df.select(mask.alias("mask"), *d)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = centred.groupBy("mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"d{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i, j in pairs])
    entries = [F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                        F.lit((1 << i) | (1 << j)).alias("need"),
                        F.col(f"s{i}").alias("sa"), F.col(f"s{j}").alias("sb"),
                        F.col(f"p{i}_{i}").alias("saa"), F.col(f"p{j}_{j}").alias("sbb"),
                        F.col(f"p{i}_{j}").alias("sab")) for i, j in pairs]
    long = (moments.select("mask", "n", F.explode(F.array(*entries)).alias("e"))
                   .filter((F.col("mask").bitwiseAND(F.col("e.need"))) == F.col("e.need")))
    agg = long.groupBy("e.col_a", "e.col_b").agg(
        F.sum("n").alias("n"), F.sum("e.sa").alias("sa"), F.sum("e.sb").alias("sb"),
        F.sum("e.saa").alias("saa"), F.sum("e.sbb").alias("sbb"), F.sum("e.sab").alias("sab"))
    n = F.col("n").cast("double")
    cov = F.col("sab") / n - (F.col("sa") / n) * (F.col("sb") / n)
    va = F.col("saa") / n - (F.col("sa") / n) * (F.col("sa") / n)
    vb = F.col("sbb") / n - (F.col("sb") / n) * (F.col("sb") / n)
    corr = F.when(F.col("n") >= 2, F.try_divide(cov, F.sqrt(va * vb)))
    half = agg.select("col_a", "col_b", corr.alias("corr"))
    mirror = half.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return half.unionByName(mirror)


def min_max(df: DataFrame, col: str) -> DataFrame:
    """min and max of a column (e.g. colour-scale bounds)."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def row_count(df: DataFrame) -> DataFrame:
    """global row count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
