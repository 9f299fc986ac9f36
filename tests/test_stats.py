"""Aggregates and the distributed prefix sum (F1-F10, G2, C1 dense)."""
import math
import random

import pandas as pd
from pyspark.sql import functions as F

from autoscope.operators import profile, stats


def test_running_total_matches_cumsum(spark):
    random.seed(1)
    rows = [(i, random.randint(1, 50)) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(13)
    got = {r.k: r.run for r in stats.running_total(df, "v", ["k"], "run", partitions=7).collect()}
    acc = 0
    for k, v in rows:
        acc += v
        assert got[k] == acc


def test_dense_row_key(spark):
    df = spark.range(3000).selectExpr("cast(id * 7 % 3001 as string) as key").repartition(9)
    out = stats.dense_row_key(df, ["key"]).collect()
    by_key = sorted(out, key=lambda r: r.key)
    assert [r.row_key for r in by_key] == list(range(1, 3001))


def test_category_share_denominator_includes_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    out = {r.c: r for r in stats.category_share(df, "c", drop_null=True, count_col=None).collect()}
    assert out["a"].n == 2 and math.isclose(out["a"].percent, 50.0)
    assert math.isclose(out["b"].cum_percent, 75.0)  # running share ends below 100


def test_top_per_group_tie_breaks_on_key(spark):
    df = spark.createDataFrame([("s", "y"), ("s", "x"), ("s", "y"), ("s", "x"), ("t", "z")], "g string, k string")
    got = sorted(tuple(r) for r in stats.top_per_group(df, "g", "k").collect())
    assert got == [("s", "x", 2), ("t", "z", 1)]


def test_corr_matches_pandas_pairwise(spark):
    random.seed(2)
    rows = [(random.random(), random.random() if i % 5 else None, random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    ref = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for (x, y), v in got.items():
        assert math.isclose(v, ref.loc[x, y], rel_tol=1e-9, abs_tol=1e-12)


def test_null_profile_sorted(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3, None)], "a int, b int, c int")
    got = [tuple(r) for r in profile.null_profile(df).collect()]
    assert got == [("c", 2, 1.0), ("b", 1, 0.5), ("a", 0, 0.0)]


def test_group_stats_excludes_null_key(spark):
    df = spark.createDataFrame([("A", 10.0, 1.0), ("A", 20.0, 3.0), (None, 5.0, 5.0)],
                               "state_id string, price double, mileage double")
    got = [tuple(r) for r in stats.group_stats(df).collect()]
    assert got == [("A", 15.0, 2.0, 2)]


def test_summary_of_all_kinds_of_columns(spark):
    """A value in 40 % of the rows, a column without values, a text column."""
    df = spark.range(1, 101).selectExpr("cast(if(id <= 40, 7, id) as double) as x", "cast(null as double) as z",
                                        "concat('t', id % 3) as s")
    got = {r.col_name: r for r in profile.summary(df, ["x", "z"], ["s"]).collect()}
    assert set(got) == {"x", "z", "s"}
    x, z, s = got["x"], got["z"], got["s"]
    assert x["count"] == 100 and x.min == 7.0 and x.max == 100.0 and (x.p25, x.p50, x.p75) == (7.0, 50.5, 75.25)
    assert z["count"] == 0 and z.mean is None and z.p50 is None
    assert (s["count"], s.mean, s.min_text, s.max_text) == (100, None, "t0", "t2")


def test_null_profile_of_an_empty_table(spark):
    rows = profile.null_profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r.col_name, r.null_count, r.ratio) for r in rows] == [("a", 0, None), ("b", 0, None)]


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    random.seed(5)
    rows = [(random.random() * 100, float(random.randint(0, 9)) if i % 7 else None) for i in range(3001)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = {(r.col_name, r.p): r.value for r in profile.exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()}
    for ci, c in enumerate(["a", "b"]):
        vals = np.array([r[ci] for r in rows if r[ci] is not None])
        for p in [0.25, 0.5, 0.9]:
            assert math.isclose(got[(c, p)], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)


def test_attach_state_dedupe(spark):
    from autoscope.operators.enrich import attach_state
    lst = spark.createDataFrame([("k1", "ftmyers"), ("k2", "nowhere")], "listing_key string, city string")
    dim = spark.createDataFrame([("ftmyers", "FL", "Florida"), ("ftmyers", "CA", "California")],
                                "us_city string, state_id string, state_name string")
    assert attach_state(lst, dim).count() == 3
    got = sorted((r.listing_key, r.state_id) for r in attach_state(lst, dim, dedupe=True).collect())
    assert got == [("k1", "CA"), ("k2", None)]


def test_partition_conf_scales_with_input():
    from autoscope.session import partition_conf
    small = partition_conf(10 * 1024 ** 2, 8)
    big = partition_conf(100 * 1024 ** 4, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2)


def test_counted_values_merge_ties_before_ranking(spark):
    df = spark.createDataFrame([(1.0,)] * 400 + [(float(i),) for i in range(600)], "a double").repartition(5)
    counts = profile.value_counts(df, ["a"])
    assert counts.count() == 600 and counts.where("v = 1").first().n == 401


def _quantiles(got):
    return {(r.col_name, r.p): r.value for r in got.collect()}


def test_only_bracketed_values_travel(spark, monkeypatch):
    """Continuous values beside a tie that holds a third of its column."""
    import numpy as np
    df = spark.range(0, 60_000, 1, 8).selectExpr("(id * 7919) % 60013 + 0.5D as a", "if(id % 3 = 0, 5.0, cast(id as double)) as b")
    sent, counted = [], profile.value_counts

    def count(*args):
        sent.append(counted(*args))
        return sent[-1]

    monkeypatch.setattr(profile, "value_counts", count)
    probs = [0.0, 0.25, 0.5, 1.0]
    got = _quantiles(profile.exact_quantiles(df, ["a", "b"], probs))
    rows = df.toPandas()
    for (c, p), v in got.items():
        assert math.isclose(v, float(np.quantile(rows[c], p)), rel_tol=1e-12)
    most = 8 * len(probs) / profile.ACCURACY
    per = {r.col_name: r["count"] for r in sent[0].where("v is not null").groupBy("col_name").count().collect()}
    assert len(sent) == 1 and sent[0].count() < 3 * most * 60_000
    assert all(n <= most * 60_000 for n in per.values()), per


def test_a_bracket_without_the_rank_is_widened(spark):
    from pyspark.sql import Row
    df = spark.range(1, 1002).selectExpr("cast(id as double) as a")
    wrong = Row(q0=[900.0, 901.0, 2.0, 3.0])
    assert _quantiles(profile.exact_quantiles(df, ["a"], [0.25, 0.5], wrong)) == {("a", 0.25): 251.0, ("a", 0.5): 501.0}


def test_quantiles_of_awkward_columns(spark):
    """Infinities and NaN (the greatest value), one value, no values, no rows."""
    inf = float("inf")
    df = spark.createDataFrame([(-inf, 3.0, None), (1.0, None, None), (inf, None, None), (float("nan"), None, None)],
                               "a double, `b.c` double, z double")
    got = _quantiles(profile.exact_quantiles(df, ["a", "b.c", "z"], [0.0, 0.5]))
    assert got == {("a", 0.0): -inf, ("a", 0.5): inf, ("b.c", 0.0): 3.0, ("b.c", 0.5): 3.0, ("z", 0.0): None, ("z", 0.5): None}
    assert _quantiles(profile.exact_quantiles(df.limit(0), ["a"], [0.5])) == {("a", 0.5): None}
    assert profile.exact_quantiles(df, [], [0.5]).collect() == []


def test_summary_of_many_values(spark, monkeypatch):
    """A column of more values than a task keeps: bracketed by its sketch, then
    counted; equal to the exact quantiles.  One pass serves the others."""
    monkeypatch.setattr(profile, "POINTS", 50)
    n = 4001
    df = spark.range(n).selectExpr("cast((id * 7919) % 4001 as double) / 3 a", "id % 4 b", "if(id % 2 = 0, double('nan'), id) c",
                                   "cast(null as int) d", "concat('é', id) s").repartition(4)
    spread, asked = profile._at_ranks, []
    monkeypatch.setattr(profile, "_at_ranks", lambda df, cols, *rest: asked.append(cols) or spread(df, cols, *rest))
    got = {r.col_name: r for r in profile.summary(df, ["a", "b", "c", "d"], ["s"]).collect()}
    assert asked == [["a", "c"]]
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["count"], a["min"], a.p25, a.p50, a.p75, a["max"]) == (n, 0.0, 1000 / 3, 2000 / 3, 1000.0, 4000 / 3)
    assert math.isclose(a.stddev, math.sqrt(n * (n + 1) / 12) / 3, rel_tol=1e-12)
    assert (b.p25, b.p50, b.p75) == (0.0, 1.0, 2.0)
    assert c["min"] == 1.0 and c["max"] != c["max"] and c.p25 == 2001.0 and c.p75 != c.p75
    assert got["d"]["count"] == 0 and got["d"].p50 is None and got["d"]["mean"] is None
    assert (got["s"].min_text, got["s"].max_text, got["s"]["count"]) == ("é0", "é999", n)
