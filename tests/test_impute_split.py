"""Imputation rules (K1-K5) and splits."""
from pyspark.sql import functions as F

from autoscope.operators import impute, split


def test_mileage_as_written_overwrites_used_cars(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 0, 100.0), ("A", 0, None), ("B", 0, 7.0)],
                               "state_id string, is_new int, mileage double")
    means = impute.mileage_by_state(df)
    out = sorted(tuple(r) for r in impute.impute_mileage(df, means).select(
        "state_id", "is_new", "old_mileage", "mileage").collect())
    assert out == sorted([("A", 1, 5, 5.0), ("A", 0, None, 100.0), ("A", 0, None, 100.0), ("B", 0, None, 7.0)])
    kept = impute.impute_mileage(df, means, keep_observed=True)
    assert sorted(r.mileage for r in kept.collect()) == [5.0, 7.0, 100.0, 100.0]


def test_group_means_null_key_semantics(spark):
    df = spark.createDataFrame([("m", 1.0), ("m", None), (None, 4.0), (None, None)], "k string, x double")
    strict = impute.impute_group_means(df, ["k"], ["x"], keep_means=False)
    assert sorted((r.k, r.x) for r in strict.collect() if r.k == "m") == [("m", 1.0), ("m", 1.0)]
    assert sorted(str(r.x) for r in strict.collect() if r.k is None) == ["4.0", "None"]
    window_like = impute.impute_group_means(df, ["k"], ["x"], null_keys_match=True, keep_means=False)
    assert sorted(r.x for r in window_like.collect()) == [1.0, 1.0, 4.0, 4.0]


def test_hash_split_disjoint_covering_layout_free(spark):
    df = spark.range(20000).selectExpr("cast(id as string) as key")
    a, b = split.hash_split(df, "key", [0.8, 0.2])
    na, nb = a.count(), b.count()
    assert na + nb == 20000 and 15500 < na < 16500
    assert a.join(b, "key").count() == 0
    again = split.hash_split(df.repartition(11), "key", [0.8, 0.2])[1]
    assert sorted(r.key for r in again.collect()) == sorted(r.key for r in b.collect())


def test_hash_split_covers_null_keys_and_small_parts(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert sum(p.count() for p in split.hash_split(df, "key", [0.5, 0.5])) == 3
    assert split.with_split_label(df, "key", [0.5, 0.5], ["x", "y"]).where("split is null").count() == 0
    big = spark.range(200_000).selectExpr("cast(id as string) as key")
    sizes = [p.count() for p in split.hash_split(big, "key", [0.9996, 0.0004])]
    assert sum(sizes) == 200_000 and 40 < sizes[1] < 160


def test_random_split_sizes(spark):
    df = spark.range(10000)
    parts = split.random_split(df, [0.9, 0.1])
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 10000 and 800 < sizes[1] < 1200


def test_encoding_on_complete_cases_only(spark):
    """make 'x' is most frequent overall but mostly incomplete: fitted on
    complete cases only, 'y' takes index 0."""
    from autoscope.plans import jobs
    cols = ["make_name", "body_type", "transmission_display", "listing_color", "state_id", "model_name",
            "is_new", "year", "mileage"] + jobs.COMPLETE_CASE_COLUMNS
    rows = []
    for i, (make, hp) in enumerate([("x", None), ("x", None), ("x", 1.0), ("y", 2.0), ("y", 3.0)]):
        other = [1.0] * (len(jobs.COMPLETE_CASE_COLUMNS) - 1)
        rows.append((make, f"b{i % 2}", f"t{i % 2}", f"c{i % 2}", f"S{i % 2}", "m", 0, 2000 + i, 10.0 * i,
                     hp, *other))
    schema = ", ".join(f"{c} string" for c in cols[:6]) + ", is_new int, year int, mileage double, " + \
        ", ".join(f"{c} double" for c in jobs.COMPLETE_CASE_COLUMNS)
    df = spark.createDataFrame(rows, schema)
    state_means = impute.mileage_by_state(df)
    no_means = impute.means_by_model(df.limit(0))
    m_all, out_all = jobs.impute_and_encode(df, state_means, no_means)
    m_cc, out_cc = jobs.impute_and_encode(df, state_means, no_means, filter_before_encoding=True)
    assert m_all.stages[0].labelsArray[1] == ["x", "y"]
    assert m_cc.stages[0].labelsArray[1] == ["y", "x"]
    assert out_all.count() == out_cc.count() == 3
