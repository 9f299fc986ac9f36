"""One key holding a third of all rows: results stay whole and exact."""
import math
import random

import pandas as pd

from autoscope.operators import enrich, impute, stats


def skewed(spark, n=30000):
    random.seed(7)
    rows = []
    for i in range(n):
        state = "HOT" if i % 3 == 0 else f"S{i % 97}"
        model = "m0" if i % 3 == 0 else f"m{i % 13}"
        hp = None if i % 5 == 0 else float(100 + i % 50)
        rows.append((f"k{i}", state, model, hp, float(i % 1000)))
    pdf = pd.DataFrame(rows, columns=["listing_key", "state_id", "model_name", "horsepower", "price"])
    return spark.createDataFrame(pdf).repartition(12), pdf


def test_hot_key_aggregates_and_shares(spark):
    df, pdf = skewed(spark)
    got = {r.state_id: r for r in stats.group_stats(df.withColumn("mileage", df.price)).collect()}
    assert got["HOT"].trans_count == 10000
    assert math.isclose(got["HOT"].mean_price, pdf[pdf.state_id == "HOT"].price.mean())
    share = {r.state_id: r for r in stats.category_share(df, "state_id", count_col=None).collect()}
    assert share["HOT"].n == 10000 and math.isclose(share["HOT"].cum_percent, 10000 * 100.0 / 30000)
    assert math.isclose(max(r.cum_percent for r in share.values()), 100.0)
    top = {r.state_id: r.model_name for r in stats.top_per_group(df, "state_id", "model_name").collect()}
    assert top["HOT"] == "m0"


def test_hot_key_group_mean_fill(spark):
    df, pdf = skewed(spark)
    out = impute.impute_group_means(df, ["state_id"], ["horsepower"], null_keys_match=True, keep_means=False)
    assert out.count() == 30000 and out.filter("horsepower IS NULL").count() == 0
    hot_mean = pdf[pdf.state_id == "HOT"].horsepower.mean()
    filled = out.filter("state_id = 'HOT' AND listing_key IN ('k0', 'k15')").collect()
    assert all(math.isclose(r.horsepower, hot_mean) for r in filled)


def test_hot_key_lookup_join(spark):
    df, _ = skewed(spark)
    dim = spark.createDataFrame([("HOT", "hot state"), ("S1", "one")], "key string, name string")
    lst = df.selectExpr("listing_key", "state_id AS city")
    joined = enrich.attach_state(lst, dim.selectExpr("key AS us_city", "name AS state_id", "name AS state_name"))
    assert joined.count() == 30000
    assert joined.filter("state_id = 'hot state'").count() == 10000
