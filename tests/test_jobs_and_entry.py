"""Whole jobs on sf0.001 through CSV files, and the driver contract."""
import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as E
from autoscope.plans import jobs
from autoscope.sources import io, testdata


def test_jobs_end_to_end(spark, tmp_path):
    raw_csv, cities_csv = str(tmp_path / "raw.csv"), str(tmp_path / "cities.csv")
    io.write_csv(testdata.raw_listings(spark, SF_SMALL), raw_csv, null_value="")
    io.write_csv(testdata.raw_cities(spark, SF_SMALL), cities_csv, null_value="")
    out = str(tmp_path / "out")
    p = jobs.prepare(spark, raw_csv, cities_csv, out)
    full = io.read_parquet(spark, p.cleaned)
    sample = io.read_parquet(spark, p.sample)
    assert full.count() >= 6000 and 0 < sample.count() < full.count()
    assert dict(full.dtypes)["listed_date"] == "date" and dict(full.dtypes)["is_new"] == "int"
    m = jobs.means(spark, p.cleaned, out)
    xy_path = jobs.features(spark, p.sample, m, f"{out}/xy.parquet")
    xy = io.read_parquet(spark, xy_path)
    assert xy.columns == ["features", "label"] and xy.count() > 0
    from autoscope.operators import models
    res = jobs.train(spark, xy_path, out, estimator=models.ridge(), run_id="test")
    row = res.metrics.first()
    assert row.n > 0 and row.rmse > 0
    assert io.read_parquet(spark, res.predictions_path).count() == row.n


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)


FAST = ["state_stats", "share_model", "top_model_per_state", "null_profile", "clean_all",
        "impute_group_means", "corr_matrix", "row_key", "hash_split", "onehot_rows", "ridge_fit",
        "map_table", "csv_roundtrip", "summary_stats", "geojson_parts", "spot_check_group_means", "groups_still_missing",
        "random_split_sizes", "eval_metrics", "save_load_scores"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    norm = lambda cols, rows: sorted(repr([r[cols.index(c)] for c in sorted(cols)]) for r in rows)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(ocols, rel.fetchall())
