"""Scans and sinks: quoted multi-line CSV, Parquet, literal table, GeoJSON."""
import json

import pytest

from autoscope.operators import geo
from autoscope.sources import io


def test_csv_doubled_quotes_and_newlines(spark, tmp_path):
    p = tmp_path / "listings.csv"
    p.write_text('vin,description,price\n'
                 'A1,"CERTIFIED ""Pay the Least"" wipers",100\n'
                 'B2,"line one\nline two",200\n'
                 'C3,,\n')
    df = io.read_csv(spark, str(p), columns=["vin", "description", "price"])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("A1", 'CERTIFIED "Pay the Least" wipers', "100"),
                    ("B2", "line one\nline two", "200"),
                    ("C3", None, None)]


def test_csv_round_trip_keeps_values(spark, tmp_path):
    data = [("a", ' x "q" \n y ', ""), ("b", None, " 12 ")]
    df = spark.createDataFrame(data, "k string, t string, u string")
    io.write_csv(df, str(tmp_path / "out"))
    back = io.read_csv(spark, str(tmp_path / "out"), columns=df.columns, null_value=io.NULL_MARKER)
    assert sorted(tuple(r) for r in back.collect()) == sorted(data)


def test_parquet_round_trip(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id as double) / 3 as x")
    io.write_parquet(df, str(tmp_path / "p"))
    assert sorted(io.read_parquet(spark, str(tmp_path / "p")).collect()) == sorted(df.collect())


def test_extra_cities_literal(spark):
    df = io.extra_cities(spark)
    assert df.count() == 21 and df.columns == ["city", "city_ascii", "state_id", "state_name"]


def test_geojson_collection_and_parts(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "AA", "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "id": "BB", "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}},
        {"type": "Feature", "id": "CC", "geometry": {"type": "Polygon", "coordinates": [ring]}},
    ]}
    p = tmp_path / "states.json"
    p.write_text(json.dumps(doc, indent=2))
    feats = io.read_geojson(spark, str(p))
    parts = geo.explode_parts(feats)
    got = sorted((r.feature_pos, r.state_id, r.part, len(r.polygon)) for r in parts.collect())
    assert got == [(0, "AA", 0, 1), (1, "BB", 0, 1), (1, "BB", 1, 2), (2, "CC", 0, 1)]
    kept = geo.drop_part(parts, 1, 1)
    assert kept.count() == 3


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    row = io.read_csv(spark, str(tmp_path / "x.csv"), columns=["a", "b"]).first()
    assert (row.a, row.b) == ("2", "1")


def test_drop_part_keeps_rows_without_a_position(spark):
    from autoscope.operators import geo
    parts = spark.range(40).selectExpr("cast(null as int) as feature_pos", "'S' as state_id", "cast(id as int) as part")
    assert geo.drop_part(parts).count() == 40
    assert geo.drop_part(parts, state_id="S").count() == 39


def test_scratch_is_removed_and_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    import os
    from autoscope import session
    with session.scratch(spark):
        path = session.materialize(spark.range(3), "t").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})
    monkeypatch.setattr(session, "SparkSession", object)
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(type("S", (), {"sparkContext": Context}))


def test_runs_are_replaced_whole(spark, tmp_path):
    from autoscope.sources.io import read_runs, write_run
    path = str(tmp_path / "runs")
    for run_id, n in (("1", 5), ("2024-01-01", 3), ("1", 2)):
        write_run(spark.range(n).selectExpr("id", "id * 2.0 as prediction"), path, run_id)
    # an attempt that never reached the manifest
    spark.range(9).selectExpr("id", "id * 1.0 as prediction", "'3' as run_id", "'x' as attempt").write.mode("append").partitionBy(
        "run_id", "attempt").parquet(f"{path}/rows")
    got = {r["run_id"]: r["count"] for r in read_runs(spark, path).groupBy("run_id").count().collect()}
    assert got == {"1": 2, "2024-01-01": 3}


def test_level_that_only_the_test_part_holds(spark):
    from autoscope.operators import features as FE
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("b",), ("z",)], "c string")
    model = FE.fit_encoding(test, ["c"], fit_on=train)
    got = {r["c"]: (r["c_numeric"], r["c_hot"]) for r in FE.hot_positions(model.transform(test), ["c"]).collect()}
    assert got == {"b": (1.0, 1), "z": (2.0, -1)}


def test_compressed_csv_round_trip(spark, tmp_path):
    rows = [("a", 'say "x"\nand, more', None), ("b", "", " pad "), ("c", "é\n\n", "\\")]
    path = str(tmp_path / "csv")
    io.write_csv(spark.createDataFrame(rows, "k string, t string, u string").repartition(2), path, compression="lz4")
    assert all(f.name.endswith(".csv.lz4") for f in (tmp_path / "csv").glob("part-*"))
    got = io.read_csv(spark, path, columns=["k", "t", "u"], null_value=io.NULL_MARKER).collect()
    assert sorted(map(tuple, got)) == rows


def test_round_trip_query_writes_the_rows_once_and_compressed(spark, tmp_path):
    from autoscope.plans.queries import QUERIES
    df = QUERIES["csv_roundtrip"](spark, "/root/testdata/sf0.001")
    files = df.inputFiles()
    assert files and all(f.endswith(".csv.lz4") for f in files)


def test_listings_in_parts_are_the_same_rows(spark, monkeypatch, tmp_path):
    """Parts prepared one after the other make the same table, and leave no CSV and no setting behind."""
    from collections import Counter

    from autoscope.plans import jobs, listings, queries
    from autoscope.sources import testdata
    d, setting = "/root/testdata/sf0.001", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    rows = lambda df: Counter(tuple(r) for r in df.drop("rowno").collect())
    plain = testdata.derive_raw_listings(spark, d)
    prepared = listings.prepare(plain, testdata.raw_cities(spark, d))
    assert len(testdata.raw_listing_parts(spark, d)) == 1
    monkeypatch.setattr(testdata, "PART_BYTES", 50_000)
    monkeypatch.setattr(testdata, "_LANDED", {})
    monkeypatch.setattr(queries, "_scratch", lambda spark, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    parts = testdata.raw_listing_parts(spark, d)
    assert len(parts) > 1 and all(p.count() for p in parts)
    for name in ("csv_roundtrip", "csv_split_scan"):
        assert rows(queries.QUERIES[name](spark, d)) == rows(plain)
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["rows", "rows"]
    whole = listings.listings(spark, d)
    assert rows(whole.select(prepared.columns)) == rows(prepared)
    assert whole.select("rowno").distinct().count() == plain.count()
    done = jobs.prepare(spark, parts, testdata.raw_cities(spark, d), str(tmp_path / "jobs"))
    assert rows(spark.read.parquet(done.cleaned).select(prepared.columns)) == rows(prepared)
    assert spark.conf.get(setting) == before


def test_materialize_leaves_no_shuffle_files(spark):
    import time

    from autoscope.session import materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = held()
    df = spark.range(10_000).selectExpr("id % 1000 AS k").groupBy("k").count()
    written = [materialize(df) for _ in range(2)]
    for _ in range(100):
        if not held() - before:
            break
        time.sleep(0.1)
    assert not held() - before
    assert [w.count() for w in written] == [1000, 1000] and df.count() == 1000
