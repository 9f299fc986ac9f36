"""Plan properties that matter at scale: pruning, pushdown, partial
aggregation, one projection for the whole cleaning chain."""
import contextlib
import io as _io

from conftest import SF_SMALL

import __spark_entry__ as E
from autoscope.plans import listings as L


def plan(df, mode="formatted"):
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_state_stats_prunes_and_pushes(spark):
    p = plan(E.queries()["state_stats"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(state_id)]" in p
    assert "ReadSchema: struct<price:double,mileage:double,state_id:string>" in p
    assert p.count("HashAggregate") >= 2  # partial + final


def test_group_mean_fill_aggregates_before_join(spark):
    p = plan(E.queries()["impute_group_means"](spark, SF_SMALL))
    assert "LeftOuter" in p and "Window" not in p
    # the aggregate itself, one partial row per task
    from autoscope.operators import impute
    assert plan(impute.means_by_model(L.listings(spark, SF_SMALL))).count("HashAggregate") >= 2


def test_cleaning_is_one_projection(spark):
    """51 rules -> one Project (plus the surrogate-key Project below it, which
    holds a nondeterministic expression and is not merged), no exchange."""
    df = L.cleaned(spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project") == 2
    assert "Exchange" not in plan(df)


def test_top_per_group_has_no_window(spark):
    p = plan(E.queries()["top_model_per_state"](spark, SF_SMALL))
    assert "Window" not in p and p.count("HashAggregate") >= 2


def test_small_means_do_not_shuffle_the_listings(spark):
    """The means are written before the join, so their size is known: with a
    threshold above it no exchange stands on the listings' side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        small = E.queries()["impute_mileage"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = E.queries()["impute_mileage"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in large
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dense_key_shuffles_once(spark, monkeypatch):
    from autoscope.operators import stats
    written = []
    monkeypatch.setattr(stats, "materialize", lambda df, name="cut": written.append(df) or df)
    stats.dense_row_key(spark.range(100).selectExpr("cast(id as string) as k"), ["k"])
    assert plan(written[0], "simple").count("Exchange") == 1


def test_queries_prepare_only_their_columns(spark):
    """An analysis of few columns has no others derived, shuffled or written."""
    for name, columns in (("unmatched_total", ["us_city"]), ("hash_split", ["listing_key"])):
        files = E.queries()[name](spark, SF_SMALL).inputFiles()
        assert spark.read.parquet(*files).columns == columns
    assert E.queries()["clean_int"](spark, SF_SMALL).inputFiles()[0].endswith(".parquet")
    assert "tables/" not in str(E.queries()["clean_int"](spark, SF_SMALL).inputFiles())
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
