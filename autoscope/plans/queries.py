"""Named queries: each is a Spark plan over the test tables plus its SQL twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``
(DuckDB SQL over the pre-registered tables).  Float outputs are rounded to
6 decimals in both so summation order cannot change the comparison.
Queries without a SQL twin (random or iterative operators) are listed in
``ROWS_ONLY`` and are checked by invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoscope.functions import clean as C
from autoscope.operators import enrich, impute, profile, stats
from autoscope.operators.features import NUMERIC_FEATURES
from autoscope.plans import linear_sql
from autoscope.plans import listings as L
from autoscope.plans.oracle import rule, with_listings
from autoscope.sources import testdata

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
ROWS_ONLY: set[str] = set()

R = 6  # decimals kept for float outputs


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is None:
            ROWS_ONLY.add(name)
        else:
            ORACLE[name] = sql
        return fn
    return deco


NUDGE = 1e-8  # same in the SQL twins


def rnd(col: str, alias: str | None = None):
    """Round to R decimals after a 1e-8 nudge.  A mean that is an exact
    decimal tie (e.g. 34.3609375) comes out one ulp above in one engine and
    one ulp below in another (summation order); the nudge -- far above ulp
    noise, far below the 1e-6 grid -- sends both the same way."""
    return F.round(F.col(col) + NUDGE, R).alias(alias or col)


# ---------------------------------------------------------------------------
# State statistics
# ---------------------------------------------------------------------------
_STATE_STATS_SQL = ("SELECT state_id, avg(price) AS mean_price, avg(mileage) AS mean_mileage, "
                    "count(state_id) AS trans_count FROM listings WHERE state_id IS NOT NULL "
                    "GROUP BY state_id")


def _state_stats(spark, d):
    return stats.group_stats(L.listings(spark, d, "state_id", "price", "mileage"), "state_id")


@register("state_stats", with_listings(
    f"SELECT state_id, round(mean_price + 1e-8, {R}) AS mean_price, round(mean_mileage + 1e-8, {R}) AS mean_mileage, "
    f"trans_count FROM ({_STATE_STATS_SQL}) s"))
def q_state_stats(spark, d):
    return _state_stats(spark, d).select("state_id", rnd("mean_price"), rnd("mean_mileage"), "trans_count")


@register("state_top5_price", with_listings(
    f"SELECT state_id, round(mean_price + 1e-8, {R}) AS mean_price FROM ({_STATE_STATS_SQL}) s "
    "ORDER BY s.mean_price DESC, state_id LIMIT 5"))
def q_state_top5_price(spark, d):
    top = stats.top_n(_state_stats(spark, d), 5, [F.desc("mean_price"), "state_id"])
    return top.select("state_id", rnd("mean_price"))


@register("state_bottom5_mileage", with_listings(
    f"SELECT state_id, round(mean_mileage + 1e-8, {R}) AS mean_mileage FROM ({_STATE_STATS_SQL}) s "
    "ORDER BY s.mean_mileage ASC, state_id LIMIT 5"))
def q_state_bottom5_mileage(spark, d):
    low = stats.top_n(_state_stats(spark, d), 5, [F.asc("mean_mileage"), "state_id"])
    return low.select("state_id", rnd("mean_mileage"))


@register("stats_excluding_state", with_listings(
    f"SELECT state_id, round(mean_price + 1e-8, {R}) AS mean_price, round(mean_mileage + 1e-8, {R}) AS mean_mileage, "
    f"trans_count FROM ({_STATE_STATS_SQL}) s WHERE state_id <> "
    f"(SELECT state_id FROM ({_STATE_STATS_SQL}) t ORDER BY mean_price DESC, state_id LIMIT 1)"))
def q_stats_excluding_state(spark, d):
    """Drop the outlier state -- the one with the highest mean price."""
    s = _state_stats(spark, d)
    outlier = stats.top_n(s, 1, [F.desc("mean_price"), "state_id"]).select("state_id")
    return (s.filter(F.col("state_id") != outlier.scalar())
             .select("state_id", rnd("mean_price"), rnd("mean_mileage"), "trans_count"))


# ---------------------------------------------------------------------------
# Share tables
# ---------------------------------------------------------------------------
def _share_sql(key: str, drop_null: bool, running: bool) -> str:
    where = f"WHERE {key} IS NOT NULL" if drop_null else ""
    cum = (f", round(sum(n) OVER (ORDER BY n DESC, {key} ASC NULLS FIRST "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / "
           f"(SELECT count(*) FROM listings) + 1e-8, {R}) AS cum_percent") if running else ""
    return with_listings(
        f"SELECT {key}, n, round(n * 100.0 / (SELECT count(*) FROM listings) + 1e-8, {R}) AS percent{cum} "
        f"FROM (SELECT {key}, count(*) AS n FROM listings {where} GROUP BY {key}) g")


def _share_query(key: str, drop_null: bool, running: bool) -> QueryFn:
    def fn(spark, d):
        out = stats.category_share(L.listings(spark, d, "rowno", key), key, drop_null=drop_null, running=running)
        cols = [key, "n", rnd("percent")] + ([rnd("cum_percent")] if running else [])
        return out.select(*cols)
    return fn


for _key, _drop, _run, _name in [("make_name", False, True, "share_make"),
                                 ("model_name", False, True, "share_model"),
                                 ("body_type", True, True, "share_body"),
                                 ("engine_type", True, True, "share_engine"),
                                 ("listing_color", True, True, "share_color"),
                                 ("fuel_type", False, False, "share_fuel")]:
    register(_name, _share_sql(_key, _drop, _run))(_share_query(_key, _drop, _run))


# ---------------------------------------------------------------------------
# Most popular model / body type per state
# ---------------------------------------------------------------------------
def _top_per_state_sql(key: str) -> str:
    return with_listings(
        f"SELECT state_id, {key}, n FROM (SELECT state_id, {key}, n, row_number() OVER "
        f"(PARTITION BY state_id ORDER BY n DESC, {key}) AS rk FROM (SELECT state_id, {key}, "
        f"count(*) AS n FROM listings WHERE state_id IS NOT NULL AND {key} IS NOT NULL "
        f"GROUP BY state_id, {key}) c) r WHERE rk = 1")


@register("top_model_per_state", _top_per_state_sql("model_name"))
def q_top_model_per_state(spark, d):
    return stats.top_per_group(L.listings(spark, d, "state_id", "model_name"), "state_id", "model_name")


@register("top_body_per_state", _top_per_state_sql("body_type"))
def q_top_body_per_state(spark, d):
    return stats.top_per_group(L.listings(spark, d, "state_id", "body_type"), "state_id", "body_type")


# ---------------------------------------------------------------------------
# Preview and profiles
# ---------------------------------------------------------------------------
_PREVIEW_COLS = ["listing_key", "make_name", "model_name", "price", "mileage", "year", "state_id"]


@register("preview", with_listings(
    f"SELECT {', '.join(_PREVIEW_COLS)} FROM listings ORDER BY listing_key, state_id NULLS FIRST LIMIT 10"))
def q_preview(spark, d):
    from autoscope.sources.io import preview
    lst = L.listings(spark, d, *_PREVIEW_COLS).select(*_PREVIEW_COLS)
    return preview(lst, 10, [F.asc("listing_key"), F.asc_nulls_first("state_id")])


def _raw_with_rowno(spark, d):
    return C.with_row_number(testdata.derive_raw_listings(spark, d))


def _null_profile_sql() -> str:
    names = [n for n, _ in testdata.RAW_LISTING_COLUMNS] + ["rowno"]
    parts = []
    for n in names:
        cnt = "0" if n == "rowno" else f"count(*) FILTER (WHERE {n} IS NULL)"
        parts.append(f"SELECT '{n}' AS col_name, CAST({cnt} AS BIGINT) AS null_count, "
                     f"CAST({cnt} AS DOUBLE) / count(*) AS ratio FROM raw")
    return with_listings(" UNION ALL ".join(parts))


@register("null_profile", _null_profile_sql())
def q_null_profile(spark, d):
    return profile.null_profile(_raw_with_rowno(spark, d))


@register("shape", with_listings(
    "SELECT count(*) AS n_rows, CAST(" + str(len(testdata.RAW_LISTING_COLUMNS) + 1) + " AS BIGINT) AS n_cols FROM raw"))
def q_shape(spark, d):
    return profile.shape(_raw_with_rowno(spark, d))


@register("distinct_values", with_listings(
    "SELECT DISTINCT body_type FROM listings ORDER BY body_type NULLS FIRST"))
def q_distinct_values(spark, d):
    return profile.distinct_values(L.listings(spark, d, "body_type"), "body_type")


# ---------------------------------------------------------------------------
# Cleaning rules, one query per rule family plus the whole chain
# ---------------------------------------------------------------------------
def _rule_query(cols: list[str]) -> tuple[str, QueryFn]:
    sel_sql = ", ".join(f"{c} AS raw_{c}, {rule(C.LISTING_SPEC[c], c)} AS {c}" for c in cols)
    sql = with_listings(f"SELECT listing_key, {sel_sql} FROM raw")

    def fn(spark, d):
        raw = testdata.derive_raw_listings(spark, d)
        exprs = []
        for c in cols:
            exprs += [F.col(c).alias(f"raw_{c}"), C.RULES[C.LISTING_SPEC[c]](c).alias(c)]
        return raw.select("listing_key", *exprs)
    return sql, fn


_RULE_QUERIES = {
    "clean_lower": ["body_type", "make_name", "listing_color", "transmission_display", "fuel_type"],
    "clean_double": ["price", "mileage", "horsepower", "latitude", "longitude", "savings_amount"],
    "clean_int": ["daysonmarket", "dealer_zip", "owner_count", "year"],
    "clean_flag": ["fleet", "frame_damaged", "franchise_dealer", "has_accidents", "isCab",
                   "is_new", "salvage", "theft_title"],
    "clean_date": ["listed_date"],
    "number_before_space": ["back_legroom", "fuel_tank_volume", "height", "wheelbase", "power", "torque"],
    "cylinders": ["engine_cylinders"],
    "engine_family": ["engine_type"],
    "city_key": ["city"],
    "model_key": ["model_name"],
}
for _name, _cols in _RULE_QUERIES.items():
    _sql, _fn = _rule_query(_cols)
    register(_name, _sql)(_fn)


@register("clean_all", with_listings("SELECT * FROM clean"))
def q_clean_all(spark, d):
    return L.cleaned_once(spark, d).drop("rowno")


@register("drop_cols", with_listings(
    "SELECT " + ", ".join(n for n, _ in testdata.RAW_LISTING_COLUMNS if n not in C.DROPPED_COLUMNS)
    + " FROM raw"))
def q_drop_cols(spark, d):
    return C.drop_columns(testdata.derive_raw_listings(spark, d))


@register("fill_sentinel", with_listings(
    "SELECT listing_key, " + ", ".join(f"coalesce({c}, 'N/A') AS {c}" for c in impute.CATEGORICAL_COLUMNS)
    + " FROM listings"))
def q_fill_sentinel(spark, d):
    cols = ["listing_key", *impute.CATEGORICAL_COLUMNS]
    lst = L.listings(spark, d, *cols).select(*cols)
    return impute.fill_sentinel(lst)


# ---------------------------------------------------------------------------
# City -> state enrichment
# ---------------------------------------------------------------------------
@register("city_state_join", with_listings(
    "SELECT listing_key, city, us_city, state_id, state_name FROM listings"))
def q_city_state_join(spark, d):
    cols = ["listing_key", "city", "us_city", "state_id", "state_name"]
    return L.listings(spark, d, *cols).select(*cols)


@register("unmatched_cities", with_listings(
    "SELECT city, count(*) AS n_rows FROM listings WHERE us_city IS NULL GROUP BY city"))
def q_unmatched_cities(spark, d):
    return enrich.unmatched_by_key(L.listings(spark, d, "city", "us_city"))


@register("unmatched_total", with_listings(
    "SELECT count(*) FILTER (WHERE us_city IS NULL) AS n_unmatched FROM listings"))
def q_unmatched_total(spark, d):
    return enrich.unmatched_total(L.listings(spark, d, "us_city"))


@register("city_union", with_listings("SELECT us_city, state_id, state_name FROM cities"))
def q_city_union(spark, d):
    return L.city_table(spark, d)


# ---------------------------------------------------------------------------
# Group-mean tables (the means job)
# ---------------------------------------------------------------------------
# the columns of the means and the features job
_FEATURE_COLUMNS = ["listing_key", "price", "year", "mileage", "is_new", "model_name", *impute.CATEGORICAL_COLUMNS, *impute.MODEL_MEASURES]


def _feature_listings(spark, d):
    return L.listings(spark, d, *_FEATURE_COLUMNS)


_FILL_MEANS = {c: f"coalesce({c}, 'N/A')" for c in impute.MEANS_FILL_COLUMNS}


def _filled_listing_sql(fills: dict[str, str]) -> str:
    """``listings`` with some text columns replaced by their filled value."""
    return "SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in fills.items()) + ") FROM listings"


_MEANS_MODEL_SQL = ("SELECT model_name, make_name, " + ", ".join(
    f"avg({c}) AS mean_{c}" for c in impute.MODEL_MEASURES)
    + f" FROM ({_filled_listing_sql(_FILL_MEANS)}) f GROUP BY model_name, make_name")
_MEAN_MILEAGE_SQL = ("SELECT coalesce(state_id, 'N/A') AS state_id, avg(mileage) AS mean_mileage "
                     "FROM listings GROUP BY 1")


@register("mean_by_state", with_listings(
    f"SELECT state_id, round(mean_mileage + 1e-8, {R}) AS mean_mileage FROM ({_MEAN_MILEAGE_SQL}) m"))
def q_mean_by_state(spark, d):
    return impute.mileage_by_state(_feature_listings(spark, d)).select("state_id", rnd("mean_mileage"))


@register("means_by_model", with_listings(
    "SELECT model_name, make_name, " + ", ".join(f"round(mean_{c} + 1e-8, {R}) AS mean_{c}" for c in impute.MODEL_MEASURES)
    + f" FROM ({_MEANS_MODEL_SQL}) m"))
def q_means_by_model(spark, d):
    m = impute.means_by_model(_feature_listings(spark, d))
    return m.select("model_name", "make_name", *[rnd(f"mean_{c}") for c in impute.MODEL_MEASURES])


@register("means_by_body", with_listings(
    "SELECT make_name, body_type, " + ", ".join(f"round(avg({c}) + 1e-8, {R}) AS mean_{c}" for c in impute.BODY_MEASURES)
    + f" FROM ({_filled_listing_sql(_FILL_MEANS)}) f GROUP BY make_name, body_type"))
def q_means_by_body(spark, d):
    m = impute.means_by_body(_feature_listings(spark, d))
    return m.select("make_name", "body_type", *[rnd(f"mean_{c}") for c in impute.BODY_MEASURES])


@register("groups_still_missing", with_listings(
    "SELECT model_name, make_name FROM (" + _MEANS_MODEL_SQL + ") m WHERE "
    + " OR ".join(f"mean_{c} IS NULL" for c in impute.MODEL_MEASURES)))
def q_groups_still_missing(spark, d):
    """Groups whose mean is still null -- imputation cannot help them."""
    m = impute.means_by_model(_feature_listings(spark, d))
    return profile.groups_still_missing(m, [f"mean_{c}" for c in impute.MODEL_MEASURES]).select("model_name", "make_name")


# ---------------------------------------------------------------------------
# K1-K5: imputation (the features job up to encoding)
# ---------------------------------------------------------------------------
_FILL_FEATURES = {c: f"coalesce({c}, 'N/A')" for c in impute.CATEGORICAL_COLUMNS}


def _mileage_sql(keep_observed: bool) -> str:
    new = "CASE WHEN is_new = 1 THEN 5 END"
    if keep_observed:
        old, filled = "mileage", f"coalesce({new}, mileage, mean_mileage)"
    else:
        old, filled = new, f"coalesce({new}, mean_mileage)"
    return (f"SELECT f.* REPLACE ({filled} AS mileage), {old} AS old_mileage "
            f"FROM ({_filled_listing_sql(_FILL_FEATURES)}) f "
            f"LEFT JOIN ({_MEAN_MILEAGE_SQL}) m ON f.state_id = m.state_id")


def _means(spark, d, name: str):
    """A table of the means job, written once: its size is known before a
    join on it is planned, so a small one is broadcast at once and the
    listings are not shuffled for it."""
    return testdata.landed(spark, d, name, lambda: getattr(impute, name)(_feature_listings(spark, d)))


def _features_stage(spark, d, keep_observed: bool = False):
    """K1 -> K2 over the prepared listings, means from the means job."""
    lst = _feature_listings(spark, d)
    return impute.impute_mileage(impute.fill_sentinel(lst), _means(spark, d, "mileage_by_state"), keep_observed)


def _mileage_query(keep_observed: bool):
    sql = with_listings(
        f"SELECT listing_key, state_id, is_new, old_mileage, round(mileage + 1e-8, {R}) AS mileage "
        f"FROM ({_mileage_sql(keep_observed)}) q")

    def fn(spark, d):
        out = _features_stage(spark, d, keep_observed)
        return out.select("listing_key", "state_id", "is_new", "old_mileage", rnd("mileage"))
    return sql, fn


for _name, _keep in [("impute_mileage", False), ("impute_mileage_keep_observed", True)]:
    _sql, _fn = _mileage_query(_keep)
    register(_name, _sql)(_fn)


@register("spot_check_mileage", with_listings(
    f"SELECT state_id, old_mileage, round(mileage + 1e-8, {R}) AS mileage, is_new FROM "
    f"({_mileage_sql(False)}) q WHERE old_mileage IS NULL"))
def q_spot_check_mileage(spark, d):
    """Listings whose (rewritten) mileage was missing, before and after."""
    out = _features_stage(spark, d).withColumn("mileage", rnd("mileage"))
    return profile.spot_check(out, "old_mileage", ["state_id", "old_mileage", "mileage", "is_new"])


_GROUP_FILL_SQL = (
    "SELECT g.* REPLACE (" + ", ".join(f"coalesce(CAST(g.{c} AS DOUBLE), m.mean_{c}) AS {c}" for c in impute.MODEL_MEASURES)
    + f") FROM ({_mileage_sql(False)}) g LEFT JOIN ({_MEANS_MODEL_SQL}) m "
    "ON g.make_name = m.make_name AND g.model_name = m.model_name")
_IMPUTED_COLS = ["listing_key", "make_name", "model_name"]


def _imputed(spark, d):
    """K1 -> K2 -> K3/K4 with means from the means job."""
    stage = _features_stage(spark, d)
    means = _means(spark, d, "means_by_model")
    return impute.impute_group_means(stage, ["make_name", "model_name"], impute.MODEL_MEASURES, means=means)


@register("impute_group_means", with_listings(
    "SELECT listing_key, make_name, model_name, " + ", ".join(f"round({c} + 1e-8, {R}) AS {c}" for c in impute.MODEL_MEASURES)
    + f" FROM ({_GROUP_FILL_SQL}) q"))
def q_impute_group_means(spark, d):
    return _imputed(spark, d).select(*_IMPUTED_COLS, *[rnd(c) for c in impute.MODEL_MEASURES])


@register("spot_check_group_means", with_listings(
    "SELECT listing_key, " + ", ".join(
        f"CAST(g.{c} AS DOUBLE) AS old_{c}, round(coalesce(CAST(g.{c} AS DOUBLE), m.mean_{c}) + 1e-8, {R}) AS {c}"
        for c in impute.MODEL_MEASURES)
    + f" FROM ({_mileage_sql(False)}) g LEFT JOIN ({_MEANS_MODEL_SQL}) m "
    "ON g.make_name = m.make_name AND g.model_name = m.model_name WHERE "
    + " OR ".join(f"g.{c} IS NULL" for c in impute.MODEL_MEASURES)))
def q_spot_check_group_means(spark, d):
    """B8 on K3: rows that lacked a measure, all nine before and after."""
    before = _features_stage(spark, d).withColumns({f"old_{c}": F.col(c).cast("double") for c in impute.MODEL_MEASURES})
    after = impute.impute_group_means(before, ["make_name", "model_name"], impute.MODEL_MEASURES,
                                      means=_means(spark, d, "means_by_model"))
    return after.filter(profile.any_missing([f"old_{c}" for c in impute.MODEL_MEASURES])).select(
        "listing_key", *[f"old_{c}" for c in impute.MODEL_MEASURES], *[rnd(c) for c in impute.MODEL_MEASURES])


@register("impute_window", with_listings(
    "SELECT listing_key, make_name, model_name, " + ", ".join(
        f"round(coalesce(CAST({c} AS DOUBLE), avg({c}) OVER (PARTITION BY make_name, model_name)) + 1e-8, {R}) AS {c}"
        for c in impute.MODEL_MEASURES) + " FROM listings"))
def q_impute_window(spark, d):
    """K5: group-mean fill computed in-query; null keys form their own group
    (window semantics) via a null-safe join, not a window."""
    lst = _feature_listings(spark, d)
    out = impute.impute_group_means(lst, ["make_name", "model_name"], impute.MODEL_MEASURES, null_keys_match=True)
    return out.select(*_IMPUTED_COLS, *[rnd(c) for c in impute.MODEL_MEASURES])


from autoscope.plans.jobs import COMPLETE_CASE_COLUMNS  # noqa: E402  (fixed values live with the job)


@register("complete_cases", with_listings(
    "SELECT listing_key, make_name, model_name FROM (" + _GROUP_FILL_SQL + ") q WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in COMPLETE_CASE_COLUMNS)))
def q_complete_cases(spark, d):
    return profile.complete_cases(_imputed(spark, d), COMPLETE_CASE_COLUMNS).select(*_IMPUTED_COLS)


# ---------------------------------------------------------------------------
# Correlation matrix, colour-scale bounds
# ---------------------------------------------------------------------------
# The 18 numeric columns of the correlation matrix.
CORR_COLUMNS = ["price", "front_legroom", "back_legroom", "height", "width", "length", "wheelbase",
                "year", "mileage", "engine_cylinders", "fuel_tank_volume", "horsepower", "power", "torque",
                "savings_amount", "seller_rating", "city_fuel_economy", "highway_fuel_economy"]


def _corr_sql() -> str:
    from itertools import combinations
    pairs = list(combinations(CORR_COLUMNS, 2))
    aggs = ", ".join([f"corr({a}, {b}) AS p{i}" for i, (a, b) in enumerate(pairs)]
                     + [f"corr({c}, {c}) AS d{i}" for i, c in enumerate(CORR_COLUMNS)])
    items = []
    for i, (a, b) in enumerate(pairs):
        items.append(f"struct_pack(col_a := '{a}', col_b := '{b}', corr := round(p{i} + 1e-8, {R}))")
        items.append(f"struct_pack(col_a := '{b}', col_b := '{a}', corr := round(p{i} + 1e-8, {R}))")
    for i, c in enumerate(CORR_COLUMNS):
        items.append(f"struct_pack(col_a := '{c}', col_b := '{c}', corr := round(d{i} + 1e-8, {R}))")
    return with_listings(f"SELECT unnest([{', '.join(items)}], recursive := true) FROM (SELECT {aggs} FROM listings) w")


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, d):
    return stats.corr_matrix(L.listings(spark, d, *CORR_COLUMNS), CORR_COLUMNS).select("col_a", "col_b", rnd("corr"))


@register("count_bounds", with_listings(
    f"SELECT min(trans_count) AS min_trans_count, max(trans_count) AS max_trans_count FROM ({_STATE_STATS_SQL}) s"))
def q_count_bounds(spark, d):
    return stats.min_max(_state_stats(spark, d), "trans_count")


# ---------------------------------------------------------------------------
# C1 (dense), J1-J3: keys and splits
# ---------------------------------------------------------------------------
@register("row_key", with_listings(
    "SELECT listing_key, CAST(row_number() OVER (ORDER BY listing_key) AS BIGINT) AS row_key FROM clean"))
def q_row_key(spark, d):
    keys = testdata.landed_columns(spark, d, "cleaned", lambda: L.cleaned_once(spark, d), ("listing_key",))
    return stats.dense_row_key(keys, ["listing_key"], "row_key")


HASH32_SQL = "('0x' || substr(md5(coalesce(listing_key, '')), 1, 8))::BIGINT"
TRAIN_BOUND = round(0.8 * 2**32)


@register("hash_split", with_listings(
    f"SELECT listing_key, CASE WHEN {HASH32_SQL} < {TRAIN_BOUND} THEN 'train' ELSE 'test' END AS split FROM listings"))
def q_hash_split(spark, d):
    from autoscope.operators.split import with_split_label
    lst = L.listings(spark, d, "listing_key").select("listing_key")
    return with_split_label(lst, "listing_key", [0.8, 0.2], ["train", "test"])


# fixed values: the weights of the down-sample and of the two train/test splits
RANDOM_SPLITS = {"sample": [0.9, 0.1], "notebook": [0.8, 0.2], "job": [0.7, 0.3]}


@register("random_split_sizes", with_listings(" UNION ALL ".join(
    f"SELECT '{k}' AS split, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, true AS near_weight FROM listings"
    for k in RANDOM_SPLITS)))
def q_random_split_sizes(spark, d):
    """The seeded splits; rows of both parts together, rows in both,
    and whether the first part's share is within 4 sigma of its weight."""
    from functools import reduce

    from autoscope.operators.split import random_split
    lst = L.listings(spark, d, "rowno", "state_id").select("rowno", "state_id")
    rows = []
    for name, weights in RANDOM_SPLITS.items():
        a, b = (p.groupBy("rowno", "state_id").agg(F.count(F.lit(1)).alias(n)) for p, n in zip(random_split(lst, weights), "ab"))
        both = a.join(b, (a.rowno == b.rowno) & a.state_id.eqNullSafe(b.state_id), "full").select("a", "b")
        n, w = F.sum(F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))), weights[0]
        share = F.sum(F.coalesce("a", F.lit(0))) / n
        rows.append(both.agg(F.lit(name).alias("split"), n.alias("n_rows"),
                             F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n_in_both"),
                             (F.abs(share - w) < 4 * F.sqrt(F.lit(w * (1 - w)) / n)).alias("near_weight")))
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------------------
# Encoding, assembly, scaling (fit on the whole imputed table, as the
# features job does)
# ---------------------------------------------------------------------------
def _encoded(spark, d):
    from autoscope.operators import features as FE
    imp = _imputed(spark, d)
    model = FE.fit_encoding(imp)
    return model, model.transform(imp)


def _rank_cte(c: str) -> str:
    return (f"r_{c} AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS BIGINT) AS idx, "
            f"count(*) OVER () AS nlev FROM (SELECT {c} AS value, count(*) AS n FROM imp GROUP BY 1) g)")


_ENC_CTES = f"imp AS ({_GROUP_FILL_SQL}), " + ", ".join(_rank_cte(c) for c in impute.CATEGORICAL_COLUMNS)
_ENC_JOIN = "imp " + " ".join(f"JOIN r_{c} ON imp.{c} = r_{c}.value" for c in impute.CATEGORICAL_COLUMNS)


@register("index_categories", with_listings(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, value, idx FROM r_{c}" for c in impute.CATEGORICAL_COLUMNS),
    _ENC_CTES))
def q_index_categories(spark, d):
    from autoscope.operators import features as FE
    model, _ = _encoded(spark, d)
    return FE.index_table(spark, model)


@register("onehot_rows", with_listings(
    "SELECT listing_key, " + ", ".join(
        f"CAST(CASE WHEN r_{c}.idx < r_{c}.nlev - 1 THEN r_{c}.idx ELSE -1 END AS BIGINT) AS {c}_hot"
        for c in impute.CATEGORICAL_COLUMNS) + f" FROM {_ENC_JOIN}", _ENC_CTES))
def q_onehot_rows(spark, d):
    from autoscope.operators import features as FE
    _, enc = _encoded(spark, d)
    hot = FE.hot_positions(enc.select("listing_key", *FE.index_cols(impute.CATEGORICAL_COLUMNS),
                                      *FE.onehot_cols(impute.CATEGORICAL_COLUMNS)))
    return hot.select("listing_key", *[c + "_hot" for c in impute.CATEGORICAL_COLUMNS])


def _assembled(spark, d):
    """P3 up to the feature vector: encode, complete-case filter, assemble."""
    from autoscope.operators import features as FE
    model, enc = _encoded(spark, d)
    complete = profile.complete_cases(enc, COMPLETE_CASE_COLUMNS)
    return model, FE.assemble(complete, FE.model_inputs())


_COMPLETE_WHERE = " AND ".join(f"imp.{c} IS NOT NULL" for c in COMPLETE_CASE_COLUMNS)


def _assemble_sql() -> str:
    num = NUMERIC_FEATURES
    nhot = " + ".join(f"CASE WHEN r_{c}.idx < r_{c}.nlev - 1 THEN 1 ELSE 0 END" for c in impute.CATEGORICAL_COLUMNS)
    size = " + ".join(f"(r_{c}.nlev - 1)" for c in impute.CATEGORICAL_COLUMNS) + f" + {len(num)}"
    nnz = f"({nhot})" + "".join(f" + CASE WHEN CAST(imp.{c} AS DOUBLE) <> 0 THEN 1 ELSE 0 END" for c in num)
    vsum = f"CAST({nhot} AS DOUBLE)" + "".join(f" + CAST(imp.{c} AS DOUBLE)" for c in num)
    return (f"SELECT listing_key, CAST({size} AS INTEGER) AS size, CAST({nnz} AS INTEGER) AS nnz, "
            f"round({vsum} + 1e-8, {R}) AS vsum FROM {_ENC_JOIN} WHERE {_COMPLETE_WHERE}")


@register("assemble_rows", with_listings(_assemble_sql(), _ENC_CTES))
def q_assemble_rows(spark, d):
    from autoscope.operators import features as FE
    _, asm = _assembled(spark, d)
    return FE.vector_totals(asm.select("listing_key", "features")).select("listing_key", "size", "nnz", rnd("vsum"))


def _scaled_sql() -> str:
    num = NUMERIC_FEATURES
    cols = ", ".join(f"round(CAST(imp.{c} AS DOUBLE) / stddev_samp(CAST(imp.{c} AS DOUBLE)) OVER () + 1e-8, {R}) "
                     f"AS scaled_{c}" for c in num)
    return f"SELECT listing_key, {cols} FROM {_ENC_JOIN} WHERE {_COMPLETE_WHERE}"


@register("scaled_rows", with_listings(_scaled_sql(), _ENC_CTES))
def q_scaled_rows(spark, d):
    from pyspark.ml.functions import vector_to_array
    from autoscope.operators import features as FE
    _, asm = _assembled(spark, d)
    scaled = FE.fit_scaler(asm).transform(asm)
    arr = vector_to_array(F.col("scaledFeatures"))
    n_num = len(FE.NUMERIC_FEATURES)
    size = F.size(arr)
    return (scaled.select("listing_key", arr.alias("a"), size.alias("n"))
                  .select("listing_key", *[F.round(F.element_at("a", F.col("n") - (n_num - 1 - i)) + NUDGE, R)
                                           .alias(f"scaled_{c}") for i, c in enumerate(FE.NUMERIC_FEATURES)]))


# ---------------------------------------------------------------------------
# M1-M11, N1, N2, A6 on the full feature vector.  Train / test is the
# layout-independent hash split (80/20), folds another hash of the key.  The
# linear models are solved again in SQL (``plans.linear_sql``).
# ---------------------------------------------------------------------------
SIG = "%.4e"  # model outputs compared at 5 significant digits


def sig(col, alias: str):
    """A double rounded to 5 significant digits."""
    return F.format_string(SIG, col).cast("double").alias(alias)


def sig_sql(x: str) -> str:
    return f"CAST(printf('{SIG}', {x}) AS DOUBLE)"


FOLDS = linear_sql.FOLDS
FOLD_SQL = f"('0x' || substr(md5(coalesce(listing_key, '') || ':fold'), 1, 8))::BIGINT % {FOLDS}"
_DESIGN = linear_sql.design(_ENC_CTES, _ENC_JOIN, _COMPLETE_WHERE,
                            f"CASE WHEN {HASH32_SQL} < {TRAIN_BOUND} THEN 'train' ELSE 'test' END", FOLD_SQL)
_TRAIN, _TEST = "split = 'train'", "split = 'test'"


def _linear(select: str, penalties: list[float], rows: str = "true", folds: bool = False, more: str = "") -> str:
    """SQL over the solved models; the elimination is a recursive CTE."""
    return with_listings(select, f"{_DESIGN}, {linear_sql.solve(penalties, rows, folds)}{more}").replace("WITH ", "WITH RECURSIVE ", 1)


def _xy(spark, d):
    """P3 output with split and fold: ``(listing_key, features, label, split,
    fold)``, written once per application as the features job writes it."""
    from autoscope.operators.split import hash32, with_split_label

    def build():
        _, asm = _assembled(spark, d)
        xy = asm.filter(F.col("price").isNotNull()).select("listing_key", "features", F.col("price").alias("label"))
        fold = hash32(F.concat(F.coalesce("listing_key", F.lit("")), F.lit(":fold"))) % FOLDS
        return with_split_label(xy, "listing_key", [0.8, 0.2], ["train", "test"]).withColumn("fold", fold.cast("int"))

    return testdata.landed(spark, d, "xy", build)


def _train_test(spark, d):
    xy = _xy(spark, d)
    return xy.filter(F.col("split") == "train"), xy.filter(F.col("split") == "test")


def _scores(model, test):
    from autoscope.operators.evaluate import regression_metrics
    return regression_metrics(model.transform(test))


_TERM_ROWS = f"SELECT term, {sig_sql('value')} AS value FROM terms"


def _coef_rows(spark, model, xy):
    from autoscope.operators.models import coefficients, feature_names
    return coefficients(spark, model, feature_names(xy)).select("term", sig(F.col("value"), "value"))


@register("ridge_fit", _linear(_TERM_ROWS, [0.1], more=f", {linear_sql.TERMS}"))
def q_ridge_fit(spark, d):
    """M1, M3: ridge on the whole feature vector; its weights by name."""
    from autoscope.operators.models import ridge
    xy = _xy(spark, d)
    return _coef_rows(spark, ridge().fit(xy), xy)


@register("glr_fit", _linear(_TERM_ROWS, [0.2], more=f", {linear_sql.TERMS}"))
def q_glr_fit(spark, d):
    """M5, M3: gaussian GLR on the whole feature vector."""
    from autoscope.operators.models import glr
    xy = _xy(spark, d)
    return _coef_rows(spark, glr(reg_param=0.2).fit(xy), xy)


def _metrics_sql(pred_from: str, with_n: bool = True) -> str:
    n = "count(*) AS n, " if with_n else ""
    return (f"SELECT {n}{sig_sql('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2, "
            f"{sig_sql('sqrt(sum((y - p) * (y - p)) / count(*))')} AS rmse, "
            f"{sig_sql('avg(abs(y - p))')} AS mae, "
            f"{sig_sql(f'avg((p - (SELECT avg(y) FROM {pred_from})) * (p - (SELECT avg(y) FROM {pred_from})))')} "
            f"AS explained_variance FROM {pred_from}")


def _metric_cols(df):
    return df.select("n", *[sig(F.col(c), c) for c in ["r2", "rmse", "mae", "explained_variance"]])


@register("fit_summary", _linear(f"SELECT CAST(0 AS BIGINT) AS iterations, s.* FROM ({_metrics_sql('pred', with_n=False)}) s", [0.1],
                                 more=f", {linear_sql.predicted('true')}"))
def q_fit_summary(spark, d):
    """M2: the ridge model's training summary; the normal equations are solved
    without iterations."""
    from autoscope.operators.models import ridge, training_summary
    s = training_summary(spark, ridge().fit(_xy(spark, d)))
    return s.select("iterations", *[sig(F.col(c), c) for c in ["r2", "rmse", "mae", "explained_variance"]])


@register("eval_metrics", _linear(_metrics_sql("pred"), [0.1], _TRAIN, more=f", {linear_sql.predicted(_TEST)}"))
def q_eval_metrics(spark, d):
    """Fit on the train part, score the test part, all metrics in one pass."""
    from autoscope.operators.models import ridge
    train, test = _train_test(spark, d)
    return _metric_cols(_scores(ridge().fit(train), test))


@register("predict_ridge", _linear(f"SELECT listing_key, {sig_sql('p')} AS prediction FROM pred", [0.1], _TRAIN,
                                   more=f", {linear_sql.predicted(_TEST)}"))
def q_predict_ridge(spark, d):
    """M4: batch scoring of the test part."""
    from autoscope.operators.models import ridge
    train, test = _train_test(spark, d)
    return ridge().fit(train).transform(test).select("listing_key", sig(F.col("prediction"), "prediction"))


@register("run_output", _linear(
    f"SELECT CASE WHEN lam = 0.1 THEN '1' ELSE '2' END AS run_id, count(*) AS n_rows, {sig_sql('avg(p)')} AS mean_prediction, "
    f"{sig_sql('avg(abs(y - p))')} AS mae FROM pred GROUP BY lam", [0.1, 500.0], _TRAIN, more=f", {linear_sql.predicted(_TEST)}"))
def q_run_output(spark, d):
    """A5 + N3: the test predictions of two runs in one table, the first of
    them written twice; what a reader of the table sees."""
    from autoscope.operators.models import ridge
    from autoscope.sources.io import read_runs, write_run
    train, test = _train_test(spark, d)
    path = _scratch(spark, "runs")
    for run_id, penalty in (("1", 900.0), ("2", 500.0), ("1", 0.1)):
        pred = ridge(reg_param=penalty).fit(train).transform(test)
        write_run(pred.select("listing_key", "label", "prediction"), path, run_id)
    return read_runs(spark, path).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), sig(F.avg("prediction"), "mean_prediction"),
        sig(F.avg(F.abs(F.col("label") - F.col("prediction"))), "mae"))


@register("lr_report", _linear(
    f"SELECT term, {sig_sql('value')} AS value, {sig_sql('1 - sse / sst')} AS r2, CAST(0 AS INTEGER) AS iterations FROM terms, "
    "(SELECT sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst FROM pred) s", [0.1], _TRAIN,
    more=f", {linear_sql.TERMS}, {linear_sql.predicted(_TRAIN)}"))
def q_lr_report(spark, d):
    """M1 + M2 + M3: ridge on the train part; summary and named weights."""
    from autoscope.operators.models import ridge
    train, _ = _train_test(spark, d)
    model = ridge().fit(train)
    summ = model.summary
    return _coef_rows(spark, model, train).withColumns({"r2": sig(F.lit(float(summ.r2)), "r2"),
                                                        "iterations": F.lit(int(summ.totalIterations))})


# fixed values: the penalties of the grid
PENALTIES = [0.0, 0.2, 0.4, 0.6, 0.8]
#: a mean over folds at 10 significant digits: the penalties differ in the eighth
_CV_SQL = f", {linear_sql.predicted(_TRAIN + ' AND fold = id')}, scores AS (SELECT lam, avg(r2) AS r2 FROM (SELECT id, lam, " \
          "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM pred GROUP BY id, lam) f GROUP BY lam)"


@register("cv_glr", _linear("SELECT 'regParam' AS param, lam AS value, CAST(printf('%.9e', r2) AS DOUBLE) AS avg_metric FROM scores",
                            PENALTIES, _TRAIN, folds=True, more=_CV_SQL))
def q_cv_glr(spark, d):
    """M5 + M6 + M7 + M8: 5-fold CV of gaussian GLR over regParam {0,.2,.4,.6,.8},
    every fold and penalty solved from one pass of Gram matrices."""
    from autoscope.operators import gram
    train, _ = _train_test(spark, d)
    mean, _, _ = gram.cross_validate(train, "fold", PENALTIES)
    return spark.createDataFrame([("regParam", p, float(f"{m:.9e}")) for p, m in zip(PENALTIES, mean)],
                                 "param string, value double, avg_metric double")


@register("cv_glr_scores", _linear(
    f"SELECT best AS value, m.* FROM (SELECT arg_max(lam, r2) AS best FROM scores) b, ({_metrics_sql('tested')}) m", PENALTIES, _TRAIN, folds=True,
    more=_CV_SQL + f", tested AS (SELECT y, b0 + m_y + list_sum(list_transform(list_filter(e, lambda z: z.i BETWEEN 1 AND len(w)), "
         f"lambda z: z.v * w[z.i])) AS p FROM x, fit, mu WHERE {_TEST} AND id = -1 AND lam = (SELECT arg_max(lam, r2) FROM scores))"))
def q_cv_glr_scores(spark, d):
    """M4 + N1 of the cross-validated GLR: the best penalty, refitted on the
    train part and scored on the test part."""
    from autoscope.operators import gram
    train, test = _train_test(spark, d)
    _, best, model = gram.cross_validate(train, "fold", PENALTIES)
    return _metric_cols(_scores(model, test)).withColumn("value", F.lit(best))


@register("gbt_scores")
def q_gbt_scores(spark, d):
    """M9: boosted trees, depth 10, scored on the test part; the learner of
    ``gbt_cv`` with the bins of ``GBTRegressor``."""
    from autoscope.operators.models import boosted_gbt
    train, test = _train_test(spark, d)
    return _scores(boosted_gbt(max_depth=10).fit(train), test)


@register("boosted_alt_scores")
def q_boosted_alt_scores(spark, d):
    """The second-order boosted learner, scored on test."""
    from autoscope.operators.models import boosted_alt
    train, test = _train_test(spark, d)
    return _scores(boosted_alt().fit(train), test)


def _root_sql() -> str:
    """The best first split over all values, and its leaves, in SQL."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS name, n_{c} AS v, y FROM t" for c in NUMERIC_FEATURES)
    return with_listings(
        f"SELECT name AS feature, {sig_sql('v')} AS threshold, {sig_sql('gain')} AS gain, {sig_sql('-0.3 * gl / (nl + 1)')} AS left_value, "
        f"{sig_sql('0.3 * gl / (n - nl + 1)')} AS right_value, CAST(nl AS BIGINT) AS left_rows, CAST(n - nl AS BIGINT) AS right_rows "
        "FROM gains ORDER BY gain DESC LIMIT 1",
        f"{_DESIGN}, t AS MATERIALIZED (SELECT * FROM xy WHERE {_TRAIN}), tot AS (SELECT avg(y) AS m, count(*) AS n FROM t), "
        f"long AS (SELECT name, v, y FROM ({long}) l UNION ALL SELECT name, 1.0, y FROM x, unnest(e) u(z), names "
        f"WHERE z.i = names.i AND z.i < (SELECT o_num FROM dims) AND {_TRAIN}), "
        "stored AS (SELECT name, v, m - y AS g FROM long, tot WHERE v <> 0), "
        "vals AS (SELECT name, v, sum(g) AS g, count(*) AS k FROM stored GROUP BY ALL UNION ALL "
        "SELECT name, 0.0, -sum(g), any_value(n) - count(*) FROM stored, tot GROUP BY name), "
        "run AS (SELECT name, v, sum(g) OVER w AS gl, sum(k) OVER w AS nl FROM vals WINDOW w AS (PARTITION BY name ORDER BY v)), "
        "gains AS (SELECT name, v, gl, nl, n, gl * gl / (nl + 1) + gl * gl / (n - nl + 1) AS gain FROM run, tot "
        "WHERE nl >= 1 AND n - nl >= 1)")


@register("boosted_root", _root_sql())
def q_boosted_root(spark, d):
    """The first split of the first tree and its leaves, with bins as fine
    as the values."""
    from autoscope.operators.models import boosted_alt, feature_names
    train, _ = _train_test(spark, d)
    t = boosted_alt(max_depth=1, max_iter=1, max_bins=4096).fit(train).nodes(spark).collect()
    root, left, right = t[0], t[t[0]["left"]], t[t[0]["left"] + 1]
    return spark.createDataFrame([(feature_names(train)[root["feature"]], root["threshold"], root["gain"], left["value"], right["value"],
                                   left["n_rows"], right["n_rows"])],
                                 "feature string, threshold double, gain double, left_value double, right_value double, left_rows long, "
                                 "right_rows long").withColumns({c: sig(F.col(c), c) for c in ("threshold", "gain", "left_value", "right_value")})


@register("gbt_cv")
def q_gbt_cv(spark, d):
    """M9 + M6 + M7 + M8: 5-fold CV of boosted trees over depth {2, 10, 20}; one
    row a depth, and the test R^2 of the best depth fitted on the train part."""
    from autoscope.operators import boosting
    from autoscope.operators.models import gbt_setting
    train, test = _train_test(spark, d)
    depths = [2, 10, 20]
    mean, model = boosting.cross_validate(train, "fold", FOLDS, [gbt_setting(k) for k in depths])
    best = depths[mean.index(max(mean))]
    rows = spark.createDataFrame([("maxDepth", k, m, k == best) for k, m in zip(depths, mean)],
                                 "param string, value int, avg_metric double, best boolean")
    score = _scores(model, test).select(F.col("r2").alias("test_r2"))
    return rows.join(score, F.col("best"), "left")


@register("fm_scores")
def q_fm_scores(spark, d):
    """L5 + M11 + M6: scale, then 5-fold CV of FM over factorSize {2,4,8};
    the refit best model scored on test.  Every step of every fold and size is
    taken on sums from one pass."""
    from autoscope.operators import factorization
    from autoscope.operators import features as FE
    from autoscope.operators.models import fm
    train, test = _train_test(spark, d)
    scaler = FE.fit_scaler(train)
    prep = lambda df: scaler.transform(df).select("listing_key", F.col("scaledFeatures").alias("features"), "label", "fold")
    _, _, model = factorization.cross_validate(prep(train), "fold", fm(), [2, 4, 8])
    return _scores(model, prep(test))


@register("save_load_scores", with_listings(
    f"SELECT count(*) AS n_scored, count(*) AS n_equal FROM xy WHERE {_TEST}", _DESIGN))
def q_save_load_scores(spark, d):
    """A5 + A6: fit, save under a run-stamped path, load, re-score;
    one row: rows scored, rows whose prediction is unchanged."""
    from pyspark.ml.regression import LinearRegressionModel
    from autoscope.operators.models import ridge
    from autoscope.session import scratch_path
    from autoscope.sources.io import load_model, run_stamp, save_model
    train, test = _train_test(spark, d)
    model = ridge().fit(train)
    path = scratch_path(spark, f"models/ridge_{run_stamp()}")
    save_model(model, path)
    loaded = load_model(LinearRegressionModel, path)
    both = loaded.setPredictionCol("again").transform(model.transform(test))
    return both.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.col("prediction") == F.col("again")).alias("n_equal"))


# ---------------------------------------------------------------------------
# Map table (state polygons derived from the nation table)
# ---------------------------------------------------------------------------
def _parts(spark, d):
    from autoscope.operators import geo
    feats = geo.features_from_states(testdata.table(spark, d, "nation"), "n_nationkey", "n_name", "n_regionkey")
    return geo.drop_part(geo.explode_parts(feats))


_PARTS_SQL = ("SELECT feature_pos, state_id, part FROM (SELECT n_nationkey AS feature_pos, n_name AS state_id, "
              "unnest(range(CASE WHEN n_nationkey = 1 THEN 40 WHEN n_nationkey % 3 = 0 THEN 2 + n_nationkey % 4 "
              "ELSE 1 END)) AS part, n_regionkey FROM nation) g WHERE NOT (feature_pos = 1 AND part = 38)")


@register("polygon_parts", with_listings(
    "SELECT feature_pos, state_id, CAST(part AS INTEGER) AS part, 4 AS n_points, "
    "CAST(feature_pos * 100 + part AS DOUBLE) AS x0 FROM (" + _PARTS_SQL + ") p"))
def q_polygon_parts(spark, d):
    p = _parts(spark, d)
    return p.select("feature_pos", "state_id", "part", F.size(F.col("polygon")[0]).alias("n_points"),
                    F.col("polygon")[0][0][0].alias("x0"))


@register("geojson_parts", with_listings(
    "SELECT layout, CASE WHEN layout = 'collection' THEN feature_pos END AS feature_pos, state_id, "
    "CAST(part AS INTEGER) AS part, CAST(feature_pos * 100 + part AS DOUBLE) AS x0 "
    f"FROM ({_PARTS_SQL}) p, (VALUES ('collection'), ('lines')) v(layout)"))
def q_geojson_parts(spark, d):
    """A7 + O1 + O2: polygons written as GeoJSON and read back, as one
    collection and one feature per line; the outlier part is named by
    position in the first and by state in the second."""
    from autoscope.operators import geo
    from autoscope.sources.io import read_geojson
    nation = testdata.table(spark, d, "nation")
    shapes = geo.features_from_states(nation, "n_nationkey", "n_name", "n_regionkey")
    feature = F.concat(F.lit('{"type":"Feature","id":"'), F.col("state_id"), F.lit('","geometry":{"type":"'),
                       F.col("geom_type"), F.lit('","coordinates":'), F.col("coordinates"), F.lit("}}"))
    rows = shapes.select("feature_pos", feature.alias("f"))
    # a collection is one document by nature: the states' outlines
    listed = F.array_sort(F.collect_list(F.struct("feature_pos", "f")))
    document = rows.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['),
                                 F.array_join(F.transform(listed, lambda x: x.f), ","), F.lit("]}")).alias("value"))
    whole, lines = _scratch(spark, "collection"), _scratch(spark, "lines")
    document.write.text(whole)
    rows.select("f").write.text(lines)
    outlier = nation.filter(F.col("n_nationkey") == geo.OUTLIER_PART[0]).first()["n_name"]
    by_pos = geo.drop_part(geo.explode_parts(read_geojson(spark, whole)))
    by_state = geo.drop_part(geo.explode_parts(read_geojson(spark, lines, per_line=True)), state_id=outlier)
    both = by_pos.withColumn("layout", F.lit("collection")).unionByName(by_state.withColumn("layout", F.lit("lines")))
    return both.select("layout", "feature_pos", "state_id", "part", F.col("polygon")[0][0][0].alias("x0"))


_MAP_COLS = "p.state_id, feature_pos, CAST(part AS INTEGER) AS part"


def _map_sql(exclude: bool) -> str:
    where = (f"WHERE s.state_id <> (SELECT state_id FROM ({_STATE_STATS_SQL}) t ORDER BY mean_price DESC, state_id "
             "LIMIT 1)") if exclude else ""
    return with_listings(
        f"SELECT {_MAP_COLS}, round(s.mean_price + 1e-8, {R}) AS mean_price, "
        f"round(s.mean_mileage + 1e-8, {R}) AS mean_mileage, s.trans_count FROM ({_PARTS_SQL}) p "
        f"JOIN ({_STATE_STATS_SQL}) s ON p.state_id = s.state_id {where}")


def _map_query(exclude: bool) -> QueryFn:
    def fn(spark, d):
        from autoscope.operators import geo
        s = _state_stats(spark, d)
        excl = None
        if exclude:
            excl = stats.top_n(s, 1, [F.desc("mean_price"), "state_id"]).select("state_id").scalar()
        out = geo.map_table(_parts(spark, d).drop("polygon"), s)
        if excl is not None:
            out = out.filter(F.col("state_id") != excl)
        return out.select("state_id", "feature_pos", "part", rnd("mean_price"), rnd("mean_mileage"), "trans_count")
    return fn


register("map_table", _map_sql(False))(_map_query(False))
register("map_table_excluding_state", _map_sql(True))(_map_query(True))


# ---------------------------------------------------------------------------
# A1, A2, A4: CSV and Parquet round trips through the shared scratch folder
# ---------------------------------------------------------------------------
def _scratch(spark, name: str) -> str:
    import uuid
    from autoscope.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _through_csv(spark, d, write, read):
    """The raw listings written as CSV and read back, a part after the other: a
    part's CSV is removed when its rows are kept as Parquet."""
    from autoscope.session import remove, shuffles_removed
    from autoscope.sources.io import write_parts
    parts = testdata.raw_listing_parts(spark, d)

    def scanned(raw):
        path = _scratch(spark, "csv")
        with shuffles_removed(spark):
            write(raw, path)
        return path, read(path, raw.columns)

    if len(parts) == 1:
        return scanned(parts[0])[1]
    kept = _scratch(spark, "rows")

    def rows():
        for raw in parts:
            path, df = scanned(raw)
            yield df
            remove(spark, path)

    write_parts(rows(), kept)
    return spark.read.parquet(kept)


@register("csv_roundtrip", with_listings(
    "SELECT " + ", ".join(n for n, _ in testdata.RAW_LISTING_COLUMNS) + " FROM raw"))
def q_csv_roundtrip(spark, d):
    """A1 + A4: the raw listings (quotes, newlines in cells) written as
    quoted, compressed CSV and scanned back as all-string columns."""
    from autoscope.sources.io import NULL_MARKER, read_csv, write_csv
    return _through_csv(spark, d, lambda raw, path: write_csv(raw, path, compression="lz4"),
                        lambda path, names: read_csv(spark, path, columns=names, null_value=NULL_MARKER))


@register("csv_split_scan", with_listings(
    "SELECT " + ", ".join(n for n, _ in testdata.RAW_LISTING_COLUMNS) + " FROM raw"))
def q_csv_split_scan(spark, d):
    """A1: the raw listings written as quoted CSV, each file scanned by as many
    tasks as it has splits."""
    from autoscope.sources.csv_split import read_csv_split
    from autoscope.sources.io import NULL_MARKER, write_csv
    return _through_csv(spark, d, write_csv, lambda path, names: read_csv_split(spark, path, names, null_value=NULL_MARKER))


@register("parquet_roundtrip", with_listings("SELECT * FROM clean"))
def q_parquet_roundtrip(spark, d):
    """A2 + A4: cleaned listings written as Parquet and read back."""
    from autoscope.sources.io import read_parquet, write_parquet
    path = _scratch(spark, "parquet")
    write_parquet(L.cleaned_once(spark, d).drop("rowno"), path)
    return read_parquet(spark, path)


# ---------------------------------------------------------------------------
# B4, S1, N2, P1-P4
# ---------------------------------------------------------------------------
# Every column of the prepared listings, in their order, by kind.
SUMMARY_NUMBERS = [
    "engine_cylinders", "price", "mileage", "year", "horsepower", "engine_displacement", "city_fuel_economy",
    "highway_fuel_economy", "latitude", "longitude", "savings_amount", "seller_rating", "fuel_tank_volume",
    "back_legroom", "front_legroom", "height", "width", "length", "wheelbase", "maximum_seating", "power",
    "torque", "daysonmarket", "dealer_zip", "owner_count", "fleet", "frame_damaged", "franchise_dealer",
    "has_accidents", "isCab", "is_new", "salvage", "theft_title"]
SUMMARY_TEXTS = [
    "listing_key", "make_name", "model_name", "body_type", "engine_type", "listing_color", "exterior_color",
    "interior_color", "transmission_display", "transmission", "fuel_type", "wheel_system", "wheel_system_display",
    "trim_name", "major_options", "franchise_make", "sp_name", "city", "listed_date", "us_city", "state_id", "state_name"]


def _summary_sql() -> str:
    parts = []
    for c in SUMMARY_NUMBERS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS col_name, count({x}) AS count, round(avg({x}) + 1e-8, {R}) AS mean, "
            f"round(stddev_samp({x}) + 1e-8, {R}) AS stddev, min({x}) AS min, "
            f"round(quantile_cont({x}, 0.25) + 1e-8, {R}) AS p25, round(quantile_cont({x}, 0.5) + 1e-8, {R}) AS p50, "
            f"round(quantile_cont({x}, 0.75) + 1e-8, {R}) AS p75, max({x}) AS max, "
            "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM listings")
    for c in SUMMARY_TEXTS:
        x, no = f"CAST({c} AS VARCHAR)", "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}', count({x}), {', '.join([no] * 7)}, min({x}), max({x}) FROM listings")
    return with_listings(" UNION ALL ".join(parts))


@register("summary_stats", _summary_sql())
def q_summary_stats(spark, d):
    """Every column; numbers with count, mean, stddev, min, exact
    quartiles, max; texts and dates with count, min, max."""
    lst = L.listings(spark, d, *SUMMARY_NUMBERS, *SUMMARY_TEXTS)
    return profile.summary(lst, SUMMARY_NUMBERS, SUMMARY_TEXTS).select(
        "col_name", "count", rnd("mean"), rnd("stddev"), "min", rnd("p25"), rnd("p50"), rnd("p75"), "max",
        "min_text", "max_text")


@register("price_sorted", with_listings(
    "SELECT listing_key, make_name, model_name, price, state_id FROM listings "
    "ORDER BY price DESC NULLS LAST, listing_key, state_id NULLS FIRST LIMIT 20"))
def q_price_sorted(spark, d):
    """Listings by price, highest first (the first 20 rows a preview shows)."""
    cols = ["listing_key", "make_name", "model_name", "price", "state_id"]
    lst = L.listings(spark, d, *cols).select(*cols)
    return stats.top_n(lst, 20, [F.desc_nulls_last("price"), "listing_key", F.asc_nulls_first("state_id")])


@register("sample_predictions", _linear(
    f"SELECT listing_key, {sig_sql('p')} AS prediction, {sig_sql('y')} AS label FROM pred ORDER BY listing_key, p LIMIT 5", [0.1], _TRAIN,
    more=f", {linear_sql.predicted(_TEST)}"))
def q_sample_predictions(spark, d):
    """A few scored test rows (ordered, so the rows are defined)."""
    from autoscope.operators.evaluate import sample_predictions
    from autoscope.operators.models import ridge
    train, test = _train_test(spark, d)
    pred = sample_predictions(ridge().fit(train).transform(test), 5, ["listing_key", "prediction"])
    return pred.select("listing_key", sig(F.col("prediction"), "prediction"), sig(F.col("label"), "label"))


@register("pipeline_metrics")
def q_pipeline_metrics(spark, d):
    """The four jobs chained through Parquet in the shared folder
    (prepare, means, features, train with the boosted learner); the test
    metrics of the run."""
    from autoscope.plans import jobs
    from autoscope.session import shuffles_removed
    out = _scratch(spark, "jobs")
    p = jobs.prepare(spark, testdata.raw_listing_parts(spark, d), testdata.raw_cities(spark, d), out)
    with shuffles_removed(spark):
        m = jobs.means(spark, p.cleaned, out)
        xy = jobs.features(spark, p.sample, m, f"{out}/xy.parquet")
    return jobs.train(spark, xy, out).metrics


@register("city_state_join_dedupe", with_listings(
    "SELECT listing_key, city, us_city, s.state_id AS state_id, s.state_name AS state_name "
    "FROM clean LEFT JOIN (SELECT us_city, min(struct_pack(state_id := state_id, state_name := state_name)) AS s "
    "FROM cities GROUP BY us_city) c ON clean.city = c.us_city"))
def q_city_state_join_dedupe(spark, d):
    """E1 with ``dedupe=True`` (H3): one state per city, the smallest state_id."""
    out = enrich.attach_state(L.cleaned_once(spark, d), L.city_table(spark, d), dedupe=True)
    return out.select("listing_key", "city", "us_city", "state_id", "state_name")
