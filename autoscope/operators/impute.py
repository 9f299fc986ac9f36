"""Imputation (K1-K5): sentinel fill, mileage rule, group-mean fill.

Group means are an aggregate (one partial row per task, so skew-proof)
joined back on the group keys.  The means table has one row per group and is
written before the join, so the planner knows its size: a small one is
broadcast without shuffling the listings, a large one is sort-merge joined
(with skew splitting on the big side).  No window over a group:
a group holding a third of all rows would land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.operators.stats import means_by
from autoscope.session import materialize

# Sentinel and the categorical columns filled before encoding.
SENTINEL = "N/A"
CATEGORICAL_COLUMNS = ["body_type", "make_name", "transmission_display", "listing_color", "state_id"]
# The columns the means job fills before grouping (model_name
# is filled here, make_name is not -- the consumer does the opposite).
MEANS_FILL_COLUMNS = ["body_type", "model_name", "transmission_display", "listing_color", "state_id"]
# The nine measures filled from make+model means.
MODEL_MEASURES = ["horsepower", "engine_cylinders", "fuel_tank_volume", "back_legroom",
                  "height", "width", "length", "city_fuel_economy", "highway_fuel_economy"]
# The three measures averaged per make + body type.
BODY_MEASURES = ["horsepower", "engine_cylinders", "fuel_tank_volume"]
NEW_CAR_MILEAGE = 5


def fill_sentinel(df: DataFrame, cols: list[str] = CATEGORICAL_COLUMNS,
                  value: str = SENTINEL) -> DataFrame:
    """Fill nulls of text columns (non-string columns are skipped)."""
    return df.fillna(value, subset=cols)


def mileage_by_state(df: DataFrame) -> DataFrame:
    """mean mileage per state, sentinel state kept as a group."""
    return (fill_sentinel(df, ["state_id"])
            .groupBy("state_id").agg(F.avg("mileage").alias("mean_mileage")))


def means_by_model(df: DataFrame) -> DataFrame:
    """nine means per (model_name, make_name) after the means-job fill."""
    return means_by(fill_sentinel(df, MEANS_FILL_COLUMNS), ["model_name", "make_name"], MODEL_MEASURES)


def means_by_body(df: DataFrame) -> DataFrame:
    """three means per (make_name, body_type) after the means-job fill."""
    return means_by(fill_sentinel(df, MEANS_FILL_COLUMNS), ["make_name", "body_type"], BODY_MEASURES)


def impute_mileage(df: DataFrame, state_means: DataFrame, keep_observed: bool = False) -> DataFrame:
    """K2: new listings get mileage 5; the others get their state's mean.

    As originally written the rule has no ``otherwise``, so observed mileage
    of used listings is replaced by the state mean too, and ``old_mileage``
    holds the already-replaced value.  ``keep_observed=True`` applies the
    stated intent: only missing mileage is filled.
    """
    new_rule = F.when(F.col("is_new") == 1, F.lit(NEW_CAR_MILEAGE))
    means = state_means.select(F.col("state_id").alias("_sid"), "mean_mileage")
    joined = df.join(means, df["state_id"] == means["_sid"], "left").drop("_sid")
    if keep_observed:
        filled = F.coalesce(new_rule, F.col("mileage"), F.col("mean_mileage"))
        old = F.col("mileage")
    else:
        filled = F.coalesce(new_rule, F.col("mean_mileage"))
        old = new_rule
    return (joined.withColumns({"old_mileage": old, "mileage": filled.cast("double")})
                  .drop("mean_mileage"))


def impute_group_means(df: DataFrame, keys: list[str], cols: list[str],
                       means: DataFrame | None = None, null_keys_match: bool = False,
                       keep_means: bool = True) -> DataFrame:
    """K3-K5: null -> mean of the same group, for each listed column.

    ``means`` may come from a saved table (as the original jobs do) or be
    computed here from ``df`` itself.  ``null_keys_match=True`` lets a null
    key match the null-key group (null-safe equality) -- the semantics of
    a window mean partitioned by the keys -- without putting a whole group
    into one task.  The filled columns replace the originals in place; the
    ``mean_*`` columns stay unless ``keep_means=False``.
    """
    if means is None:
        means = materialize(means_by(df, keys, cols), "means")
    renamed = means.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[F.col(f"mean_{c}") for c in cols])
    cond = None
    for k in keys:
        eq = (df[k].eqNullSafe(renamed[f"_k_{k}"]) if null_keys_match
              else df[k] == renamed[f"_k_{k}"])
        cond = eq if cond is None else cond & eq
    joined = df.join(renamed, cond, "left").drop(*[f"_k_{k}" for k in keys])
    out = joined.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"mean_{c}")) for c in cols})
    if not keep_means:
        out = out.drop(*[f"mean_{c}" for c in cols])
    return out
