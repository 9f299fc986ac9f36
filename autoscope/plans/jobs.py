"""Whole jobs (P1-P4): prepare -> means -> features -> train.

Each job is a function over paths.  Between jobs the data is Parquet in a
shared location, and inside a job every table that is consumed twice is
written once and re-read (a lineage cut that survives executor loss):
the split runs on a stable input, and nothing is recomputed per action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoscope.operators import evaluate, features as FE, impute, models, profile, split
from autoscope.operators.enrich import attach_state
from autoscope.plans import listings as L
from autoscope.sources import io

# The complete-case filter of the features job (nine columns,
# two of them -- the fuel economies -- are not model inputs).
COMPLETE_CASE_COLUMNS = ["horsepower", "engine_cylinders", "fuel_tank_volume", "back_legroom", "height",
                         "width", "length", "city_fuel_economy", "highway_fuel_economy"]
# Down-sample (keep the 10% part) and train/test weights.
SAMPLE_WEIGHTS = [0.9, 0.1]
TRAIN_WEIGHTS = [0.7, 0.3]


@dataclass
class PreparePaths:
    cleaned: str
    sample: str


def prepare(spark: SparkSession, listings_csv: str | DataFrame | list[DataFrame], cities_csv: str | DataFrame,
            out_dir: str, sample_weights: list[float] = SAMPLE_WEIGHTS, seed: int = split.SEED,
            dedupe_cities: bool = False, csv_partitions: int | None = None) -> PreparePaths:
    """Raw CSV -> key, drop, clean -> city/state join -> Parquet, then a
    seeded down-sample of that Parquet (A1 C1 C2 C13 I1 E1 A4 J1 A4).  Raw
    listings in several parts are prepared one part after the other."""
    raw = (io.read_csv(spark, listings_csv, partitions=csv_partitions)
           if isinstance(listings_csv, str) else listings_csv)
    cities_raw = io.read_csv(spark, cities_csv) if isinstance(cities_csv, str) else cities_csv
    cities = L.cities(spark, cities_raw)
    enriched = [attach_state(L.clean_listings(part, i), cities, dedupe=dedupe_cities)
                for i, part in enumerate([raw] if isinstance(raw, DataFrame) else raw)]
    paths = PreparePaths(cleaned=f"{out_dir}/listings_clean.parquet", sample=f"{out_dir}/sample.parquet")
    io.write_parts(enriched, paths.cleaned)
    # split the written table, not the plan: a re-evaluated plan could
    # place rows in other partitions and change which rows are sampled
    stable = io.read_parquet(spark, paths.cleaned)
    io.write_parquet(split.random_split(stable, sample_weights, seed)[-1], paths.sample)
    return paths


@dataclass
class MeansPaths:
    by_state: str
    by_model: str
    by_body: str


def means(spark: SparkSession, cleaned_path: str, out_dir: str) -> MeansPaths:
    """Group-mean lookup tables from the full cleaned table."""
    df = io.read_parquet(spark, cleaned_path)
    paths = MeansPaths(f"{out_dir}/mean_mileage_by_state.parquet", f"{out_dir}/mean_by_model.parquet",
                       f"{out_dir}/mean_by_body.parquet")
    io.write_parquet(impute.mileage_by_state(df), paths.by_state)
    io.write_parquet(impute.means_by_model(df), paths.by_model)
    io.write_parquet(impute.means_by_body(df), paths.by_body)
    return paths


def impute_and_encode(df: DataFrame, state_means: DataFrame, model_means: DataFrame,
                      keep_observed_mileage: bool = False, filter_before_encoding: bool = False):
    """K1 -> K2 -> K3/K4 -> L3 (fit on the whole table) -> D2 -> L4.

    ``filter_before_encoding=True`` applies the complete-case filter (D2)
    before fitting the encoders, so category indices are ranked on the rows
    the model sees (the filter tests post-join columns, so it cannot be
    pushed below the joins either way).
    """
    filled = impute.fill_sentinel(df)
    filled = impute.impute_mileage(filled, state_means, keep_observed=keep_observed_mileage)
    filled = impute.impute_group_means(filled, ["make_name", "model_name"], impute.MODEL_MEASURES,
                                       means=model_means)
    if filter_before_encoding:
        filled = profile.complete_cases(filled, COMPLETE_CASE_COLUMNS)
    enc_model = FE.fit_encoding(filled)
    encoded = enc_model.transform(filled)
    complete = profile.complete_cases(encoded, COMPLETE_CASE_COLUMNS)
    return enc_model, FE.assemble(complete, FE.model_inputs())


def features(spark: SparkSession, sample_path: str, means_paths: MeansPaths, out_path: str,
             keep_observed_mileage: bool = False, filter_before_encoding: bool = False) -> str:
    """Sample -> imputed -> encoded -> ``(features, label)`` Parquet."""
    df = io.read_parquet(spark, sample_path)
    _, assembled = impute_and_encode(df, io.read_parquet(spark, means_paths.by_state),
                                     io.read_parquet(spark, means_paths.by_model), keep_observed_mileage,
                                     filter_before_encoding)
    io.write_parquet(FE.to_xy(assembled), out_path)
    return out_path


@dataclass
class TrainResult:
    model_path: str
    predictions_path: str
    metrics: DataFrame


def train(spark: SparkSession, xy_path: str, out_dir: str, estimator=None, run_id: str | None = None,
          weights: list[float] = TRAIN_WEIGHTS, seed: int = split.SEED) -> TrainResult:
    """``(features, label)`` -> split -> fit -> save model -> score ->
    save predictions -> R^2 / RMSE / MAE in one pass (J2 M10 A5 A6 M4 N3 N1).

    Rows without a label are dropped before the split.  Model and
    predictions go under a run-stamped location.
    """
    run_id = run_id or io.run_stamp()
    est = estimator if estimator is not None else models.boosted_alt()
    xy = io.read_parquet(spark, xy_path).filter(F.col("label").isNotNull())
    train_df, test_df = split.random_split(xy, weights, seed)
    model = est.fit(train_df)
    name = type(model).__name__.replace("Model", "").lower()
    model_path = f"{out_dir}/models/{name}_{run_id}"
    io.save_model(model, model_path)
    pred_path = f"{out_dir}/predictions/{run_id}.parquet"
    io.write_parquet(model.transform(test_df), pred_path)
    # score the written predictions: one pass, no re-scoring of the test set
    metrics = evaluate.regression_metrics(io.read_parquet(spark, pred_path))
    return TrainResult(model_path, pred_path, metrics)
