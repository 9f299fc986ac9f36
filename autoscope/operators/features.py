"""Feature engineering (L1-L7) on ``pyspark.ml`` transformers.

Indexing and one-hot encoding fit one pass over the data (category counts
are a partial aggregate; only the label arrays -- one entry per distinct
category -- reach the driver).  Assembly and scaling are row-local.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoscope.operators.impute import CATEGORICAL_COLUMNS

# Numeric model inputs appended after the one-hot blocks.
NUMERIC_FEATURES = ["year", "mileage", "horsepower", "engine_cylinders", "fuel_tank_volume",
                    "back_legroom", "height", "width", "length"]


def index_cols(cols: list[str]) -> list[str]:
    return [c + "_numeric" for c in cols]


def onehot_cols(cols: list[str]) -> list[str]:
    return [c + "_onehot" for c in cols]


def encoding_pipeline(cols: list[str] = CATEGORICAL_COLUMNS, handle_invalid: str = "error") -> Pipeline:
    """L1 + L2 + L3: multi-column StringIndexer (frequency-descending,
    ties alphabetical) then sparse one-hot (last level dropped)."""
    indexer = StringIndexer(inputCols=cols, outputCols=index_cols(cols), handleInvalid=handle_invalid)
    encoder = OneHotEncoder(inputCols=index_cols(cols), outputCols=onehot_cols(cols))
    return Pipeline(stages=[indexer, encoder])


def fit_encoding(df: DataFrame, cols: list[str] = CATEGORICAL_COLUMNS,
                 fit_on: DataFrame | None = None, handle_invalid: str | None = None) -> PipelineModel:
    """Fit the encoding on ``fit_on`` (default: the whole table, as the
    original job does -- pass the training split to avoid test leakage).

    A level that the fit has not seen is an error when the table itself was
    fitted; with ``fit_on`` it gets the index after the last level and an
    all-zero one-hot vector, unless ``handle_invalid`` says otherwise."""
    how = handle_invalid or ("error" if fit_on is None else "keep")
    return encoding_pipeline(cols, how).fit(fit_on if fit_on is not None else df)


def index_table(spark: SparkSession, model: PipelineModel,
                cols: list[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """L1 inspection: ``(column_name, value, idx)`` from a fitted indexer.

    The label arrays already live on the driver inside the fitted model
    (one entry per distinct category); this renders them as a table.
    """
    indexer = model.stages[0]
    rows = [(c, v, i) for c, labels in zip(cols, indexer.labelsArray) for i, v in enumerate(labels)]
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("value", T.StringType()),
                           T.StructField("idx", T.LongType())])
    return spark.createDataFrame(rows, schema)


def hot_positions(df: DataFrame, cols: list[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Per one-hot column the position of its 1.0 (-1 for the dropped
    last level), alongside the raw value and index.  Read from the sparse
    vector's own positions; no array of all levels is built."""
    out = []
    for c in cols:
        v = F.unwrap_udt(F.col(c + "_onehot"))
        dense = F.array_position(v["values"], F.lit(1.0)) - 1
        out.append(F.when(v["type"] == 0, F.coalesce(F.get(v["indices"], F.lit(0)), F.lit(-1))).otherwise(dense).cast("long").alias(c + "_hot"))
    return df.select(*[F.col(c) for c in df.columns if c not in set(onehot_cols(cols))], *out)


def assemble(df: DataFrame, inputs: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """L4: concatenate vectors and numbers into one vector column.  A null
    input raises by default; ``handle_invalid='skip'`` drops such rows."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=handle_invalid).transform(df)


def model_inputs(cols: list[str] = CATEGORICAL_COLUMNS) -> list[str]:
    return onehot_cols(cols) + NUMERIC_FEATURES


def vector_totals(df: DataFrame, inp: str = "features") -> DataFrame:
    """L4 inspection: ``size``, ``nnz`` and ``vsum`` (sum of all entries) of
    the vector column in its place.  Read from the entries the vector holds,
    which are few if it is sparse; no array of its whole size is built."""
    v = df.withColumn(inp, F.unwrap_udt(F.col(inp)))
    held = F.col(inp)["values"]
    return v.select(*[F.col(c) for c in df.columns if c != inp],
                    F.when(F.col(inp)["type"] == 0, F.col(inp)["size"]).otherwise(F.size(held)).alias("size"),
                    F.size(F.filter(held, lambda x: x != 0)).alias("nnz"),
                    F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x).alias("vsum"))


def fit_scaler(df: DataFrame, inp: str = "features", out: str = "scaledFeatures"):
    """Unit-variance scaling, no centering (sample standard deviation)."""
    return StandardScaler(withStd=True, withMean=False, inputCol=inp, outputCol=out).fit(df)


def to_xy(df: DataFrame, features: str = "features", label: str = "price") -> DataFrame:
    """``(features, label)`` projection."""
    return df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"))
