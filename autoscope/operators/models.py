"""Regression models, grid search and model reports.

Thin ``pyspark.ml`` wrappers: the learners are distributed already (each
iteration is a pass of per-partition gradient / histogram sums combined by
``treeAggregate``).  What we add: lineage cut before iterative fits (every
CV fold would otherwise replay the whole preparation), and tabular reports
instead of prints.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (FMRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from autoscope.operators.boosting import BoostedTreesRegressor, Setting
from autoscope.session import materialize

# The seed of the seeded learners.
SEED = 651


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor
    loss, unlike a cache or a local checkpoint) and return the re-read."""
    return materialize(df, "train")


def ridge(max_iter: int = 50, reg_param: float = 0.1, elastic_net: float = 0.0,
          solver: str = "auto", features: str = "features", label: str = "label") -> LinearRegression:
    """M1: linear regression with an L2 penalty."""
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, solver=solver)


def glr(reg_param: float = 0.0, family: str = "gaussian", link: str = "identity") -> GeneralizedLinearRegression:
    """M5: generalized linear regression (gaussian family, identity link)."""
    return GeneralizedLinearRegression(family=family, link=link, regParam=reg_param)


def gbt(max_depth: int = 5, seed: int | None = SEED, **kw) -> GBTRegressor:
    """M9: gradient-boosted trees."""
    est = GBTRegressor(maxDepth=max_depth, **kw)
    if seed is not None:
        est = est.setSeed(seed)
    return est


def boosted_alt(max_depth: int = 6, step_size: float = 0.3, max_iter: int = 100, l2: float = 1.0,
                max_bins: int = 256) -> BoostedTreesRegressor:
    """The second boosted-tree learner: second-order gains on
    quantile-binned features, with the other learner's defaults (depth 6, learning
    rate 0.3, 100 rounds, L2 penalty 1, 256 bins)."""
    return BoostedTreesRegressor(Setting(depth=max_depth, rate=step_size, rounds=max_iter, l2=l2), max_bins)


def gbt_setting(max_depth: int = 5, step_size: float = 0.1, max_iter: int = 20) -> Setting:
    """M9 as a setting of ``boosting.cross_validate``: as ``GBTRegressor``, the
    first tree fits the labels with weight 1 and each later one twice the
    residuals with weight ``step_size``."""
    return Setting(depth=max_depth, rounds=max_iter, rate=2 * step_size, first_rate=1.0, l2=0.0, base=0.0)


def boosted_gbt(max_depth: int = 5, step_size: float = 0.1, max_iter: int = 20, max_bins: int = 32) -> BoostedTreesRegressor:
    """M9 by the boosted learner, with ``GBTRegressor``'s defaults: 20 trees,
    weight 0.1, 32 bins a feature."""
    return BoostedTreesRegressor(gbt_setting(max_depth, step_size, max_iter), max_bins)


def fm(factor_size: int = 8, seed: int = SEED, **kw) -> FMRegressor:
    """Factorization-machine regression (use scaled inputs)."""
    return FMRegressor(factorSize=factor_size, seed=seed, **kw)


def r2_evaluator(metric: str = "r2") -> RegressionEvaluator:
    return RegressionEvaluator(metricName=metric, predictionCol="prediction", labelCol="label")


def grid(param, values) -> list:
    """M7: one-parameter grid."""
    return ParamGridBuilder().addGrid(param, values).build()


def cross_validate(estimator, param_maps: list, train: DataFrame, folds: int = 5,
                   metric: str = "r2", parallelism: int = 4, seed: int = SEED):
    """M6: k-fold grid search; the best setting is refit on all of ``train``.

    ``train`` should be lineage-cut (``cut_lineage``) first: the folds are
    re-read ``2 * folds`` times.  ``parallelism`` grid points are fitted
    concurrently: each fit is a series of small distributed jobs, so
    overlapping them keeps executors busy.
    """
    cv = CrossValidator(estimator=Pipeline(stages=[estimator]), estimatorParamMaps=param_maps,
                        evaluator=r2_evaluator(metric), numFolds=folds, parallelism=parallelism,
                        seed=seed)
    return cv.fit(train)


def cv_report(spark: SparkSession, cv_model, param_name: str) -> DataFrame:
    """M8: mean CV metric per parameter setting as rows."""
    rows = []
    for pm, metric in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        value = [v for p, v in pm.items() if p.name == param_name][0]
        rows.append((param_name, float(value), float(metric)))
    schema = T.StructType([T.StructField("param", T.StringType()),
                           T.StructField("value", T.DoubleType()),
                           T.StructField("avg_metric", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def coefficients(spark: SparkSession, model, feature_names: list[str]) -> DataFrame:
    """M3: ``(term, value)`` rows: one per feature plus the intercept."""
    rows = [(n, float(w)) for n, w in zip(feature_names, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names of an assembled vector from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def training_summary(spark: SparkSession, model) -> DataFrame:
    """M2: iterations, R^2, RMSE, MAE, explained variance as one row."""
    s = model.summary
    row = (int(s.totalIterations), float(s.r2), float(s.rootMeanSquaredError),
           float(s.meanAbsoluteError), float(s.explainedVariance))
    schema = T.StructType([T.StructField("iterations", T.LongType()),
                           T.StructField("r2", T.DoubleType()),
                           T.StructField("rmse", T.DoubleType()),
                           T.StructField("mae", T.DoubleType()),
                           T.StructField("explained_variance", T.DoubleType())])
    return spark.createDataFrame([row], schema)
