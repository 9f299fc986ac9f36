"""Models and evaluation (M1-M11, N1): closed form and invariants."""
import math
import random

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel

from autoscope.operators import evaluate, features as FE, models


def data(spark, n=400):
    random.seed(3)
    rows = [(float(x), 3.0 * x + 10 + random.gauss(0, 5)) for x in range(n)]
    df = spark.createDataFrame(rows, "x double, label double")
    return FE.assemble(df, ["x"])


def test_ridge_one_feature_closed_form(spark):
    df = data(spark)
    m = models.ridge(reg_param=0.1).fit(df)
    xs, ys = zip(*[(r.x, r.label) for r in df.collect()])
    n = len(xs)
    mx, my = sum(xs) / n, sum(ys) / n
    sx = math.sqrt(sum((v - mx) ** 2 for v in xs) / n)
    sy = math.sqrt(sum((v - my) ** 2 for v in ys) / n)
    r = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / n / sx / sy
    slope = r / (1 + 0.1 / sy) * sy / sx
    assert math.isclose(m.coefficients[0], slope, rel_tol=1e-9)
    assert math.isclose(m.intercept, my - slope * mx, rel_tol=1e-9)


def test_one_pass_metrics_equal_evaluator(spark):
    df = data(spark)
    pred = models.ridge().fit(df).transform(df)
    mine = evaluate.regression_metrics(pred).first()
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in [("r2", "r2"), ("rmse", "rmse"), ("mae", "mae")]:
        assert math.isclose(getattr(mine, name), ev.evaluate(pred, {ev.metricName: metric}), rel_tol=1e-9)
    assert math.isclose(mine.explained_variance, ev.evaluate(pred, {ev.metricName: "var"}), rel_tol=1e-7)


def test_cv_reports_one_metric_per_setting(spark):
    df = models.cut_lineage(data(spark, 200))
    est = models.glr()
    cvm = models.cross_validate(est, models.grid(est.regParam, [0.0, 0.4]), df, folds=3)
    rep = models.cv_report(spark, cvm, "regParam").collect()
    assert [r.value for r in rep] == [0.0, 0.4] and all(r.avg_metric > 0.9 for r in rep)


def test_save_load_same_predictions(spark, tmp_path):
    df = data(spark, 100)
    m = models.ridge().fit(df)
    path = str(tmp_path / "m")
    from autoscope.sources.io import load_model, save_model
    save_model(m, path)
    m2 = load_model(LinearRegressionModel, path)
    a = [r.prediction for r in m.transform(df).collect()]
    b = [r.prediction for r in m2.transform(df).collect()]
    assert a == b


def test_boosted_and_fm_fit(spark):
    df = data(spark, 200)
    gbt = models.gbt(max_depth=3, maxIter=5).fit(df)
    assert evaluate.regression_metrics(gbt.transform(df)).first().r2 > 0.9
    scaled = FE.fit_scaler(df).transform(df).selectExpr("scaledFeatures as features", "label")
    fm = models.fm(factor_size=2, maxIter=50, stepSize=0.1).fit(scaled)
    assert fm.transform(scaled).count() == 200


def test_vector_totals_read_the_held_entries(spark):
    """A sparse vector is never spread out to its whole size."""
    rows = [(1, Vectors.sparse(2_000_000_000, [3, 7, 9], [2.0, 0.0, 1.5])), (2, Vectors.dense([0.0, 4.0, -1.0])),
            (3, Vectors.sparse(5, [], []))]
    got = FE.vector_totals(spark.createDataFrame(rows, ["key", "features"])).orderBy("key").collect()
    assert [tuple(r) for r in got] == [(1, 2_000_000_000, 2, 3.5), (2, 3, 2, 3.0), (3, 5, 0, 0.0)]
