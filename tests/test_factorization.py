"""Factorization machines from moments against Spark's learner."""
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from autoscope.operators import factorization as FM
from autoscope.operators import models


@pytest.fixture(scope="module")
def data(spark):
    rng, out = random.Random(5), []
    for i in range(300):
        a, b, c = rng.random() * 3, rng.choice([0.0, 1.0, -2.0]), rng.randint(0, 2)
        y = 4 * a + 3 * a * b - 2 * c + (5 * a if c == 1 else 0) + rng.random()
        x = [a, b, *[float(c == k) for k in range(3)]]
        out.append((i % 3, Vectors.dense(x) if i % 4 else Vectors.sparse(5, [(k, v) for k, v in enumerate(x) if v]), y))
    return spark.createDataFrame(out, ["fold", "features", "label"]).repartition(3)


def test_machine_equals_sparks_learner(spark, data):
    """Step for step: coefficients, convergence and predictions."""
    total = FM.sums(data)[0]
    for k, steps in ((2, 1), (3, 60)):
        est = models.fm(factor_size=k, maxIter=steps, stepSize=0.1)
        m = FM.fit(total.system(), [est], [FM.start(data, est, 5)])[0]
        twin = est.fit(data)
        assert np.allclose(m.factors, twin.factors.toArray(), rtol=1e-6, atol=1e-9)
        assert np.allclose([*m.weights, m.intercept], [*twin.linear.toArray(), twin.intercept], rtol=1e-6, atol=1e-9)
        both = m.transform(twin.transform(data), prediction="p").collect()
        assert np.allclose([r.p for r in both], [r.prediction for r in both], rtol=1e-6)


def test_cross_validation_equals_sparks(spark, data, monkeypatch):
    est = models.fm(maxIter=8, stepSize=0.1)
    mean, best, m = FM.cross_validate(data, "fold", est, [2, 4])
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("fm"))
    spark.sparkContext.setJobGroup("fm", "fm")
    FM.cross_validate(data, "fold", est, [2, 4])
    assert jobs() < 20  # not a pass a step
    monkeypatch.setattr(FM, "MAX_FEATURES", 4)
    twin_mean, twin_best, twin = FM.cross_validate(data, "fold", est, [2, 4])
    assert np.allclose(mean, twin_mean, rtol=1e-6) and best == twin_best
    both = m.transform(twin.transform(data), prediction="p").collect()
    assert np.allclose([r.p for r in both], [r.prediction for r in both], rtol=1e-6)


def test_rows_without_label_or_entries(spark):
    v = [(0, Vectors.sparse(2, []), 1.0), (0, Vectors.dense([1.0, 2.0]), None), (0, Vectors.dense([1.0, 3.0]), 4.0)]
    s = FM.sums(spark.createDataFrame(v, ["fold", "features", "label"]))[0].system()
    z = np.array([[1, 0, 0, 0], [1, 1, 3, 3.0]])
    assert s.n == 2 and np.allclose(s.products, z.T @ z) and np.allclose(s.with_label, z.T @ [1, 4]) and s.squares == 17
