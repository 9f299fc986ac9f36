"""Factorization machines from moments (M11, M6, M7): one pass over the data.

A machine's prediction is linear in z = (1, x_i, x_i * x_j for i < j): its
coefficients there are the intercept, the weights and the products of the factors.
The squared error over all rows, and its gradient, thus follow from the sums of z z',
z * label and label^2.  The cells of z z' are products of at most four features, each
summed once, for every fold; "all but fold k" is a subtraction, and every machine of
every fold takes its full-batch steps on these sums, without another look at the rows.

The steps are those of Spark's learner (AdamW over all rows), from its own initial factors.
A task sends a row a cell that occurs; the cells grow with the fourth power of
the number of features, not with the rows.  Vectors of more than ``MAX_FEATURES``
features go to Spark's learner and its passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import FMRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.operators.boosting import _flat, entries
from autoscope.session import materialize

#: C(n + 4, 4) sums a fold: 4.6 million for 100 features
MAX_FEATURES = 100
#: products that a task holds at a time
CELLS = 1 << 19


def _tables(size: int) -> list[np.ndarray]:
    """Four tables over the places 0 .. size (0: the constant 1): places
    a <= b <= c <= d have the number t0[a] + t1[b] + t2[c] + t3[d]."""
    p = np.arange(size + 1, dtype=np.int64)
    return [p, p * (p + 1) // 2, p * (p + 1) * (p + 2) // 6, p * (p + 1) * (p + 2) * (p + 3) // 24]


def _count(size: int, degree: int) -> int:
    """How many products of ``degree`` places there are."""
    return int(_tables(size)[degree - 1][-1] + (_count(size, degree - 1) if degree > 1 else 1))


@lru_cache(maxsize=64)
def _places(k: int) -> tuple[np.ndarray, ...]:
    """For a row of ``k`` entries after the constant: its pairs of places, and
    its products of four as two pairs.  No feature occurs three times."""
    pairs = list(combinations_with_replacement(range(k + 1), 2))
    number = {p: i for i, p in enumerate(pairs)}
    fours = [(number[a, b], number[c, d]) for a, b, c, d in combinations_with_replacement(range(k + 1), 4)
             if not (b == c and b and b in (a, d))]
    return (*np.array(pairs).T, *np.array(fours).T)


def _add_rows(sums: np.ndarray, place: np.ndarray, value: np.ndarray, y: np.ndarray, tables: list[np.ndarray], with_label: int):
    """Add the products of rows of equally many entries (place 0 first)."""
    a, b, left, right = _places(place.shape[1] - 1)
    step = max(1, CELLS // len(left))
    for at in range(0, len(y), step):
        p, v = place[at:at + step], value[at:at + step]
        first, second = p[:, a], p[:, b]
        both = v[:, a] * v[:, b]
        low, high = tables[0][first] + tables[1][second], tables[2][first] + tables[3][second]
        np.add.at(sums, (low[:, left] + high[:, right]).ravel(), (both[:, left] * both[:, right]).ravel())
        np.add.at(sums, (low + with_label).ravel(), (both * y[at:at + step, None]).ravel())
    sums[-1] += y @ y


@dataclass
class Sums:
    """Sums over some rows: products of up to four features, of up to two with
    the label, and the label's square, in one array."""
    cells: np.ndarray
    size: int

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.cells - other.cells, self.size)

    @property
    def n(self) -> float:
        return self.cells[0]

    def system(self) -> System:
        a, b = _terms(self.size)
        t = _tables(self.size)
        g = np.empty((len(a), len(a)))
        for i in range(len(a)):
            mid, other = np.maximum(a[i], a), np.minimum(b[i], b)
            g[i] = self.cells[t[0][np.minimum(a[i], a)] + t[1][np.minimum(mid, other)] + t[2][np.maximum(mid, other)] + t[3][np.maximum(b[i], b)]]
        return System(g, self.cells[_count(self.size, 4) + t[0][a] + t[1][b]], self.n, self.cells[-1])


def _terms(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each term of z."""
    i, j = np.triu_indices(size, 1)
    return np.concatenate([np.zeros(size + 1, np.int64), i + 1]), np.concatenate([np.arange(size + 1), j + 1])


@dataclass
class System:
    """Sums of z z', of z * label, of rows and of the label's square."""
    products: np.ndarray
    with_label: np.ndarray
    n: float
    squares: float

    def r2(self, m: Machine) -> float:
        theta = m.terms()
        spread = self.squares - self.with_label[0] ** 2 / self.n if self.n else 0.0
        error = theta @ self.products @ theta - 2 * theta @ self.with_label + self.squares
        return float(1 - error / spread) if spread > 0 else float("nan")


@dataclass
class Machine:
    factors: np.ndarray
    weights: np.ndarray
    intercept: float

    def terms(self) -> np.ndarray:
        """The coefficients of z."""
        i, j = np.triu_indices(len(self.weights), 1)
        return np.concatenate([[self.intercept], self.weights, (self.factors @ self.factors.T)[i, j]])

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        factors, weights, intercept = self.factors, self.weights, self.intercept

        @F.arrow_udf("double")
        def predict(e: pa.Array) -> pa.Array:
            row, position, value = _flat(e)
            out = intercept + np.bincount(row, weights[position] * value, len(e))
            for v in factors.T:
                x = v[position] * value
                out += (np.bincount(row, x, len(e)) ** 2 - np.bincount(row, x * x, len(e))) / 2
            return pa.array(out)

        return df.withColumn(prediction, predict(entries(features)))


def sums(df: DataFrame, fold: str | None = None, features: str = "features", label: str = "label") -> dict[int, Sums]:
    """The sums of each fold (a column of whole numbers; without one, all rows
    are fold 0).  Rows without a label are left out."""
    rows = df.where(F.col(label).isNotNull())
    first = rows.select(features).first()
    if first is None:
        return {}
    size = first[0].size
    with_label = _count(size, 4)
    length = with_label + _count(size, 2) + 1

    def products(batches):
        tables, total = _tables(size), {}
        for batch in batches:
            folds, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            row, position, value = _flat(batch.column(2))
            stored = value != 0
            row, position, value = row[stored], position[stored], value[stored]
            n = np.bincount(row, minlength=batch.num_rows)
            for f, k in {*zip(folds.tolist(), n.tolist())}:
                own = (folds == f) & (n == k)
                of = own[row]
                m = int(own.sum())
                place, v = np.zeros((m, k + 1), np.int64), np.ones((m, k + 1))
                place[:, 1:], v[:, 1:] = position[of].reshape(m, k) + 1, value[of].reshape(m, k)
                _add_rows(total.setdefault(f, np.zeros(length)), place, v, y[own], tables, with_label)
        for f, s in total.items():
            there = np.flatnonzero(s)
            for at in range(0, len(there), CELLS):
                cell = there[at:at + CELLS]
                yield pa.record_batch([pa.array(np.full(len(cell), f, np.int64)), pa.array(cell), pa.array(s[cell])], names=["fold", "cell", "s"])

    # every task may send all cells: not more tasks than run at a time
    spread = df.sparkSession.sparkContext.defaultParallelism
    plain = rows.select((F.col(fold) if fold else F.lit(0)).cast("long").alias("fold"), F.col(label).cast("double").alias("y"),
                        entries(features).alias("e")).coalesce(spread)
    got = plain.mapInArrow(products, "fold long, cell long, s double").groupBy("fold", "cell").agg(F.sum("s").alias("s")).toArrow()
    folds, cell, s = (got.column(c).to_numpy() for c in ("fold", "cell", "s"))
    out = {}
    for f in np.unique(folds).tolist():
        own, cells = folds == f, np.zeros(length)
        cells[cell[own]] = s[own]
        out[f] = Sums(cells, size)
    return out


def fit(system: System, estimators: list[FMRegressor], starts: list[Machine]) -> list[Machine]:
    """Each estimator's machine: Spark's AdamW over all rows, step for step."""
    for e in estimators:
        if e.getRegParam() or e.getMiniBatchFraction() < 1 or e.getSolver() != "adamW" or not (e.getFitIntercept() and e.getFitLinear()):
            raise ValueError("moments serve the unpenalised full-batch adamW machine with intercept and weights")
    d = len(starts[0].weights)
    i, j = np.triu_indices(d, 1)
    x = [np.concatenate([m.factors.ravel(), m.weights, [m.intercept]]) for m in starts]
    mean, square = [np.zeros(len(v)) for v in x], [np.zeros(len(v)) for v in x]

    def machine(v):
        k = len(v) - d - 1
        return Machine(v[:k].reshape(d, -1), v[k:-1], float(v[-1]))

    going, step = set(range(len(x))), 0
    while going := {m for m in going if step < estimators[m].getMaxIter()}:
        step += 1
        order = sorted(going)
        theta = np.stack([machine(x[m]).terms() for m in order], axis=1)
        slope = 2 * (system.products @ theta - system.with_label[:, None]) / system.n
        for m, s in zip(order, slope.T):
            pairs = np.zeros((d, d))
            pairs[i, j] = s[d + 1:]
            g = np.concatenate([((pairs + pairs.T) @ machine(x[m]).factors).ravel(), s[1:d + 1], s[:1]])
            mean[m] = 0.9 * mean[m] + 0.1 * g
            square[m] = 0.999 * square[m] + 0.001 * g * g
            move = estimators[m].getStepSize() * (mean[m] / (1 - 0.9 ** step)) / (np.sqrt(square[m] / (1 - 0.999 ** step)) + 1e-8)
            x[m] = x[m] - move
            if np.linalg.norm(move) < estimators[m].getTol() * max(np.linalg.norm(x[m]), 1.0):
                going.discard(m)
    return [machine(v) for v in x]


def start(df: DataFrame, estimator: FMRegressor, size: int) -> Machine:
    """The machine before the first step, drawn by Spark's learner from the
    estimator's seed (a fit of no iterations)."""
    one = df.sparkSession.createDataFrame([(Vectors.dense([0.0] * size), 0.0)], ["x", "y"])
    m = estimator.copy().setFeaturesCol("x").setLabelCol("y").setMaxIter(0).fit(one)
    return Machine(m.factors.toArray(), m.linear.toArray(), float(m.intercept))


def cross_validate(df: DataFrame, fold: str, estimator: FMRegressor, factor_sizes: list[int], features: str = "features", label: str = "label"):
    """(mean R^2 over the folds for each factor size, best size, its machine
    fitted on all rows)."""
    first = df.where(F.col(label).isNotNull()).select(features).first()
    if first is None:
        raise ValueError("no rows with a label")
    size = first[0].size
    if size > MAX_FEATURES:
        return _by_passes(df, fold, estimator, factor_sizes, features, label)
    by_fold = sums(df, fold, features, label)
    total = Sums(sum(s.cells for s in by_fold.values()), size)
    settings = [estimator.copy().setFactorSize(k) for k in factor_sizes]
    starts = [start(df, e, size) for e in settings]
    scores = []
    for own in by_fold.values():
        machines, held = fit((total - own).system(), settings, starts), own.system()
        scores.append([held.r2(m) for m in machines])
    mean = np.mean(scores, axis=0)
    at = int(np.nanargmax(mean))
    return mean.tolist(), factor_sizes[at], fit(total.system(), [settings[at]], [starts[at]])[0]


def _by_passes(df, fold, estimator, factor_sizes, features, label):
    """``cross_validate`` by Spark's learner, a pass over the rows each step."""
    rows = materialize(df.where(F.col(label).isNotNull()).select(features, label, F.col(fold).cast("int").alias("fold")), "machines")
    folds = {r["fold"]: i for i, r in enumerate(rows.select("fold").distinct().collect())}
    numbered = rows.withColumn("fold", F.create_map(*[F.lit(x) for kv in folds.items() for x in kv])[F.col("fold")])
    est = estimator.copy().setFeaturesCol(features).setLabelCol(label)
    cv = CrossValidator(estimator=Pipeline(stages=[est]), estimatorParamMaps=ParamGridBuilder().addGrid(est.factorSize, factor_sizes).build(),
                        evaluator=RegressionEvaluator(metricName="r2", labelCol=label), numFolds=len(folds), foldCol="fold", parallelism=4)
    model = cv.fit(numbered)
    return model.avgMetrics, factor_sizes[int(np.nanargmax(model.avgMetrics))], model.bestModel
