"""Ridge and gaussian GLR from moments (M1, M5-M8): one pass over the data.

The pass sums, for every fold, the products of all pairs of (1, features,
label): a Gram matrix a fold.  Moments add and subtract, so "all but fold k" is
the total less fold k, and every penalty of every fold is solved from them on
the driver, without another look at the rows.  The error of a fold is a
quadratic form of its own Gram matrix.

What a task sends is one row a cell that occurs; the matrices have the square of
the number of features as cells, whatever the number of rows.

The solution is that of Spark's normal-equation solver: features and label are
standardised (population deviations), the penalty acts on standardised weights
and is divided by the label's deviation; features without variance get 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.operators.boosting import _flat, entries

#: as Spark's normal-equation solver
MAX_FEATURES = 4096
#: cells of a dense block of rows
CELLS = 1 << 20


@dataclass
class Moments:
    """Sums of products of z = (1, features - shift, label - shift)."""
    products: np.ndarray
    shift: np.ndarray

    @property
    def n(self) -> float:
        return self.products[0, 0]

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.products - other.products, self.shift)

    def solve(self, penalty: float) -> Linear:
        """The weights of penalty ``penalty`` (L2)."""
        if not self.n:
            return Linear(np.zeros(len(self.shift) - 1), float("nan"))
        mean = self.products[0, 1:] / self.n
        cov = self.products[1:, 1:] / self.n - np.outer(mean, mean)
        var = np.diag(cov).copy()
        var[var <= 1e-12 * np.maximum(1.0, np.diag(self.products)[1:] / self.n)] = 0.0
        sd = np.sqrt(var)
        use = np.flatnonzero(sd[:-1] > 0)
        weights = np.zeros(len(sd) - 1)
        if len(use) and sd[-1] > 0:
            r = cov[np.ix_(use, use)] / np.outer(sd[use], sd[use]) + np.eye(len(use)) * (penalty / sd[-1])
            weights[use] = np.linalg.lstsq(r, cov[use, -1] / (sd[use] * sd[-1]), rcond=None)[0] * sd[-1] / sd[use]
        center = self.shift + mean
        return Linear(weights, float(center[-1] - weights @ center[:-1]))

    def squared_error(self, fit: Linear) -> float:
        """Sum of squared residuals of ``fit`` over the rows of these moments."""
        v = np.concatenate([[self.shift[-1] - fit.intercept - fit.weights @ self.shift[:-1]], -fit.weights, [1.0]])
        return float(v @ self.products @ v)

    def r2(self, fit: Linear) -> float:
        spread = self.products[-1, -1] - self.products[0, -1] ** 2 / self.n if self.n else 0.0
        return 1 - self.squared_error(fit) / spread if spread > 0 else float("nan")


@dataclass
class Linear:
    weights: np.ndarray
    intercept: float

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        weights, intercept = self.weights, self.intercept

        @F.arrow_udf("double")
        def predict(e: pa.Array) -> pa.Array:
            row, position, value = _flat(e)
            return pa.array(intercept + np.bincount(row, weights[position] * value, len(e)))

        return df.withColumn(prediction, predict(entries(features)))


def moments(df: DataFrame, fold: str | None = None, features: str = "features", label: str = "label") -> dict[int, Moments]:
    """The moments of each fold (a column of whole numbers; without one, all
    rows are fold 0).  Rows without a label are left out."""
    rows = df.where(F.col(label).isNotNull())
    first = rows.select(features, F.col(label).cast("double").alias("y")).first()
    if first is None:
        return {}
    # any shift is exact; that of a row keeps large means from cancelling
    shift = np.append(first[0].toArray(), first["y"])
    size = len(shift) + 1
    if size > MAX_FEATURES + 2:
        raise ValueError(f"{size - 2} features: a Gram matrix is meant for at most {MAX_FEATURES}")

    def products(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            step = max(1, CELLS // size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                z = np.zeros((part.num_rows, size))
                row, position, value = _flat(part.column(2))
                z[row, position + 1] = value
                z[:, -1] = part.column(1).to_numpy(zero_copy_only=False)
                z[:, 1:] -= shift
                z[:, 0] = 1.0
                folds = part.column(0).to_numpy(zero_copy_only=False)
                for k in np.unique(folds).tolist():
                    own = z[folds == k]
                    total[k] = total.get(k, 0.0) + own.T @ own
        for k, m in total.items():
            i, j = np.nonzero(np.triu(m))
            yield pa.record_batch([pa.array(np.full(len(i), k, np.int64)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(m[i, j])],
                                  names=["fold", "i", "j", "s"])

    cells = rows.select((F.col(fold) if fold else F.lit(0)).cast("long").alias("fold"), F.col(label).cast("double").alias("y"),
                        entries(features).alias("e")).mapInArrow(products, "fold long, i int, j int, s double")
    out: dict[int, Moments] = {}
    got = cells.groupBy("fold", "i", "j").agg(F.sum("s").alias("s")).toArrow()
    k, i, j, s = (got.column(c).to_numpy() for c in ("fold", "i", "j", "s"))
    for f in np.unique(k).tolist():
        m, own = np.zeros((size, size)), k == f
        m[i[own], j[own]] = s[own]
        m[j[own], i[own]] = s[own]
        out[f] = Moments(m, shift)
    return out


def cross_validate(df: DataFrame, fold: str, penalties: list[float], features: str = "features", label: str = "label"):
    """(mean R^2 over the folds for each penalty, best penalty, its fit on all
    rows): the grid search of M6-M8 in one pass over ``df``."""
    by_fold = moments(df, fold, features, label)
    if not by_fold:
        raise ValueError("no rows with a label")
    total = Moments(sum(m.products for m in by_fold.values()), next(iter(by_fold.values())).shift)
    mean = [float(np.mean([m.r2((total - m).solve(p)) for m in by_fold.values()])) for p in penalties]
    best = penalties[int(np.nanargmax(mean))]
    return mean, best, total.solve(best)
