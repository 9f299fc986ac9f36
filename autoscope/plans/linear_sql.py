"""DuckDB twins of the linear models: Gram matrices, their solution by
Gauss-Jordan elimination, and predictions, on the full feature vector.

Position 0 of the matrices is the constant, 1 .. d the features in vector
order, d + 1 the label; numbers are shifted by their means.
"""

from __future__ import annotations

from autoscope.operators.features import NUMERIC_FEATURES
from autoscope.operators.impute import CATEGORICAL_COLUMNS

FOLDS = 5


def design(enc_ctes: str, enc_join: str, complete: str, split: str, fold: str) -> str:
    """CTEs up to ``x`` (y, split, fold, e: the row's (i, v)) and ``names`` (i, name)."""
    off = ["1"]
    for c in CATEGORICAL_COLUMNS:
        off.append(f"{off[-1]} + (SELECT max(nlev) - 1 FROM r_{c})")
    dims = ", ".join(f"{o} AS o_{c}" for o, c in zip(off, [*CATEGORICAL_COLUMNS, "num"])) + f", {off[-1]} + {len(NUMERIC_FEATURES)} AS o_y"
    num = ", ".join(f"CAST(imp.{c} AS DOUBLE) AS n_{c}" for c in NUMERIC_FEATURES)
    hot = ", ".join(f"CASE WHEN r_{c}.idx < r_{c}.nlev - 1 THEN o_{c} + r_{c}.idx END AS h_{c}" for c in CATEGORICAL_COLUMNS)
    mean = ", ".join(f"avg(n_{c}) AS m_{c}" for c in NUMERIC_FEATURES)
    entries = ", ".join(["struct_pack(i := 0::BIGINT, v := 1::DOUBLE)", "struct_pack(i := o_y::BIGINT, v := y - m_y)",
                         *(f"struct_pack(i := (o_num + {k})::BIGINT, v := n_{c} - m_{c})" for k, c in enumerate(NUMERIC_FEATURES)),
                         *(f"struct_pack(i := h_{c}::BIGINT, v := 1::DOUBLE)" for c in CATEGORICAL_COLUMNS)])
    names = " UNION ALL ".join([*(f"SELECT o_{c} + idx AS i, '{c}_onehot_' || value AS name FROM r_{c}, dims WHERE idx < nlev - 1" for c in CATEGORICAL_COLUMNS),
                                *(f"SELECT o_num + {k}, '{c}' FROM dims" for k, c in enumerate(NUMERIC_FEATURES))])
    shifts = " UNION ALL ".join(f"SELECT o_num + {k} AS i, m_{c} AS m FROM dims, mu" for k, c in enumerate(NUMERIC_FEATURES))
    return (f"{enc_ctes}, dims AS MATERIALIZED (SELECT {dims}), "
            f"xy AS MATERIALIZED (SELECT listing_key, CAST(price AS DOUBLE) AS y, {split} AS split, {fold} AS fold, {num}, {hot} "
            f"FROM {enc_join}, dims WHERE {complete} AND imp.price IS NOT NULL), "
            f"mu AS MATERIALIZED (SELECT {mean}, avg(y) AS m_y FROM xy), "
            f"x AS MATERIALIZED (SELECT listing_key, y, split, fold, list_filter([{entries}], lambda z: z.i IS NOT NULL) AS e FROM xy, mu, dims), "
            f"names AS MATERIALIZED ({names}), shifts AS ({shifts})")


def solve(penalties: list[float], rows: str = "true", folds: bool = False) -> str:
    """CTEs up to ``fit`` (id, lam, n, w: weights, b0: intercept in shifted numbers)
    over the rows that ``rows`` selects; id -1 is all of them, with ``folds``
    id k all but fold k.  ``gram`` (fold, m) holds each fold's own products."""
    ids = f"(SELECT unnest(range(-1, {FOLDS if folds else 0})) AS id)"
    lam = ", ".join(f"({p}::DOUBLE)" for p in penalties)
    return f"""
cells AS MATERIALIZED (SELECT fold, a.z.i AS i, b.z.i AS j, sum(a.z.v * b.z.v) AS s
  FROM (SELECT * FROM x WHERE {rows}) t, unnest(t.e) AS a(z), unnest(t.e) AS b(z) GROUP BY ALL),
pos AS (SELECT unnest(range(o_y + 1)) AS i FROM dims),
sums AS (SELECT id, i, j, sum(s) AS s FROM {ids} k, cells WHERE k.id <> cells.fold GROUP BY ALL),
grams AS MATERIALIZED (SELECT id, list(r ORDER BY i) AS m FROM (SELECT k.id, p.i, list(coalesce(s, 0) ORDER BY q.i) AS r
  FROM {ids} k CROSS JOIN pos p CROSS JOIN pos q LEFT JOIN sums c ON c.id = k.id AND c.i = p.i AND c.j = q.i GROUP BY ALL) g GROUP BY id),
scale AS (SELECT id, m, m[1][1] AS n, len(m) AS e, list_transform(m[1], lambda v: v / m[1][1]) AS mean,
  list_transform(range(1, len(m) + 1), lambda k: sqrt(greatest(m[k][k] / m[1][1] - (m[1][k] / m[1][1]) ** 2, 0))) AS sd FROM grams),
ready AS (SELECT id, lam, n, mean, e, list_transform(sd, lambda v: CASE WHEN v > 1e-6 THEN v END) AS sd, m FROM scale, (VALUES {lam}) l(lam)),
start AS (SELECT id, lam, n, mean, sd, e, list_transform(range(2, e), lambda k: list_transform(range(2, e + 1), lambda l:
    CASE WHEN k = l AND sd[k] IS NULL THEN 1 ELSE coalesce((m[k][l] / n - mean[k] * mean[l]) / (sd[k] * sd[l]), 0)
      + CASE WHEN k = l THEN lam / sd[e] ELSE 0 END END)) AS a FROM ready),
jordan(id, lam, k, a) AS (SELECT id, lam, 1, a FROM start UNION ALL
  SELECT id, lam, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / a[k][k])
    ELSE list_transform(r, lambda v, j: v - r[k] * a[k][j] / a[k][k]) END) FROM jordan WHERE k <= len(a)),
beta AS (SELECT id, lam, list_transform(a, lambda r: r[-1]) AS beta FROM jordan WHERE k = len(a) + 1),
weights AS (SELECT id, lam, n, mean, e, list_transform(beta, lambda b, k: coalesce(b * sd[e] / sd[k + 1], 0)) AS w FROM beta JOIN start USING (id, lam)),
fit AS MATERIALIZED (SELECT id, lam, n, w, mean[e] - list_sum(list_transform(w, lambda v, k: v * mean[k + 1])) AS b0 FROM weights)"""


#: weight of every term and the intercept: (id, lam, term, value)
TERMS = """
terms AS (SELECT id, lam, name AS term, w[i] AS value FROM fit, names
  UNION ALL SELECT id, lam, 'intercept', b0 + m_y - (SELECT sum(w[i] * m) FROM shifts) FROM fit, mu)"""


def predicted(rows: str) -> str:
    """CTE ``pred`` (listing_key, id, lam, fold, y, p) of the rows that ``rows`` selects."""
    return f"""
pred AS MATERIALIZED (SELECT listing_key, id, lam, fold, y, b0 + m_y + list_sum(list_transform(
    list_filter(e, lambda z: z.i BETWEEN 1 AND len(w)), lambda z: z.v * w[z.i])) AS p FROM x, fit, mu WHERE {rows})"""
