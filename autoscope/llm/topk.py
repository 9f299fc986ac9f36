"""Exact inner-product search: a ball tree per shard, branch and bound.

Vectors are cut into shards of bounded size, each with its own ball tree.
Queries travel in blocks.  A first round searches one shard per block and
gives every query a floor, its k-th best score there; the second round takes
each block to every shard, visits tree nodes by the upper bound
``q . centre + |q| * radius`` on their scores, and leaves out what cannot
beat the floor or the k-th score found since.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autoscope.session import materialize

SCALE = 1024
TOP = 10
QUERY_EVERY = 100
SHARD_ROWS = 8192
LEAF_ROWS = 128
BLOCK_QUERIES = 256
#: query blocks that meet a shard in one task
BLOCKS_AT_ONCE = 64
_EXACT = float(1 << 53)
_LIMITS = (-(1 << 63), (1 << 63) - 1)
#: stands for a row without an id, after all others in a tie
NO_ID = (1 << 63) - 1


class BallTree:
    """Rows reordered so that every node is a slice; centres and radii."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS,
                 keys: np.ndarray | None = None, copies: np.ndarray | None = None):
        order = np.arange(len(rows))
        self.centre, self.radius, self.span, self.children = [], [], [], []
        self._split(rows, order, 0, len(rows), leaf)
        self.ids, self.rows = ids[order], rows[order]
        #: who a row is (its id, unless given), and how often it occurs
        self.keys = self.ids if keys is None else keys[order]
        self.copies = np.ones(len(rows), np.int64) if copies is None else copies[order]
        self.largest = float(np.sqrt((rows.astype(float) ** 2).sum(axis=1)).max()) if len(rows) else 0.0

    def _split(self, rows, order, lo, hi, leaf) -> int:
        at, own = len(self.span), rows[order[lo:hi]]
        centre = own.mean(axis=0)
        gap = np.sqrt(((own - centre) ** 2).sum(axis=1))
        self.centre.append(centre)
        self.radius.append(float(gap.max()))
        self.span.append((lo, hi))
        self.children.append(None)
        if hi - lo > leaf and gap.max() > 0:
            one = own[gap.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = np.argsort(own @ (other - one), kind="stable")
            order[lo:hi] = order[lo:hi][along]
            mid = (lo + hi) // 2
            self.children[at] = (self._split(rows, order, lo, mid, leaf), self._split(rows, order, mid, hi, leaf))
        return at

    def bounds(self, node: int, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bounds on the scores in a node, a little above rounding."""
        c = q @ self.centre[node]
        reach = norm * self.radius[node]
        return c + reach + 1e-9 * (np.abs(c) + reach + norm * self.largest) + 1e-6


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.astype(float)
        self.score = [np.zeros(0)] * len(floor)
        self.id = [np.zeros(0, np.int64)] * len(floor)

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        s, d = np.concatenate([self.score[i], score]), np.concatenate([self.id[i], ids])
        order = np.lexsort((d, -s))[:self.k]
        self.score[i], self.id[i] = s[order], d[order]
        if len(order) == self.k:
            last = self.score[i][-1]
            near = float(last)
            # not above the score itself, where floats are coarser than longs
            self.floor[i] = max(self.floor[i], near if near <= last else np.nextafter(near, -np.inf))


def products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: as floats where those are exact, else as
    whole numbers, held within the range of a long."""
    if not len(q) or not len(rows) or np.abs(q).max() * np.abs(rows).max() * q.shape[1] < _EXACT:
        return q @ rows.T
    lo, hi = _LIMITS
    return np.array([[min(max(sum(int(a) * int(b) for a, b in zip(x, y)), lo), hi) for y in rows] for x in q], object)


def search(tree: BallTree, ids: np.ndarray, q: np.ndarray, best: Best) -> None:
    """``best`` with the tree's rows; ``ids`` are the queries' keys, of whose
    rows one copy is left out."""
    norm = np.sqrt((q ** 2).sum(axis=1))

    def visit(node: int, live: np.ndarray, bound: np.ndarray) -> None:
        live = live[bound >= best.floor[live]]
        if not len(live):
            return
        pair = tree.children[node]
        if pair is None:
            lo, hi = tree.span[node]
            own = tree.ids[lo:hi]
            score = products(q[live], tree.rows[lo:hi])
            for n, i in enumerate(live.tolist()):
                keep = (score[n] >= best.floor[i]).astype(bool)
                times = np.minimum(np.where(keep, tree.copies[lo:hi] - (tree.keys[lo:hi] == ids[i]), 0), best.k)
                if times.any():
                    best.add(i, np.repeat(score[n], times), np.repeat(own, times))
            return
        near, far = pair
        a, b = tree.bounds(near, q[live], norm[live]), tree.bounds(far, q[live], norm[live])
        if a.sum() < b.sum():
            near, far, a, b = far, near, b, a
        visit(near, live, a)
        visit(far, live, b)

    everything = np.arange(len(q))
    visit(0, everything, tree.bounds(0, q, norm))


def usable(vectors: DataFrame, every_row: bool = False) -> DataFrame:
    """(vec_id, v, key, copies): distinct rows with only finite components.
    Those without an id are left out, a row's key is its id and it counts once;
    with ``every_row`` they stay, each distinct row has a key of its own and
    counts as often as it occurs."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    whole = rows.where(F.col("v").isNotNull() & ~bad).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    if every_row:  # written, for the key is that of a row's place
        return materialize(whole.withColumn("key", F.monotonically_increasing_id()), "vectors")
    return whole.where(F.col("vec_id").isNotNull()).withColumns({"copies": F.lit(1).cast("long"), "key": F.col("vec_id")})


def scaled(lists) -> np.ndarray:
    return np.floor(SCALE * np.array(lists, float).reshape(len(lists), -1))


def shards(rows: DataFrame) -> DataFrame:
    """(dim, part, seq, tree): trees of at most ``SHARD_ROWS`` rows each."""

    def run(batches):
        part, held, seq = TaskContext.get().partitionId(), {}, 0

        def close(dim):
            nonlocal seq
            ids, vecs, keys, copies = held.pop(dim)
            tree = pickle.dumps(BallTree(np.array(ids, np.int64), scaled(vecs), keys=np.array(keys, np.int64),
                                         copies=np.array(copies, np.int64)), 5)
            seq += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([tree], pa.binary())],
                ["dim", "part", "seq", "tree"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("vec_id", "v", "key", "copies"))):
                ids, vecs, keys, copies = held.setdefault(len(row[1]), ([], [], [], []))
                ids.append(NO_ID if row[0] is None else row[0])
                vecs.append(row[1])
                keys.append(row[2])
                copies.append(row[3])
                if len(ids) == SHARD_ROWS:
                    yield close(len(row[1]))
        for dim in list(held):
            yield close(dim)

    return rows.mapInArrow(run, "dim int, part int, seq int, tree binary")


def blocks(queries: DataFrame, count: int) -> DataFrame:
    """(dim, block, ids, vectors): queries in blocks of about BLOCK_QUERIES."""
    n = max(1, -(-count // BLOCK_QUERIES))
    return queries.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")}).groupBy(
        "dim", "block").agg(F.collect_list(F.struct("key", "v")).alias("q"))


def _search_blocks(trees: pd.DataFrame, asked: pd.DataFrame, k: int):
    """Best of each query of each block over the given trees."""
    loaded = [pickle.loads(t) for t in trees["tree"]]
    for row in asked.itertuples():
        ids = np.array([x["key"] for x in row.q], np.int64)
        q = scaled([x["v"] for x in row.q])
        floor = np.array(row.floor, float) if getattr(row, "floor", None) is not None else np.full(len(ids), -np.inf)
        best = Best(floor, k)
        for tree in loaded:
            search(tree, ids, q, best)
        yield row, ids, best


def top_k(vectors: DataFrame, is_query, k: int = TOP, every_row: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: for each usable row that ``is_query``
    selects, its k best scores among the other rows of its length.

    Ties go to the smaller vec_id.  Repeated rows count once; rows with the
    query's own id are no candidates.  With ``every_row`` each row counts for
    itself: a query's candidates are all rows but the one row it is, with
    repeated rows, rows of the same id and rows without an id (null, after all
    ids in a tie), and a repeated query is answered as often.  Fewer candidates
    give fewer rows.  Scores beyond the range of a long count as its end.
    """
    rows = usable(vectors, every_row)
    trees = materialize(shards(rows), "trees")
    listed = trees.select("dim", "part", "seq").withColumn(
        "shard", F.row_number().over(Window.partitionBy("dim").orderBy("part", "seq")) - 1)
    places = materialize(listed, "places")
    queries = rows.where(is_query(F.col("vec_id")))
    count = queries.count()
    asked = materialize(blocks(queries, count), "blocks")
    query_type = "array<struct<key:bigint,v:array<double>>>"
    per_dim = places.groupBy("dim").agg(F.count("*").alias("shards"))

    # round one: one shard per block, in turn
    seeds = asked.join(per_dim, "dim").withColumn("shard", F.pmod(F.col("block"), F.col("shards"))).drop("shards")
    located = trees.join(places, ["dim", "part", "seq"]).select("dim", "shard", "tree")

    def seed(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [(row.dim, row.block, row.q, best.floor.tolist()) for row, _, best in _search_blocks(left, right, k)] if len(left) else []
        return pd.DataFrame(out, columns=["dim", "block", "q", "floor"])

    floors = materialize(located.groupBy("dim", "shard").cogroup(seeds.groupBy("dim", "shard")).applyInPandas(
        seed, f"dim int, block int, q {query_type}, floor array<double>"), "floors")

    # round two: every block at every shard of its length, a bounded number of blocks at a time
    groups = -(-max(1, -(-count // BLOCK_QUERIES)) // BLOCKS_AT_ONCE)
    here = located.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    there = floors.join(per_dim, "dim").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int")))).withColumn("grp", F.floor(F.col("block") / BLOCKS_AT_ONCE).cast("int")).drop("shards")

    def scan(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, ids, best in _search_blocks(left, right, k) if len(left) and len(right) else []:
            for i in range(len(ids)):
                parts += [(int(ids[i]), int(d), int(s)) for d, s in zip(best.id[i].tolist(), best.score[i].tolist())]
        return pd.DataFrame(parts, columns=["key", "vec_id", "score"])

    found = here.groupBy("dim", "shard", "grp").cogroup(there.groupBy("dim", "shard", "grp")).applyInPandas(
        scan, "key long, vec_id long, score long")
    if not every_row:
        return _ranked(found.withColumnRenamed("key", "query_id"), "query_id", k).select("query_id", "rank", "vec_id", "score")
    times = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    asking = queries.select("key", F.col("vec_id").alias("query_id"), times.alias("time"))
    return _ranked(found, "key", k).join(asking, "key").select(
        "query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


def _ranked(found: DataFrame, query: str, k: int) -> DataFrame:
    order = Window.partitionBy(query).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def op10(vectors: DataFrame, every_row: bool = False) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 100."""
    return top_k(vectors, lambda i: i % QUERY_EVERY == 0, every_row=every_row)


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
