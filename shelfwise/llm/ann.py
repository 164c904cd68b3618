"""Approximate nearest neighbours by cosine: stable projections, kd-trees and a chi-square stop.

Unit vectors are projected to a few dimensions by a Gaussian matrix.  For
vectors at distance r the squared projected distance over r squared is
chi-square with as many degrees of freedom, so once projected neighbours are
farther than the k-th verified distance times the root of a chi-square
quantile, a better one is left out with at most the quantile's complement of
probability, and the search stops.

The projected space is cut into cells by the top of a kd-tree fitted on a
bounded sample; crowded cells are salted into shards.  Every shard holds its
own kd-tree.  A query first searches a shard of its own cell, which gives a
bound, and then the shards whose cells the bound and the test do not rule
out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep
from shelfwise.llm.words import mix

#: Projected dimensions (even), probability of the chi-square test, seed of the projection.
DIMENSIONS, CONFIDENCE, SEED = 8, 0.99, 20240501
#: Rows sampled to fit the cells; rows of a kd-tree leaf.
SAMPLE, LEAF = 20_000, 32


def chi_square(p: float, m: int) -> float:
    """Quantile of the chi-square distribution with an even number m of degrees of freedom."""
    low, high = 0.0, 100.0 + 10 * m
    for _ in range(100):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


def projection(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, DIMENSIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class KdTree:
    """Axis-parallel cuts at medians, kept as arrays; leaves have bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.axis, self.value, self.child, bounds = [], [], [], []
        self.leaves = []
        stack = [(0, len(points), -1, 0)]
        while stack:
            low, high, parent, side = stack.pop()
            own = self.order[low:high]
            node = len(self.axis)
            if parent >= 0:
                self.child[parent][side] = node
            x = points[own]
            spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(points.shape[1])
            axis = int(spread.argmax())
            if len(own) <= leaf or spread[axis] == 0:
                self.axis.append(-1)
                self.value.append(0.0)
                self.child.append([len(self.leaves), 0])
                self.leaves.append((low, high))
                bounds.append((x.min(axis=0), x.max(axis=0)) if len(x) else (np.full(points.shape[1], np.inf), np.full(points.shape[1], -np.inf)))
                continue
            half = len(own) // 2
            part = np.argpartition(x[:, axis], half)
            value = x[part[half], axis]
            left = x[:, axis] < value
            if not left.any():  # the median is the least value: ties go left
                left = x[:, axis] <= value
            self.order[low:high] = np.concatenate([own[left], own[~left]])
            cut = low + int(left.sum())
            self.axis.append(axis)
            # what is below goes left; after a cut at ties, the value next above divides
            self.value.append(float(x[~left, axis].min()))
            self.child.append([0, 0])
            stack += [(low, cut, node, 0), (cut, high, node, 1)]
        self.low, self.high = (np.array(b) for b in zip(*bounds, strict=True))

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        axis, value, child = np.array(self.axis), np.array(self.value), np.array(self.child)
        node = np.zeros(len(points), np.int64)
        while True:
            go = np.flatnonzero(axis[node] >= 0)
            if not len(go):
                return child[node, 0]
            at = node[go]
            node[go] = child[at, (points[go, axis[at]] >= value[at]).astype(int)]

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corners of the whole-space cells of the leaves."""
        d = self.low.shape[1]
        low, high = np.full((len(self.leaves), d), -np.inf), np.full((len(self.leaves), d), np.inf)
        stack = [(0, np.full(d, -np.inf), np.full(d, np.inf))]
        while stack:
            node, lo, hi = stack.pop()
            if self.axis[node] < 0:
                low[self.child[node][0]], high[self.child[node][0]] = lo, hi
                continue
            left, right = hi.copy(), lo.copy()
            left[self.axis[node]] = right[self.axis[node]] = self.value[node]
            stack += [(self.child[node][0], lo, left), (self.child[node][1], right, hi)]
        return low, high


def gaps(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances from a point to boxes."""
    d = np.maximum(np.maximum(low - point, point - high), 0)
    return (d * d).sum(axis=-1)


def search(tree: KdTree, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, low_query: np.ndarray, own: int, k: int, bound: float, stop: float):
    """Up to k nearest of one shard, in falling score: positions and scores; none can be beyond distance ``bound``."""
    order, best, at = gaps(tree.low, tree.high, low_query), np.zeros(0), np.zeros(0, np.int64)
    for leaf in np.argsort(order, kind="stable"):
        if order[leaf] > stop * bound:
            break
        a, b = tree.leaves[leaf]
        rows = tree.order[a:b]
        rows = rows[ids[rows] != own]
        scores = vectors[rows] @ query
        best, at = np.concatenate([best, scores]), np.concatenate([at, rows])
        if len(best) > k:
            top = np.lexsort((ids[at], -best))[:k]
            best, at = best[top], at[top]
        if len(best) == k:
            bound = min(bound, max(2 - 2 * best.min(), 0.0) + 1e-12)
    return at, best


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id vector``: vectors of finite doubles that are not null, empty or zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))


def neighbours(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, confidence: float = CONFIDENCE
) -> DataFrame:
    """``query_id rank vec_id score``: the ``k`` nearest found of each row whose id is divisible by ``every``.

    Score is the cosine in double precision on the original vectors; ties go
    to the smaller id.  Every row but the query's own id is a candidate; with
    fewer than k candidates all are returned.

    Null, empty or zero vectors, and those that hold a null or a value that
    is not finite, take no part, nor do null ids; vectors are compared with
    those of their own length.  Rows that repeat an id are each a
    candidate, and one of them (by its components) asks.  Empty tables give
    an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = keep(valid(vectors, id_col, vector_col).withColumn("size", F.size("vector")), "vectors")
    sizes = [r["size"] for r in rows.select("size").distinct().collect()]
    out = None
    for size in sorted(sizes):
        own = _neighbours(rows.where(F.col("size") == size), size, k, every, chi_square(confidence, DIMENSIONS))
        out = own if out is None else out.union(own)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def _neighbours(rows: DataFrame, size: int, k: int, every: int, stop: float) -> DataFrame:
    spark = rows.sparkSession
    n = rows.count()
    # shards grow with the root of the table, so that queries times shards stays in hand
    per_shard = int(min(max(8 * math.isqrt(n), 512), 32_768))
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(min(n, SAMPLE)).select("vector").collect()
    project = projection(size)
    points = unit(np.array([r.vector for r in sample], float)) @ project
    cells = KdTree(points, max(1, math.ceil(len(points) * per_shard / n)))
    corners = cells.cells()
    cells.order = None
    sent = spark.sparkContext.broadcast((cells, corners, project))

    def placed(batches):
        for batch in batches:
            if batch.num_rows:
                cell = sent.value[0].leaf_of(unit(_matrix(batch.column("vector"))) @ sent.value[2])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cell.astype(np.int32))], names=["vec_id", "vector", "cell"])

    rows = keep(rows.select("vec_id", "vector").mapInArrow(placed, "vec_id long, vector array<double>, cell int"), "placed")
    # cells are few (rows over rows of a shard); a crowded one has several shards
    shards = np.ones(len(cells.leaves), np.int64)
    for r in rows.groupBy("cell").count().toLocalIterator():
        shards[r.cell] = -(-r["count"] // per_shard)
    counts = spark.sparkContext.broadcast(shards)

    def salted(batches):
        for batch in batches:
            of = counts.value[batch.column("cell").to_numpy()].astype(np.uint64)
            salt = mix(batch.column("vec_id").to_numpy().view(np.uint64)) % of
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(salt.astype(np.int32))], names=[*batch.schema.names, "salt"])

    index = rows.mapInArrow(salted, "vec_id long, vector array<double>, cell int, salt int")

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("vector", "cell")).alias("r")).select("vec_id", "r.*")

    def searched(table_q, table_x):
        """Queries against one shard's kd-tree."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not table_q.num_rows or not table_x.num_rows:
            return schema.empty_table()
        raw_x, ids = _matrix(table_x.column("vector")), table_x.column("vec_id").to_numpy()
        x, raw_q = unit(raw_x), _matrix(table_q.column("vector"))
        q = unit(raw_q)
        low_q = q @ sent.value[2]
        tree = KdTree(x @ sent.value[2], LEAF)
        out = []
        bounds = table_q.column("bound").to_numpy(zero_copy_only=False)
        for i, own in enumerate(table_q.column("vec_id").to_numpy()):
            bound = 4.0 if np.isnan(bounds[i]) else bounds[i]
            at, _ = search(tree, ids, x, q[i], low_q[i], own, k, bound, stop)
            # the exact measure, on the original vectors
            score = (raw_x[at] * raw_q[i]).sum(axis=1) / (np.sqrt((raw_x[at] * raw_x[at]).sum(axis=1)) * np.sqrt((raw_q[i] * raw_q[i]).sum()))
            out.append((np.full(len(at), own), ids[at], score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)

    def ask(queries: DataFrame) -> DataFrame:
        return queries.groupBy("cell", "salt").cogroup(index.groupBy("cell", "salt")).applyInArrow(searched, "query_id long, vec_id long, score double")

    # first a shard of the query's own cell: its k-th distance bounds the rest
    home = asked.mapInArrow(salted, "vec_id long, vector array<double>, cell int, salt int").withColumn("bound", F.lit(None).cast("double"))
    found = keep(ask(home), "home")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.greatest(2 - 2 * F.col("score"), F.lit(0.0)).alias("bound"))

    def reaching(batches):
        """Each query with every shard that its bound does not rule out."""
        tree, (low, high), matrix = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = unit(_matrix(batch.column("vector"))) @ matrix
            bounds = np.nan_to_num(batch.column("bound").to_numpy(zero_copy_only=False), nan=4.0)
            homes = list(zip(batch.column("cell").to_numpy(), batch.column("salt").to_numpy(), strict=True))
            to, cell, salt = [], [], []
            for i in range(len(near)):
                for c in np.flatnonzero(gaps(low, high, near[i]) <= stop * bounds[i]).tolist():
                    for s in range(counts.value[c]):
                        if (c, s) != homes[i]:
                            to.append(i)
                            cell.append(c)
                            salt.append(s)
            to = pa.array(to, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(to), batch.column("vector").take(to), pa.array(cell, pa.int32()), pa.array(salt, pa.int32()), pa.array(bounds).take(to)],
                names=["vec_id", "vector", "cell", "salt", "bound"],
            )

    rest = home.drop("bound").join(kth, "vec_id", "left").mapInArrow(reaching, "vec_id long, vector array<double>, cell int, salt int, bound double")
    found = found.union(ask(rest))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


by_value(__name__)
