"""User clustering and cold start.

A new user (no ratings yet) receives the recommendation list of a *donor*:
a user of the same k-means cluster who already has ALS recommendations.
Set-based throughout: clusters are assigned by ``KMeansModel.transform`` (or
by nearest-centre column expressions for given centres), donors are
``min(user_id)`` per cluster - at most k rows - and the copy is a join.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

USER = "user_id"
CLUSTER = "cluster"

# Most centre values (k x dim) sent to the tasks of an assignment; beyond this
# use a fitted KMeansModel and ``assign``.
MAX_CENTER_VALUES = 2_000_000
#: Bytes of one matrix of products, or of one batch of differences, inside a task.
CHUNK_BYTES = 16 * 1024 * 1024

# The scoring code travels by value: executors need numpy, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- M6 / K7 ----------------------------------------------------------------------


def fit_kmeans(features: DataFrame, k: int = 100, max_iter: int = 20, seed: int = 1,
               features_col: str = "features") -> KMeansModel:
    """k-means (k-means|| init).  Fewer distinct points than k gives fewer centres."""
    est = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col, predictionCol=CLUSTER)
    return est.fit(features)


# --- M7: assignment -----------------------------------------------------------------


def assign(model: KMeansModel, features: DataFrame) -> DataFrame:
    """Adds ``cluster`` (nearest centre of the fitted model)."""
    model = model.copy().setPredictionCol(CLUSTER)
    return model.transform(features)


def centers_frame(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """The model's centres as ``(center_id, features array<double>)`` (k rows)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "center_id int, features array<double>")


def distinct_centers(ids: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres in the order of their ids, of equal ones the first: no other is ever the nearest with the lowest id."""
    if not np.isfinite(c).all():
        return ids, c
    _, first = np.unique(c, axis=0, return_index=True)
    first = np.sort(first)
    return ids[first], c[first]


#: Centres of a leaf, and of how many centres in how few dimensions on leaves are looked at (they only steer cost).
LEAF_CENTERS, MANY_CENTERS, FEW_DIMENSIONS = 32, 256, 8
#: Points that are taken together where leaves are looked at.
POINTS = 1 << 16


def boxes(c: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(order, starts, low, high)``: rows of ``c`` dealt into leaves of at most ``rows`` by halving along the widest dimension, and their boxes."""
    order, starts, todo = np.arange(len(c)), [], [(0, len(c))]
    while todo:
        a, b = todo.pop()
        if b - a <= rows:
            starts.append(a)
            continue
        part, mid = c[order[a:b]], (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, np.ptp(part, axis=0).argmax()], mid)]
        todo += [(a, a + mid), (a + mid, b)]
    starts = np.sort(np.array(starts))
    return order, starts, np.minimum.reduceat(c[order], starts, axis=0), np.maximum.reduceat(c[order], starts, axis=0)


def _beyond(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points from boxes (0 inside), a little less where rounding could have made them too large."""
    out = np.zeros((len(p), len(low)))
    for j in range(p.shape[1]):
        x = p[:, j, None]
        gap = np.maximum(low[:, j] - x, x - high[:, j])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        out += gap
    out *= 1.0 - 1e-9
    return out


class Centers:
    """Centres in the order of their ids; where they are many in few dimensions, in leaves and groups of leaves with the boxes around them."""

    def __init__(self, c: np.ndarray):
        self.c, self.square, self.leaves = c, (c * c).sum(axis=1), None
        if len(c) > MANY_CENTERS and 0 < c.shape[1] <= FEW_DIMENSIONS and np.isfinite(self.square).all():
            order, starts, low, high = boxes(c, LEAF_CENTERS)
            # leaves follow each other as they were halved: neighbours make a group
            tops = np.arange(0, len(starts), max(1, int(np.sqrt(len(starts)))))
            self.leaves = (order, np.append(starts, len(c)), low, high)
            self.groups = (np.append(tops, len(starts)), np.minimum.reduceat(low, tops, axis=0), np.maximum.reduceat(high, tops, axis=0))

    def candidates(self, q: np.ndarray, made: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(point, centre) pairs that can be the nearest: of each point all centres whose distance rounding does not tell from the least.

        ``made`` counts the distances that leaves needed.
        """
        # what rounding can make of two sums of this size
        norms = (q * q).sum(axis=1)
        slack = 1e-13 * (self.c.shape[1] + 8) * (norms + self.square.max())
        if self.leaves is None:
            about = self.square - 2.0 * (q @ self.c.T)
            return np.nonzero(about <= (about.min(axis=1) + slack)[:, None])
        order, starts, low, high = self.leaves
        tops, top_low, top_high = self.groups
        c, square = self.c[order], self.square[order]
        least, found = np.full(len(q), np.inf), []

        def meet(rows, leaf):
            """Distances of some points from a leaf's centres; no point's least is above what it then is."""
            a, b = starts[leaf], starts[leaf + 1]
            about = square[a:b] - 2.0 * (q[rows] @ c[a:b].T) + norms[rows, None]
            least[rows] = np.minimum(least[rows], about.min(axis=1) + slack[rows])
            if made is not None:
                made.append(about.size)
            r, k = np.nonzero(about <= (least[rows] + slack[rows])[:, None])
            found.append((rows[r], a + k, about[r, k]))

        def by_part(parts):
            rows = np.argsort(parts, kind="stable")
            for some in np.split(rows, np.flatnonzero(np.diff(parts[rows])) + 1):
                yield parts[some[0]], some

        beyond = _beyond(q, top_low, top_high)
        tried = np.empty(len(q), np.int64)
        # the leaf that lies nearest gives every point a distance to begin with
        for top, rows in by_part(beyond.argmin(axis=1)):
            a, b = tops[top], tops[top + 1]
            tried[rows] = a + _beyond(q[rows], low[a:b], high[a:b]).argmin(axis=1)
        for leaf, rows in by_part(tried):
            meet(rows, leaf)
        for top in range(len(top_low)):
            rows = np.flatnonzero(beyond[:, top] <= least + slack)
            if not len(rows):
                continue
            a, b = tops[top], tops[top + 1]
            inner = _beyond(q[rows], low[a:b], high[a:b])
            for leaf in np.flatnonzero((inner <= (least + slack)[rows, None]).any(axis=0)):
                want = rows[(inner[:, leaf] <= (least + slack)[rows]) & (tried[rows] != a + leaf)]
                if len(want):
                    meet(want, a + leaf)
        rows, at, about = (np.concatenate(x) for x in zip(*found, strict=True))
        stay = about <= (least + slack)[rows]
        rows, cols = rows[stay], order[at[stay]]
        by = np.lexsort((cols, rows))
        return rows[by], cols[by]


def nearest(p: np.ndarray, c: np.ndarray | Centers) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest centre (of equal distances the first) and its squared distance, points taken in turns of CHUNK_BYTES.

    Matrix products only choose which centres can be the nearest; distances
    are summed element by element in order, as a sequential sum does.  Of
    many centres in few dimensions, a point meets those of the leaves whose
    boxes are not beyond the nearest centre found so far.
    """
    centers = c if isinstance(c, Centers) else Centers(c)
    c = centers.c
    best, dist = np.zeros(len(p), np.int64), np.zeros(len(p))
    finite = np.isfinite((p * p).sum()) and np.isfinite(centers.square).all()
    step = POINTS if finite and centers.leaves is not None else max(1, CHUNK_BYTES // (8 * len(c)))
    few = max(1, CHUNK_BYTES // (8 * max(1, c.shape[1])))
    for at in range(0, len(p), step):
        q = p[at : at + step]
        if np.isfinite(q).all() and np.isfinite(centers.square).all():
            rows, cols = centers.candidates(q)
        else:
            rows, cols = (x.ravel() for x in np.indices((len(q), len(c))))
        exact = np.zeros(len(rows))
        for a in range(0, len(rows), few):
            d = q[rows[a : a + few]] - c[cols[a : a + few]]
            for j in range(c.shape[1]):
                exact[a : a + few] += d[:, j] * d[:, j]
        starts = np.searchsorted(rows, np.arange(len(q)))
        least = np.minimum.reduceat(exact, starts)
        # a distance that is no number counts as the least, as in argmin
        hit = np.flatnonzero((exact == least[rows]) | np.isnan(exact))
        first = hit[np.searchsorted(rows[hit], np.arange(len(q)))]
        best[at : at + step], dist[at : at + step] = cols[first], exact[first]
    return best, dist


def _matrix(col: pa.Array) -> np.ndarray:
    """The rows' vectors, one a row of a matrix; all must be as long."""
    flat = col.flatten()
    if col.null_count or len(flat) % len(col) or (np.diff(col.offsets.to_numpy()) != len(flat) // len(col)).any():
        return np.stack(col.to_pandas().to_numpy()).astype(float)
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(col), -1)


def gathered(batches, rows: int):
    """Arrow batches put together until they hold ``rows`` or more; empty ones are left out."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def assign_to_centers(points: DataFrame, centers: DataFrame, id_col: str = "id",
                      features_col: str = "features") -> DataFrame:
    """Nearest given centre: ``(id, center_id, dist)``; ties to the lowest centre id.

    The centre table is bounded by k (checked before it is collected) and
    broadcast once, so each point is scored in place - no join, no shuffle.
    """
    stats = centers.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim")).first()
    n, dim = int(stats["n"]), int(stats["dim"] or 0)
    if n == 0:
        raise ValueError("no centres")
    if n * max(dim, 1) > MAX_CENTER_VALUES:
        raise ValueError(f"{n} centres x {dim} values exceed the bound; fit a KMeansModel")
    rows = sorted(centers.select("center_id", F.col("features").cast("array<double>").alias("f")).collect(), key=lambda r: r["center_id"])
    sent = points.sparkSession.sparkContext.broadcast((np.array([r["center_id"] for r in rows]), np.array([r["f"] for r in rows], float)))

    def score(batches):
        ids, c = distinct_centers(*sent.value)
        c = Centers(c)
        for batch in gathered(batches, 1 if c.leaves is None else POINTS):
            best, dist = nearest(_matrix(batch.column("f")), c)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids[best]).cast(number), pa.array(dist)], names=["id", "center_id", "dist"])

    kinds = {"id": points.schema[id_col].dataType.simpleString(), "center": centers.schema["center_id"].dataType.simpleString()}
    number = to_arrow_type(centers.schema["center_id"].dataType)
    rows = points.select(F.col(id_col).alias("id"), F.col(features_col).cast("array<double>").alias("f"))
    out = rows.mapInArrow(score, f"id {kinds['id']}, center_id {kinds['center']}, dist double")
    return out.withColumnRenamed("id", id_col)


# --- F2 / L2 / M8 / J3 / M9 -------------------------------------------------------


def same_cluster(assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows whose cluster is one of ``clusters`` (set form of the filter)."""
    # cluster ids are few by construction: AQE broadcasts the distinct ones by their measured size
    return assigned.join(clusters.select(CLUSTER).distinct(), CLUSTER, "left_semi")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(CLUSTER).agg(F.count(F.lit(1)).alias("n_members"))


def donors(assigned: DataFrame, eligible: DataFrame) -> DataFrame:
    """One donor per cluster: the smallest eligible user id (deterministic).

    ``eligible`` holds users that have ALS recommendations.  Clusters without
    an eligible member give no row.  Result has at most k rows.
    """
    return (
        assigned.join(eligible.select(USER), USER, "left_semi")
        .groupBy(CLUSTER)
        .agg(F.min(USER).alias("donor_id"))
    )


def rating_pool(centers: DataFrame, ratings: DataFrame) -> DataFrame:
    """``(user_id, cluster)`` of rating rows taken as points (user, product, rating): the original's own donor pool.

    It compared rating rows with centres that were fitted on (user, gender,
    age); the default pool are the users' features.  ``centers`` as for
    ``assign_to_centers``, in three dimensions.
    """
    point = F.array(*[F.col(c).cast("double") for c in (USER, "product_id", "rating")])
    points = ratings.select(F.col(USER).alias("id"), point.alias("features"))
    return assign_to_centers(points, centers).select(F.col("id").alias(USER), F.col("center_id").alias(CLUSTER))


def donor_lists(donor_table: DataFrame, recs: DataFrame, max_donors: int = 1_000_000) -> DataFrame:
    """``(cluster, donor_id, recs)``: each donor's list, book ids only.

    At most one row per cluster (checked against ``max_donors``), so the
    result is safe to broadcast.
    """
    n_donors = donor_table.count()
    if n_donors > max_donors:
        raise ValueError(f"{n_donors} donors exceed the broadcast bound {max_donors}")
    lists = recs.select(F.col(USER).alias("donor_id"), "recs").join(
        F.broadcast(donor_table.select("donor_id").distinct()), "donor_id", "left_semi"
    )
    ids_only = F.transform(
        F.col("recs"), lambda x: F.struct(x["product_id"].alias("product_id"),
                                          F.lit(None).cast("double").alias("score"))
    )
    return F.broadcast(donor_table).join(lists, "donor_id").select(CLUSTER, "donor_id", ids_only.alias("recs"))


def copy_from_donors(new_users: DataFrame, lists: DataFrame, served: DataFrame | None = None) -> DataFrame:
    """Give each user its cluster's donor list: ``(user_id, donor_id, recs)``.

    ``lists`` comes from ``donor_lists`` (one row per cluster) and is
    broadcast, so the user side is never shuffled however a cluster is
    skewed.  ``served`` users (with an ALS list) are skipped.
    """
    targets = new_users.select(USER, CLUSTER)
    if served is not None:
        targets = targets.join(served.select(USER), USER, "left_anti")
    return targets.join(F.broadcast(lists.select(CLUSTER, "donor_id", "recs")), CLUSTER).select(
        USER, "donor_id", "recs"
    )


def cold_start(new_users: DataFrame, donor_table: DataFrame, recs: DataFrame,
               served: DataFrame | None = None, max_donors: int = 1_000_000) -> DataFrame:
    """Recommendations for new users copied from their cluster's donor.

    ``new_users``: ``(user_id, cluster)``; ``donor_table``: ``(cluster, donor_id)``;
    ``recs``: ``(user_id, recs)``; ``served``: users that already have ALS
    recommendations, which are never replaced.  Output ``(user_id,
    donor_id, recs)`` with book ids only (scores null).  A cluster without a
    donor gives its users no row.
    """
    return copy_from_donors(new_users, donor_lists(donor_table, recs, max_donors), served)
