"""Matrix-factorisation recommendations.

* ``fit_als`` runs ``pyspark.ml`` ALS over ids of any size: ids past INT are
  numbered by a stored dictionary, once for all fits on the same ratings.
  The result is a pair of factor tables under the original ids.
* ``recommend`` / ``topk_from_factors`` score factor tables: blocks of items
  are broadcast one after the other, user rows are scored where they lie,
  leaves of near items that cannot reach a user's first k are left out, and
  each broadcast leaves at most k rows per user.  ``predict_pairs`` scores
  given pairs.

Scores include items the user already rated (as the original did), and are
not clamped to the rating scale.
"""

from __future__ import annotations

import gc
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.vectors import dot
from shelfwise.operators.registry import exists as registry_exists
from shelfwise.schemas import MAX_DISTINCT
from shelfwise.session import ensure_checkpoint_dir, scratch_path
from shelfwise.sources import placed
from shelfwise.sources.placed import Placed

USER = "user_id"
ITEM = "product_id"
RATING = "rating"

# The pandas functions below run in Python workers.  Pickle this module's
# code by value so executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- M1 / M2: fit -------------------------------------------------------------


#: Iterations between checkpoints: the shuffle files of all iterations since the last one stay on disk.  It changes no factor.
CHECKPOINT_EVERY = 2


def als(
    rank: int = 10,
    max_iter: int = 20,
    reg_param: float = 0.1,
    seed: int = 42,
    num_blocks: int = 10,
    implicit_prefs: bool = False,
    checkpoint_interval: int = CHECKPOINT_EVERY,
) -> ALS:
    est = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        seed=seed,
        userCol=USER,
        itemCol=ITEM,
        ratingCol=RATING,
        implicitPrefs=implicit_prefs,
        coldStartStrategy="drop",
        checkpointInterval=checkpoint_interval,
        # keep ALS's intermediate RDDs spill-able; factors are re-usable
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    return est.setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)


#: ALS blocks unless the job says otherwise, and the ratings of a block beyond which there are more; part of the model, not of the cluster it was fitted on.
NUM_BLOCKS = 10
BLOCK_RATINGS = 4_000_000


def blocks_for(n_ratings: int) -> int:
    """ALS blocks of so many ratings: a task holds a block's ratings several times over while blocks are made, and the factors they need in every iteration."""
    return max(NUM_BLOCKS, -(-n_ratings // BLOCK_RATINGS))


def dictionary(ids: DataFrame, id_col: str) -> DataFrame:
    """``(id, idx)``: distinct ids numbered 0, 1, ... without collecting them.

    Ids are dealt into parts by hash; a part's numbers start after those of
    the parts before it.  More than ALS can number are refused.
    """
    distinct = ids.select(F.col(id_col).cast("bigint").alias("id")).distinct()
    n = distinct.count()
    if n > MAX_DISTINCT:
        raise ValueError(f"{n} distinct {id_col} values: ALS numbers at most {MAX_DISTINCT}")
    parts = max(1, n // 50_000)
    dealt = distinct.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))  # a row per part
    place = F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1
    return dealt.withColumn("place", place).join(starts, "part").select("id", (F.col("start") + F.col("place")).cast("int").alias("idx"))


#: Users of a bucket of a saved factor table: small enough that scoring all users is spread over the tasks.
USER_BUCKET_ROWS = 1_500

FACTORS = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])


class FactorModel:
    """A fitted factorisation: ``users`` and ``items`` are ``(id, features)`` under the original ids."""

    def __init__(self, users: DataFrame, items: DataFrame, rank: int, als: ALSModel | None = None, path: str | None = None,
                 ids: dict[str, DataFrame] | None = None, n_users: int | None = None):
        self.users, self.items, self.rank, self.als, self.path, self.ids = users, items, rank, als, path, ids or {}
        self.n_users = n_users
        self._block = None

    def save_to(self, path: str) -> None:
        """Factor tables under ``path``, the users' placed by id, and the ``pyspark.ml`` model with its numbering beside them."""
        n_users = self.n_users if self.n_users is not None else self.users.count()
        placed.write(self.users.select("id", "features"), f"{path}/users", ["id"], n_users, USER_BUCKET_ROWS)
        self.items.write.mode("overwrite").parquet(f"{path}/items")
        if self.als is not None:
            self.als.write().overwrite().save(f"{path}/als")
        for short, ids in self.ids.items():
            ids.write.mode("overwrite").parquet(f"{path}/ids-{short}")

    @staticmethod
    def load(path: str) -> "FactorModel":
        spark = SparkSession.getActiveSession()
        users = Placed(spark, f"{path}/users", FACTORS, ["id"]).rows()
        items = spark.read.schema(FACTORS).parquet(f"{path}/items")
        first = items.select(F.size("features").alias("n")).first()
        return FactorModel(users, items, int(first["n"]) if first else 0, path=path)

    def of_users(self, wanted: DataFrame) -> DataFrame:
        """Factors of the users in ``wanted``; of a saved model only their buckets, and of few users only their pages, are read."""
        wanted = wanted.select(F.col(USER).cast("bigint").alias("id")).distinct()
        if self.path is not None:
            return Placed(wanted.sparkSession, f"{self.path}/users", FACTORS, ["id"]).of(wanted).select("id", "features")
        return self.users.select("id", "features").join(wanted, "id", "left_semi")


class Numbered:
    """Ratings under the INT ids that ALS wants, and the dictionaries of the ids that are not such already.

    Numbered once, for all fits on them: a sweep's trials share it.
    """

    def __init__(self, ratings: DataFrame, ids: dict[str, DataFrame], n_users: int, n_ratings: int):
        self.ratings, self.ids, self.n_users, self.n_ratings = ratings, ids, n_users, n_ratings

    def subset(self, rows: DataFrame) -> "Numbered":
        """The same numbering for other ratings of the same users and items."""
        return Numbered(_renamed(rows.select(USER, ITEM, RATING), self.ids), self.ids, self.n_users, self.n_ratings)

    def tables(self, model: ALSModel) -> tuple[DataFrame, DataFrame]:
        """Factor tables of a fitted model under the original ids."""
        out = []
        for short, found in (("u", model.userFactors), ("i", model.itemFactors)):
            if short in self.ids:
                ids = self.ids[short]
                named = found.join(ids, found["id"] == ids["idx"]).select(ids["id"], "features")
            else:
                named = found.select(F.col("id").cast("bigint").alias("id"), "features")
            out.append(named.select("id", F.col("features").cast("array<double>").alias("features")))
        return out[0], out[1]


def _renamed(ratings: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    for column, short in ((USER, "u"), (ITEM, "i")):
        if short in ids:
            ratings = ratings.join(ids[short].select(F.col("id").alias(column), F.col("idx").alias(f"_{short}")), column)
    names = [F.col(f"_{short}" if short in ids else column).cast("int").alias(column) for column, short in ((USER, "u"), (ITEM, "i"))]
    return ratings.select(*names, RATING)


def numbered(ratings: DataFrame) -> Numbered:
    """Numbers users and items whose ids do not all fit an INT; ids that do stay as they are.

    The dictionaries are written to shared storage; a job that fits several
    models on parts of the same ratings numbers once and passes the result.
    """
    spark = ratings.sparkSession
    ends = [f(F.col(c).cast("bigint")).alias(f"{s}_{n}") for c, s in ((USER, "u"), (ITEM, "i")) for f, n in ((F.min, "low"), (F.max, "high"))]
    seen = ratings.agg(*ends, F.approx_count_distinct(USER).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    root, ids = scratch_path(spark, "als-ids"), {}
    for column, short in ((USER, "u"), (ITEM, "i")):
        if (seen[f"{short}_high"] or 0) > MAX_DISTINCT or (seen[f"{short}_low"] or 0) < -MAX_DISTINCT:
            dictionary(ratings, column).write.parquet(f"{root}/{short}")
            ids[short] = spark.read.schema("id bigint, idx int").parquet(f"{root}/{short}")
    return Numbered(_renamed(ratings.select(USER, ITEM, RATING), ids), ids, int(seen["n"]), int(seen["rows"]))


def fit_als(ratings: DataFrame | Numbered, rank: int = 10, max_iter: int = 20, reg_param: float = 0.1,
            seed: int = 42, num_blocks: int | None = None, **kw) -> FactorModel:
    """Explicit-feedback ALS on ``(user_id, product_id, rating)``, ids of any BIGINT value.

    Lineage is cut every ``checkpoint_interval`` iterations into the
    session's checkpoint folder, so long fits survive lost executors.  The
    fit depends on ``num_blocks`` (by default on the number of ratings, see
    ``blocks_for``), not on the size of the cluster.
    """
    given = ratings if isinstance(ratings, Numbered) else numbered(ratings)
    ensure_checkpoint_dir(given.ratings.sparkSession)
    model = als(rank, max_iter, reg_param, seed, num_blocks or blocks_for(given.n_ratings), **kw).fit(given.ratings)
    users, items = given.tables(model)
    return FactorModel(users, items, rank, als=model, ids=given.ids, n_users=given.n_users)


def transform(path: str, pairs: DataFrame) -> DataFrame:
    """Scores pairs with the saved ``pyspark.ml`` model itself: adds ``prediction``; unknown ids drop out."""
    spark = pairs.sparkSession
    numbered = pairs
    for column, short in ((USER, "u"), (ITEM, "i")):
        if registry_exists(spark, f"{path}/ids-{short}"):
            ids = spark.read.schema("id bigint, idx int").parquet(f"{path}/ids-{short}")
            numbered = numbered.join(ids.select(F.col("id").alias(column), F.col("idx").alias(f"_{short}")), column)
        else:
            numbered = numbered.withColumn(f"_{short}", F.col(column).cast("int"))
    model = ALSModel.load(f"{path}/als").setUserCol("_u").setItemCol("_i").setColdStartStrategy("drop")
    return model.transform(numbered).drop("_u", "_i")


def release(spark: SparkSession, before: set[int]) -> None:
    """Unpersists the RDDs that fits have left behind since ``before`` (see ``persistent``), and lets their shuffle files go.

    Spark removes a shuffle's files once the driver has collected its last reference.
    """
    for key, rdd in dict(spark.sparkContext._jsc.getPersistentRDDs()).items():
        if int(key) not in before:
            rdd.unpersist(False)
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def persistent(spark: SparkSession) -> set[int]:
    return {int(k) for k in dict(spark.sparkContext._jsc.getPersistentRDDs())}


# --- L1 / J5: recommend ---------------------------------------------------------


def recommend(model: FactorModel, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """``(user_id, recs array<struct<product_id, score>>)``, best first.

    With ``users`` only those users are scored (cost follows the batch, not
    the user base); unseen users get no row.  A saved fit holds a user once:
    where one broadcast holds its items, a user's list is made where the user
    lies, and nothing is shuffled.
    """
    rows = model.users if users is None else model.of_users(users)
    if model.path is not None:
        sent, _ = _sent(_items(model.items), BLOCK_BYTES, model)
        if sent is not None:
            return _users(rows).mapInArrow(_scorer(sent, k, None, lists=True), schema=_LISTS)
    return collect_recs(topk_from_factors(rows, model.items, k, round_digits=None, model=model))


def explode_recs(recs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per recommendation: ``(user_id, rank, product_id, score)``."""
    keep = keep or []
    return recs.select(USER, *keep, F.posexplode("recs").alias("pos", "r")).select(
        USER,
        *keep,
        (F.col("pos") + 1).alias("rank"),
        F.col(f"r.{ITEM}").alias(ITEM),
        F.col("r.score").alias("score"),
    )


def collect_recs(ranked: DataFrame) -> DataFrame:
    """Back from rows to one list per user, in rank order (at most k rows each)."""
    return ranked.groupBy(USER).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", ITEM, "score"))),
            lambda x: F.struct(x[ITEM].alias(ITEM), x["score"].alias("score")),
        ).alias("recs")
    )


# --- M5 / J4: score given pairs -----------------------------------------------------


def predict_pairs(pairs: DataFrame, user_f: DataFrame, item_f: DataFrame,
                  round_digits: int | None = 6) -> DataFrame:
    """Pairs joined to both factor tables; unknown ids drop out (inner joins).

    An item table of at most BLOCK_BYTES (counted first) is broadcast, so
    that no user vector is shuffled a second time with its pair.
    """
    stats = item_f.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim")).first()
    small = int(stats["n"]) * int(stats["dim"] or 1) * 8 <= BLOCK_BYTES
    u = user_f.select(F.col("id").alias(USER), F.col("features").alias("_uf"))
    i = item_f.select(F.col("id").alias(ITEM), F.col("features").alias("_if"))
    score = dot(F.col("_uf"), F.col("_if"))
    if round_digits is not None:
        score = F.round(score, round_digits)
    return pairs.join(u, USER).join(F.broadcast(i) if small else i, ITEM).withColumn("score", score).drop("_uf", "_if")


def predict_with_model(model: FactorModel, pairs: DataFrame) -> DataFrame:
    """Adds ``prediction``; pairs with unknown ids are dropped."""
    return predict_pairs(pairs, model.users, model.items, None).withColumnRenamed("score", "prediction")


# --- J5: exact top-k over factor tables ----------------------------------------------

#: Bytes of a block of item factors, and of the blocks broadcast at once; a larger table is scored broadcast after broadcast.
BLOCK_BYTES = 64 * 1024 * 1024
SENT_BYTES = 2 * BLOCK_BYTES
#: Bytes of one score matrix, or of one batch of element products, inside a task.
CHUNK_BYTES = 32 * 1024 * 1024

_CANDIDATES = "uid bigint, iid bigint, score double"
_LISTS = f"{USER} bigint, recs array<struct<{ITEM}: bigint, score: double>>"


def _rounded(score: np.ndarray, digits: int | None, shift: float) -> np.ndarray:
    return score if digits is None else np.floor((score + shift) * 10.0**digits + 0.5)


def _all_near(block: np.ndarray, itf: np.ndarray, k: int, margin: float):
    """(row, item) pairs that can be among a row's k best: all products, then a cut below the k-th."""
    kk = min(k, len(itf))
    s = block @ itf.T
    kth = np.partition(s, len(itf) - kk, axis=1)[:, len(itf) - kk]
    near = kth - margin - 1e-9 * np.maximum(1.0, np.abs(kth))
    return np.nonzero(s >= near[:, None])


#: Items whose products are made at once when items come by falling norm.
STRIP = 512


def pruned_near(block: np.ndarray, itf: np.ndarray, k: int, margin: float, made: list | None = None):
    """As ``_all_near``, for items by falling norm: strips that cannot reach a row's k-th score are skipped.

    By Cauchy-Schwarz no product of a row with an item is above the product
    of their norms, so once the norm of a strip's first item times the
    row's falls below its k-th score so far, the row is done with all that
    follow.  ``made`` counts the products.
    """
    norm_u, norm_i = np.linalg.norm(block, axis=1), np.linalg.norm(itf, axis=1)
    best = np.full((len(block), min(k, len(itf))), -np.inf)
    found = []
    open_ = np.arange(len(block))
    for at in range(0, len(itf), STRIP):
        kth = best[open_].min(axis=1)
        slack = margin + 1e-9 * np.maximum(1.0, np.where(np.isfinite(kth), np.abs(kth), 1.0)) + 1e-9 * norm_u[open_] * norm_i[at]
        open_ = open_[norm_u[open_] * norm_i[at] >= kth - slack]
        if not len(open_):
            break
        s = block[open_] @ itf[at : at + STRIP].T
        if made is not None:
            made.append(s.size)
        both = np.concatenate([best[open_], s], axis=1)
        width = best.shape[1]
        best[open_] = np.partition(both, both.shape[1] - width, axis=1)[:, -width:]
        kth = best[open_].min(axis=1)
        floor = np.where(np.isfinite(kth), kth - margin - 1e-9 * np.maximum(1.0, np.abs(kth)), -np.inf)
        r, c = np.nonzero(s >= floor[:, None])
        found.append((open_[r], at + c, s[r, c]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, cols, score = (np.concatenate(x) for x in zip(*found, strict=True))
    kth = best.min(axis=1)
    stay = score >= (kth - margin - 1e-9 * np.maximum(1.0, np.abs(kth)))[rows]
    return rows[stay], cols[stay]


#: Items of a leaf, whose products are made at once (more in a block of more than 128 such leaves), and the leaves a row tries before it rules out others.
LEAF_ROWS, LARGE_LEAF_ROWS = 256, 1024
FIRST_LEAVES = 4
#: Products made at once of a leaf and some rows, so that they are looked through before they leave the cache.
TILE = 1 << 18
#: What single precision can make of a product of vectors of norm 1 at most, per dimension (more than three times the bound).
THIN_ERROR = 2e-7


def leaves_of(points: np.ndarray, rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """``(order, starts)``: points dealt into leaves of at most ``rows`` by halving along the dimension of the largest variance."""
    order, starts, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        a, b = todo.pop()
        if b - a <= max(1, rows):
            starts.append(a)
            continue
        part = points[order[a:b]]
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, part.var(axis=0).argmax()], mid)] if part.shape[1] else order[a:b]
        todo += [(a, a + mid), (a + mid, b)]
    return order, np.sort(np.array(starts))


def with_leaves(iid: np.ndarray, itf: np.ndarray) -> tuple:
    """A block of items in the order of their leaves: ids, factors, and each leaf's start, centre and radius (no leaves where a factor is not finite).

    Beside the leaves stand the factors in single precision, what they were divided by, and their largest norm.  Factors that
    single precision holds exactly, as those of a fit, are kept in it alone; others stand there a second time, scaled to norm 1 at most.
    """
    if not len(iid) or not np.isfinite(itf).all():
        return iid, itf, None
    order, starts = leaves_of(itf, min(LARGE_LEAF_ROWS, max(LEAF_ROWS, len(itf) // 128)))
    iid, itf = iid[order], itf[order]
    sizes = np.diff(np.append(starts, len(itf)))
    centres = np.add.reduceat(itf, starts, axis=0) / sizes[:, None]
    radii = np.sqrt(np.maximum.reduceat(np.square(itf - np.repeat(centres, sizes, axis=0)).sum(axis=1), starts))
    scale, most, thin = np.linalg.norm(itf, axis=1).max(), 1.0, None
    with np.errstate(over="ignore"):
        single = itf.astype(np.float32)
    if 1e-30 < scale < 1e30 and (single == itf).all():
        itf, thin, scale, most = single, single, 1.0, scale
    elif _thinnable(scale):
        thin = (itf / scale).astype(np.float32)
    # widened, so that no rounding puts a bound below a product
    return iid, itf, (starts, centres, radii + 1e-9 * (radii + np.linalg.norm(centres, axis=1)), thin, scale, most)


def _thinnable(norms) -> bool:
    """Whether vectors of these norms can be scaled to norm 1."""
    return bool(np.all((norms > 1e-100) & (norms < 1e100)))


def _floor(least: np.ndarray, margin: float) -> np.ndarray:
    return least - margin - 1e-9 * np.maximum(1.0, np.where(np.isfinite(least), np.abs(least), 1.0))


def _places(flags: np.ndarray, size: int) -> np.ndarray:
    """Where the first ``size`` of some rare flags are set, looked for eight at a time; ``flags`` has room for eight more."""
    flags[size : size + 8] = False
    eights = flags[: -(-size // 8) * 8].reshape(-1, 8)
    some = np.flatnonzero(eights.view(np.uint64))
    which, place = np.nonzero(eights[some])
    return some[which] * 8 + place


def leaf_near(rows: np.ndarray, itf: np.ndarray, leaves: tuple, k: int, margin: float, least: np.ndarray, made: list | None = None):
    """(row, item) pairs that can be among a row's k best, in several goes; ``least`` holds each row's k-th score so far.

    No product of a row with a leaf's items is above its product with the
    leaf's centre plus its norm times the leaf's radius.  Each row tries its
    most promising leaves first; then every leaf is taken with those rows
    whose bound there reaches their k-th score.  Products are made in single
    precision of rows scaled to norm 1 (and items, see ``with_leaves``); what
    that can be off by is taken off the k-th score.  Whoever takes the pairs may raise ``least`` between
    goes.  ``made`` counts the products.
    """
    starts, centres, radii, thin, scale, thickest = leaves
    ends, at, norms = np.append(starts[1:], len(itf)), np.arange(len(rows)), np.linalg.norm(rows, axis=1)
    bound = centres @ rows.T + radii[:, None] * norms
    most = max(1 << 16, 4 * k * len(rows))
    found, n = [], 0
    if thin is None or not _thinnable(norms):
        left, right, scales, off = rows, itf, np.ones(len(rows)), 0.0
    else:
        left, right, scales, off = (rows / norms[:, None]).astype(np.float32), thin, norms * scale, THIN_ERROR * (rows.shape[1] + 8) * thickest
    space = np.empty(max(TILE, int((ends - starts).max())), left.dtype)

    def products(want, leaf, raises):
        a, b, met = starts[leaf], ends[leaf], []
        few, items = max(1, TILE // int(b - a)), right[a:b].T
        low = None if raises else lows(want)
        for i in range(0, len(want), few):
            some = want[i : i + few]
            s = np.matmul(left[some], items, out=space[: len(some) * (b - a)].reshape(len(some), b - a))
            if raises and b - a >= k:
                kth = np.partition(s, b - a - k, axis=1)[:, b - a - k].astype(np.float64)
                least[some] = np.maximum(least[some], (kth - off) * scales[some])
            reach = lows(some) if raises else low[i : i + few]
            # few rows have any: a row's largest product tells (one that is no number tells nothing)
            high = np.flatnonzero(~(s.max(axis=1) < reach))
            if len(high):
                met.append((some[high], s[high], reach[high]))
        if made is not None:
            made.append(len(want) * int(b - a))
        if not met:
            return 0
        some, s, reach = (np.concatenate(x) for x in zip(*met, strict=True))
        flags = np.empty(s.size + 8, bool)
        np.greater_equal(s, reach[:, None], out=flags[: s.size].reshape(s.shape))
        hit = _places(flags, s.size)
        found.append((some[hit // (b - a)], a + hit % (b - a)))
        return len(hit)

    def lows(want):
        with np.errstate(over="ignore"):  # below all products
            return (_floor(least[want], margin) / scales[want] - off).astype(left.dtype)

    def taken():
        out = tuple(np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        return out

    for _ in range(FIRST_LEAVES if len(starts) > FIRST_LEAVES else int(np.isinf(least).any())):
        leaf = bound.argmax(axis=0)
        want = np.flatnonzero(bound[leaf, at] >= _floor(least, margin))
        if not len(want):
            break
        want = want[np.argsort(leaf[want], kind="stable")]
        cuts = np.flatnonzero(np.diff(leaf[want], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(want)], strict=True):
            n += products(want[a:b], leaf[want[a]], True)
            if n > most:
                yield taken()
                n = 0
        bound[leaf[want], want] = -np.inf
        if found:
            yield taken()
            n = 0
    floor = _floor(least, margin)
    for leaf in np.argsort(-bound.max(axis=1), kind="stable"):
        want = np.flatnonzero(bound[leaf] >= floor)
        want = want[np.isfinite(bound[leaf, want])]
        if len(want):
            n += products(want, leaf, False)
        if n > most:
            yield taken()
            n, floor = 0, _floor(least, margin)
    if found:
        yield taken()


def _goes(rows: np.ndarray, block: tuple, k: int, margin: float, least: np.ndarray, near):
    """(row, item) pairs of one block that can be among the k best."""
    iid, itf, leaves = block
    if near is not None or leaves is None or not np.isfinite(rows).all():
        few = max(1, CHUNK_BYTES // (8 * len(itf)))
        for a in range(0, len(rows), few):
            r, c = (near or _all_near)(rows[a : a + few], itf, k, margin)
            yield a + r, c
        return
    # a row of zeros scores 0 everywhere: the smallest ids win
    zero = ~rows.any(axis=1)
    if zero.any():
        first = np.argsort(iid, kind="stable")[:k]
        yield np.repeat(np.flatnonzero(zero), len(first)), np.tile(first, int(zero.sum()))
    some = np.flatnonzero(~zero)
    if not len(some):
        return
    part = least[some]
    for r, c in leaf_near(rows[some], itf, leaves, k, margin, part):
        yield some[r], c
        part[:] = np.maximum(part, least[some])


def _best(uid: np.ndarray, uf: np.ndarray, iid: np.ndarray, itf: np.ndarray, k: int, digits: int | None, near=None):
    """Each user's k best items of one block by (score, item id), as frames (see ``_best_of``)."""
    yield from _best_of(uid, uf, [with_leaves(iid, itf)], k, digits, near)


def _best_of(uid: np.ndarray, uf: np.ndarray, blocks: list, k: int, digits: int | None, near=None):
    """Each user's k best items of some blocks by (score, item id), as frames.

    Matrix products only choose; the score returned is a sequential left
    fold of the element products (the value a column expression gives).
    With rounding, a score within 1e-9 of a rounding edge is ranked both
    ways, and what either ranking keeps goes on to the final one.  Blocks
    are taken one after the other; each user's k-th score so far holds for
    the blocks that follow.
    """
    margin = 0.0 if digits is None else 10.0**-digits
    widest = max(LEAF_ROWS, *(len(b[2][0]) if b[2] else 1 for b in blocks))
    step = max(1, CHUNK_BYTES // (8 * widest))
    if len(uf) > step and near is None and np.isfinite(uf).all():
        order, _ = leaves_of(uf, step)  # rows that are scored together are near one another
        uid, uf = uid[order], uf[order]
    for at in range(0, len(uf), step):
        rows = uf[at : at + step]
        least = np.full(len(rows), -np.inf)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for block in blocks:
            if len(block[0]):
                for r, c in _goes(rows, block, k, margin, least, near):
                    best = _merged(best, (r, block[0][c], _folded(rows, r, block[1], c)), k, digits, least)
        order = np.lexsort((best[1], -best[2], best[0]))
        r, ids, score = (x[order] for x in best)
        yield pd.DataFrame({"uid": uid[at + r], "iid": ids, "score": score})


def _folded(rows: np.ndarray, r: np.ndarray, itf: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of (row, item) pairs, each a sequential left fold."""
    dim = itf.shape[1]
    exact = np.zeros(len(r))
    few = max(1, CHUNK_BYTES // (8 * max(1, dim)))
    for a in range(0, len(r), few):
        fold = np.add.accumulate(rows[r[a : a + few]] * itf[c[a : a + few]], axis=1)
        exact[a : a + few] = fold[:, -1] if dim else 0.0
    return exact


def _merged(best: tuple, more: tuple, k: int, digits: int | None, least: np.ndarray) -> tuple:
    """``best`` with further ``(row, item id, score)``: what is among a row's k first; raises ``least`` to the k-th scores."""
    touched = np.zeros(len(least), bool)
    touched[more[0]] = True
    old = touched[best[0]]
    r, ids, score = (np.concatenate([b[old], m]) for b, m in zip(best, more, strict=True))
    kept = np.zeros(len(r), bool)
    for shift in (0.0,) if digits is None else (-1e-9, 1e-9):
        order = np.lexsort((ids, -_rounded(score, digits, shift), r))
        by = r[order]
        place = np.arange(len(by)) - np.searchsorted(by, by)
        kept[order[place < k]] = True
    r, ids, score = r[kept], ids[kept], score[kept]
    order = np.lexsort((-score, r))
    by = r[order]
    kth = np.arange(len(by)) - np.searchsorted(by, by) == k - 1
    least[by[kth]] = np.maximum(least[by[kth]], score[order][kth])
    return tuple(np.concatenate([b[~old], x]) for b, x in zip(best, (r, ids, score), strict=True))


def _stack(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows' vectors, one a row of a matrix; all must be as long."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten()
    if col.null_count or not len(col) or len(flat) % len(col) or (np.diff(col.offsets.to_numpy()) != len(flat) // len(col)).any():
        return np.stack(col.to_pandas().to_numpy()).astype(np.float64)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _scorer(sent, k: int, digits: int | None, prune: bool = False, lists: bool = False):
    """Candidates of the users of a task, or with ``lists`` each user's list whole (of distinct users and all items)."""

    def score(batches):
        blocks = sent.value
        if prune:
            by_norm = [np.argsort(-np.linalg.norm(b[1], axis=1), kind="stable") if len(b[0]) else np.zeros(0, np.int64) for b in blocks]
            blocks = [(b[0][order], b[1][order].astype(np.float64), None) for b, order in zip(blocks, by_norm, strict=True)]
        for batch in batches:
            if batch.num_rows:
                for best in _best_of(batch.column("uid").to_numpy(zero_copy_only=False), _stack(batch.column("uf")), blocks, k, digits, pruned_near if prune else None):
                    yield _as_lists(best) if lists else pa.RecordBatch.from_pandas(best, preserve_index=False)

    return score


def _as_lists(best: pd.DataFrame) -> pa.RecordBatch:
    """Rows of one user after the other, best first, as one list a user."""
    uid = best["uid"].to_numpy()
    starts = np.flatnonzero(np.diff(uid, prepend=uid[0] - 1)) if len(uid) else np.zeros(0, np.int64)
    recs = pa.StructArray.from_arrays([pa.array(best["iid"].to_numpy()), pa.array(best["score"].to_numpy())], names=[ITEM, "score"])
    return pa.RecordBatch.from_arrays([pa.array(uid[starts]), pa.ListArray.from_arrays(pa.array(np.append(starts, len(uid)).astype(np.int32)), recs)], names=[USER, "recs"])


def _rank(cand: DataFrame, k: int, round_digits: int | None) -> DataFrame:
    score = F.round("score", round_digits) if round_digits is not None else F.col("score")
    w = Window.partitionBy(USER).orderBy(F.col("score").desc(), F.col(ITEM).asc())
    return (
        cand.select(F.col("uid").alias(USER), F.col("iid").alias(ITEM), score.alias("score"))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(USER, "rank", ITEM, "score")
    )


def _send(items: DataFrame):
    """Blocks of items (column ``b``), of at most about SENT_BYTES together, as a broadcast list (see ``with_leaves``)."""
    local = items.select("b", "iid", "features").toArrow()
    if not local.num_rows:
        return items.sparkSession.sparkContext.broadcast([with_leaves(np.zeros(0, np.int64), np.zeros((0, 0)))])
    number, iid = local["b"].to_numpy(), local["iid"].to_numpy()
    itf = _stack(local["features"])
    values = [with_leaves(iid[number == b], itf[number == b]) for b in np.unique(number)]
    return items.sparkSession.sparkContext.broadcast(values)


def _users(user_f: DataFrame) -> DataFrame:
    return user_f.select(F.col("id").cast("bigint").alias("uid"), F.col("features").cast("array<double>").alias("uf"))


def _items(item_f: DataFrame) -> DataFrame:
    return item_f.select(F.col("id").cast("bigint").alias("iid"), F.col("features").cast("array<double>").alias("features"))


def _sent(items: DataFrame, block_bytes: int, model: FactorModel | None):
    """``(broadcast, blocks)``: all items' blocks where one broadcast holds them, which then stays with the model; otherwise None and how many they are."""
    if model is not None and model._block is not None:
        return model._block, 1
    stats = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim")).first()
    n_blocks = max(1, -(-int(stats["n"]) * int(stats["dim"] or 1) * 8 // block_bytes))
    if n_blocks > max(1, SENT_BYTES // block_bytes):
        return None, n_blocks
    sent = _send(_dealt(items, n_blocks))
    if model is not None:
        model._block = sent
    return sent, n_blocks


def _dealt(items: DataFrame, n_blocks: int) -> DataFrame:
    return items.withColumn("b", F.pmod(F.xxhash64("iid"), F.lit(n_blocks)))


def topk_from_factors(
    user_f: DataFrame,
    item_f: DataFrame,
    k: int = 10,
    round_digits: int | None = 6,
    block_bytes: int = BLOCK_BYTES,
    model: FactorModel | None = None,
    prune: bool = False,
) -> DataFrame:
    """Exact top-k items per user by dot product: ``(user_id, rank, product_id, score)``.

    Ranking: score (rounded to ``round_digits``) descending, then product id
    ascending.  Items are dealt into blocks of ``block_bytes``; as many
    blocks as fill SENT_BYTES are broadcast at once and taken one after the
    other, and leave at most k rows per user (a few more at rounding edges),
    written to shared storage before the next broadcast.  Users are never
    shuffled.  A model's only broadcast stays with it.  Within a block, items
    stand in leaves, and only leaves whose bound reaches a user's k-th score
    are multiplied out (see ``leaf_near``).

    ``prune`` takes a block's items by falling norm and leaves out products
    that no bound allows into the first k (see ``pruned_near``): the same
    result, fewer products where norms differ.
    """
    spark = user_f.sparkSession
    users, items = _users(user_f), _items(item_f)
    sent, n_blocks = _sent(items, block_bytes, model)
    if sent is not None:
        return _rank(users.mapInArrow(_scorer(sent, k, round_digits, prune), schema=_CANDIDATES), k, round_digits)
    at_once, dealt = max(1, SENT_BYTES // block_bytes), _dealt(items, n_blocks)
    root = scratch_path(spark, "topk")
    firsts = range(0, n_blocks, at_once)
    for b in firsts:
        sent = _send(dealt.filter(F.col("b").between(b, b + at_once - 1)))
        users.mapInArrow(_scorer(sent, k, round_digits, prune), schema=_CANDIDATES).write.parquet(f"{root}/block={b}")
        sent.destroy()
    return _rank(spark.read.schema(_CANDIDATES).parquet(*[f"{root}/block={b}" for b in firsts]), k, round_digits)


# --- A1 / F1 / J2: who is known ---------------------------------------------------


def distinct_users(ratings: DataFrame) -> DataFrame:
    """Distinct user ids - kept distributed, never collected."""
    return ratings.select(USER).distinct()


def known_users(model: FactorModel) -> DataFrame:
    """Users the model has factors for (and can therefore recommend to)."""
    return model.users.select(F.col("id").alias(USER))


def split_known(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of known users, rows of unknown users): semi- and anti-join."""
    known = known.select(USER)
    return rows.join(known, USER, "left_semi"), rows.join(known, USER, "left_anti")


def flag_known(rows: DataFrame, known: DataFrame, flag: str = "is_known") -> DataFrame:
    """Both sides of ``split_known`` in one pass: a left join on the distinct
    known ids, so the rows are shuffled once, not once per side."""
    ids = known.select(USER).distinct().withColumn("_known", F.lit(True))
    return rows.join(ids, USER, "left").withColumn(
        flag, F.coalesce(F.col("_known"), F.lit(False))
    ).drop("_known")
