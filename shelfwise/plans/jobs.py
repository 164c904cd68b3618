"""Batch jobs: bootstrap a store, and the (nightly) retrain.

A *store* is one folder on shared storage:

    <root>/tables/history   ratings, one per (user, product), latest wins
    <root>/tables/users     user rows, per-cell latest
    <root>/tables/books     book rows, per-cell latest
    <root>/tables/recs      one list per user, whole-row latest, ALS over cold start
    <root>/tables/donors    a donor and its current list per clustering version and cluster
    <root>/tables/waiting   users who signed up when no donor could serve them
    <root>/tables/rejected  quarantined lines with the reason
    <root>/models           versioned ALS / k-means models

Every write is keyed by ``(writer, batch_id)`` and replaces that partition
when re-run, so a job that dies half way converges when it is run again.
Reading a freshly written table back (instead of reusing a long lineage)
also cuts the plan, so recomputation after a lost executor starts there.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import clusters, evaluate, factors, features, registry
from shelfwise.schemas import BOOKS, RATINGS, RECS, USERS
from shelfwise.sources import text
from shelfwise.sources.keyed import SEQ, KeyedTable, nullable

# Recommendation sources, ranked: an ALS list always beats a copied one.
SOURCE_RANK = {"cold_start": 1, "als": 2}

RECS_LOG = T.StructType(list(RECS.fields) + [T.StructField("source_rank", T.IntegerType(), True)])

DONORS = T.StructType(
    [
        T.StructField("kmeans_version", T.LongType(), True),
        T.StructField("cluster", T.IntegerType(), True),
        T.StructField("donor_id", T.LongType(), True),
        T.StructField("recs", nullable(RECS["recs"].dataType), True),
    ]
)

WAITING = T.StructType([T.StructField("user_id", T.LongType(), True), T.StructField("waits", T.BooleanType(), True)])

REJECTED_LOG = T.StructType(
    [
        T.StructField("kind", T.StringType(), True),
        T.StructField("line", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("writer", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)


def written_now() -> Column:
    """A ``_seq`` for rows that follow from the state at this moment, whoever writes them."""
    return F.struct(F.lit(int(time.time() * 1000)).cast("bigint").alias("at"), *[F.lit(0).cast("bigint").alias(c) for c in ("file", "block", "pos")])


@dataclass
class Store:
    spark: SparkSession
    root: str
    _loaded: dict = field(default_factory=dict, repr=False, compare=False)

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def history(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "history"), RATINGS, ["user_id", "product_id"], merge="row")

    @property
    def users(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "users"), USERS, ["user_id"], merge="cell")

    @property
    def books(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "books"), BOOKS, ["book_id"], merge="cell")

    @property
    def recs(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "recs"), RECS_LOG, ["user_id"], merge="row",
                          rank_cols=["source_rank", "model_version"])

    @property
    def donor_lists(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "donors"), DONORS, ["kmeans_version", "cluster"], merge="row")

    @property
    def waiting(self) -> KeyedTable:
        return KeyedTable(self.spark, self._p("tables", "waiting"), WAITING, ["user_id"], merge="row")

    @property
    def models(self) -> str:
        return self._p("models")

    def create(self) -> None:
        for t in (self.history, self.users, self.books, self.recs, self.donor_lists, self.waiting):
            t.create()

    def compact(self) -> dict:
        """Maintenance: a snapshot of each table, and what it makes superfluous removed; returns ``{table: snapshot}``."""
        tables = {"history": self.history, "users": self.users, "books": self.books, "recs": self.recs, "donors": self.donor_lists, "waiting": self.waiting}
        return {name: t.compact() for name, t in tables.items()}

    # -- quarantine ----------------------------------------------------------------

    def quarantine(self, rejected: DataFrame, kind: str, writer: str, batch_id: int) -> None:
        out = rejected.select(
            F.lit(kind).alias("kind"), "line", "reason",
            F.lit(writer).alias("writer"), F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("kind", "writer", "batch_id").parquet(self._p("tables", "rejected")))

    def rejected(self) -> DataFrame:
        return self.spark.read.schema(REJECTED_LOG).parquet(self._p("tables", "rejected"))

    # -- recommendations ---------------------------------------------------------------

    def write_recs(self, recs: DataFrame, source: str, model_version: int | None,
                   writer: str, batch_id: int, generation: int = 0) -> None:
        """K8: one set-based write; list and scores travel in one row."""
        out = recs.select(
            "user_id", "recs",
            F.lit(source).alias("source"),
            F.lit(model_version).cast("bigint").alias("model_version"),
            F.lit(SOURCE_RANK[source]).alias("source_rank"),
        )
        self.recs.upsert(out, writer, batch_id, generation)

    def recs_latest(self) -> DataFrame:
        return self.recs.latest(["recs", "source", "model_version"])

    def als_users(self, keys: DataFrame | None = None) -> DataFrame:
        """Users whose current list came from ALS (optionally among ``keys``).

        ALS is the highest source rank, so a user's current list is an ALS
        list exactly when the log holds any ALS row for that user: a distinct
        over two narrow columns, no merge of the lists themselves.
        """
        log = self.recs.rows(["source"]).filter(F.col("source") == "als")
        if keys is not None:
            log = log.join(keys.select("user_id").distinct(), "user_id", "left_semi")
        return log.select("user_id").distinct()

    # -- models ----------------------------------------------------------------------------

    def _current(self, kind: str, loader):
        """(version, model) of the newest registered ``kind``.

        The registry (a few rows) is read every time, so a retrain is seen
        by the next micro-batch; the model itself is loaded only when its
        version changes.
        """
        cur = registry.current(self.spark, self.models, kind)
        if cur is None:
            return None, None
        version, path = cur
        cached = self._loaded.get(kind)
        if cached is None or cached[0] != version:
            self._loaded[kind] = (version, loader(path))
        return self._loaded[kind]

    def current_als(self):
        return self._current("als", factors.FactorModel.load)

    def current_kmeans(self):
        return self._current("kmeans", KMeansModel.load)

    def snapshot_path(self, name: str) -> str:
        return self._p("snapshots", f"{name}-{uuid.uuid4().hex[:12]}")

    def trials_path(self, als_version: int) -> str:
        """Where the trials that chose an ALS version's parameters are kept."""
        return self._p("models", "trials", f"v{als_version}")

    def donors(self, kmeans_version: int) -> DataFrame:
        """Donors of a clustering version with their lists as they are now: ``(cluster, donor_id, recs)``, at most k rows."""
        rows = self.donor_lists.latest(["donor_id", "recs"])
        return rows.filter(F.col("kmeans_version") == kmeans_version).select("cluster", "donor_id", "recs")

    def write_donors(self, lists: DataFrame, kmeans_version: int, writer: str, batch_id: int, generation: int) -> None:
        """Donor lists ``(cluster, donor_id, recs)``, ids only; later ones of a cluster replace earlier ones whoever writes them."""
        ids_only = F.transform("recs", lambda x: F.struct(x["product_id"].alias("product_id"), F.lit(None).cast("double").alias("score")))
        out = lists.select(F.lit(kmeans_version).cast("bigint").alias("kmeans_version"), "cluster", "donor_id", ids_only.alias("recs"), written_now().alias(SEQ))
        self.donor_lists.upsert(out, writer, batch_id, generation)

    def refresh_donors(self, recs: DataFrame, writer: str, batch_id: int, generation: int) -> None:
        """Keeps donor lists current: of the users whose lists ``recs`` has just changed, donors change their cluster's row."""
        version, _ = self.current_kmeans()
        if version is None:
            return
        donors = self.donors(version).select("cluster", "donor_id")  # at most k rows
        self.write_donors(recs.withColumnRenamed("user_id", "donor_id").join(F.broadcast(donors), "donor_id"), version, writer, batch_id, generation)


# --- shared steps ------------------------------------------------------------------------------


def _user_vectors(users: DataFrame, feature_cols=features.DEFAULT_FEATURES) -> DataFrame:
    names = features.feature_names(feature_cols)
    return features.assemble(features.user_features(users, feature_cols), names)


def refresh_clusters(store: Store, n_clusters: int, max_iter: int = 20, seed: int = 1,
                     feature_cols=features.DEFAULT_FEATURES, donor_pool: str = "users") -> int:
    """Fit k-means on the current users, save it with its donor lists, and make it current; returns its version."""
    version, path, _ = fit_clusters(store, n_clusters, max_iter, seed, feature_cols, store.als_users(), donor_pool)
    registry.register(store.spark, store.models, "kmeans", version, path)
    return version


def fit_clusters(store: Store, n_clusters: int, max_iter: int, seed: int, feature_cols, eligible: DataFrame,
                 donor_pool: str = "users") -> tuple[int, str, int]:
    """A saved clustering that is not current yet: ``(version, path, skipped users)``.

    The features are written once and counted in the same pass.  The donor
    lists (one ALS list per cluster, at most k rows) are copied here, and by
    every rating batch that changes a donor's list, so a user micro-batch
    joins this small table instead of the recommendation table.

    ``donor_pool="ratings"`` looks for donors among rating rows taken as
    points, as the original did, in place of the users themselves.
    """
    value_cols, names = [c for c in feature_cols if c != "user_id"], features.feature_names(feature_cols)
    rows, seen = features.counted(features.user_features(store.users.latest(value_cols), feature_cols), names)
    kept = store.snapshot_path("features")
    rows.write.parquet(kept)
    vecs = features.assemble(store.spark.read.schema(rows.schema).parquet(kept), names)
    model = clusters.fit_kmeans(vecs, n_clusters, max_iter, seed)
    # written now, registered only after its donor lists exist, so a user
    # micro-batch never sees a clustering version without them
    version, path = registry.save(store.spark, model, store.models, "kmeans", register_now=False)
    if donor_pool == "ratings":
        pool = clusters.rating_pool(clusters.centers_frame(store.spark, model), store.history.latest())
    else:
        pool = clusters.assign(model, vecs)
    donor_table = clusters.donors(pool, eligible)
    # at most one row per cluster: materialise once (bounded, checked)
    found = donor_table.select(F.col("cluster").cast("int"), "donor_id").limit(n_clusters + 1).collect()
    if len(found) > n_clusters:
        raise ValueError(f"{len(found)} donors for {n_clusters} clusters")
    donor_table = store.spark.createDataFrame(found, "cluster int, donor_id bigint")
    donor_recs = store.recs.lookup(donor_table.select(F.col("donor_id").alias("user_id")), ["recs"])
    store.write_donors(clusters.donor_lists(donor_table, donor_recs), version, "kmeans", version, 0)
    return version, path, seen.get["skipped"]


def bootstrap_frames(
    store: Store,
    ratings: DataFrame,
    users: DataFrame,
    books: DataFrame,
    als_params: dict | None = None,
    k: int = 10,
    n_clusters: int = 100,
    kmeans_iter: int = 20,
    seed: int = 42,
    feature_cols=features.DEFAULT_FEATURES,
    load_id: int | None = None,
) -> DataFrame:
    """Load tables, train ALS, write every user's top-k, train k-means.

    Every load is a batch of its own: a later one changes what it holds
    anew.  ``load_id`` (by default the time in milliseconds) names it;
    running a broken load again under its id converges.  Returns a one-row
    summary ``(als_version, kmeans_version, skipped_users)``, the last being
    the users that a missing feature keeps out of the clustering.
    """
    params = dict(evaluate.DEFAULT_PARAMS, **(als_params or {}))
    load_id = int(time.time() * 1000) if load_id is None else load_id
    store.create()
    store.history.upsert(ratings, "bootstrap", load_id, 0)
    store.users.upsert(users, "bootstrap", load_id, 0, full=True)
    store.books.upsert(books, "bootstrap", load_id, 0, full=True)
    # train on what was stored: unique pairs
    als_version, model = refit_als(store, current_ratings(store), params, seed)
    store.write_recs(factors.recommend(model, k), "als", als_version, "bootstrap", load_id, 0)
    km_version, km_path, skipped = fit_clusters(store, n_clusters, kmeans_iter, 1, feature_cols, store.als_users())
    registry.register(store.spark, store.models, "kmeans", km_version, km_path)
    return store.spark.createDataFrame(
        [(als_version, km_version, skipped)], "als_version bigint, kmeans_version bigint, skipped_users bigint"
    )


def current_ratings(store: Store, path: str | None = None) -> DataFrame:
    """One rating per pair, written once under the store's root: numbering, splits and fits scan it, none merges the log again."""
    path = path or store.snapshot_path("ratings")
    store.history.latest().write.mode("overwrite").parquet(path)
    return store.spark.read.schema(RATINGS).parquet(path)


def refit_als(store: Store, rated: DataFrame, params: dict, seed: int) -> tuple[int, factors.FactorModel]:
    """Fit, save and make current the next ALS version; what the fit persisted is released."""
    version, path = save_als(store, rated, params, seed)
    registry.register(store.spark, store.models, "als", version, path)
    return version, store.current_als()[1]


def save_als(store: Store, rated: DataFrame, params: dict, seed: int) -> tuple[int, str]:
    """A saved ALS version that is not current yet: ``(version, path)``."""
    before = factors.persistent(store.spark)
    saved = registry.save(store.spark, factors.fit_als(rated, seed=seed, **params), store.models, "als", register_now=False)
    factors.release(store.spark, before)
    return saved


def backfill(store: Store, als_version: int, km_version: int, k: int = 10, feature_cols=features.DEFAULT_FEATURES) -> None:
    """Lists for users who have none yet although the new models know them.

    Users with factors but no ALS list get their top-k; then users with a
    cluster and no list at all get their donor's.
    """
    _, model = store.current_als()
    found = store.snapshot_path("missing")
    factors.known_users(model).join(store.als_users(), "user_id", "left_anti").write.parquet(found)
    missing = store.spark.read.schema("user_id bigint").parquet(found)
    if not missing.isEmpty():  # the model's items are only collected and sent for someone
        store.write_recs(factors.recommend(model, k, missing), "als", als_version, "retrain-als", als_version, 0)
    _, kmeans = store.current_kmeans()
    value_cols = [c for c in feature_cols if c != "user_id"]
    vecs = _user_vectors(store.users.latest(value_cols), feature_cols)
    served = store.recs.rows(["source"]).select("user_id").distinct()
    new = clusters.assign(kmeans, vecs).select("user_id", "cluster").join(served, "user_id", "left_anti")
    copied = clusters.copy_from_donors(new, store.donors(km_version))
    store.write_recs(copied.select("user_id", "recs"), "cold_start", None, "retrain-cold", als_version, 0)


def stage_parsed(store: Store, parsed: text.Parsed, kind: str) -> text.Parsed:
    """Write one parse of a text input to staging, partitioned by ``ok``.

    The input is read and parsed once; the good and the rejected side are
    then each read from their own partition (pruned at listing), and the
    lineage of every later step starts at the staged table.
    """
    path = store.snapshot_path(f"parsed-{kind}")
    staged = parsed.tagged.withColumn("ok", F.col("reason").isNull())
    staged.write.mode("overwrite").partitionBy("ok").parquet(path)
    back = store.spark.read.schema(staged.schema).parquet(path)
    good_cols = parsed.good.columns
    return text.Parsed(
        tagged=back,
        good=back.filter(F.col("ok")).select(*good_cols),
        rejected=back.filter(~F.col("ok")).select("line", "reason"),
    )


def bootstrap(spark: SparkSession, root: str, ratings_path: str, users_path: str, books_path: str,
              **kw) -> DataFrame:
    """Bootstrap from header-less comma text; bad lines go to quarantine."""
    store = Store(spark, root)
    store.create()
    readers = {"ratings": text.read_ratings, "users": text.read_users, "books": text.read_books}
    paths = {"ratings": ratings_path, "users": users_path, "books": books_path}
    kw["load_id"] = int(time.time() * 1000) if kw.get("load_id") is None else kw["load_id"]
    parsed = {kind: stage_parsed(store, readers[kind](spark, paths[kind], keep=[SEQ]), kind) for kind in readers}
    for kind, p in parsed.items():
        store.quarantine(p.rejected, kind, "bootstrap", kw["load_id"])
    return bootstrap_frames(store, parsed["ratings"].good, parsed["users"].good, parsed["books"].good, **kw)


def retrain(
    store: Store,
    param_grid: list[dict],
    parallelism: int = 2,
    n_clusters: int = 100,
    kmeans_iter: int = 20,
    max_rmse: float = evaluate.MAX_RMSE,
    seed: int = 42,
    feature_cols=features.DEFAULT_FEATURES,
    k: int = 10,
    run_id: str | None = None,
    on_step=None,
) -> DataFrame:
    """T4: choose ALS parameters by validation RMSE, refit on all ratings,
    refit k-means on the users; both become new model versions.

    ``param_grid`` is the caller's: ``evaluate.full_grid()`` is the original
    sweep.  Existing recommendations are left as they are; they change when
    a user next rates (as before).  Users without a list get one where the
    new models know them.  Returns a one-row summary.

    The new ALS version, its trials, the clustering and its donor lists are
    all written before one registry write makes them current together; until
    then every reader sees the old set whole.  A retrain that was broken off
    goes on under its ``run_id``: the ratings it began with and the trials
    it had finished are read back.  ``on_step`` is told the name of each
    step when it is done.
    """
    spark = store.spark
    grid = param_grid
    told = on_step or (lambda name: None)
    # the split, every trial and the final fit scan one snapshot of the current ratings
    run_id = run_id or uuid.uuid4().hex[:12]
    snapshot = store._p("snapshots", f"ratings-{run_id}")
    done = registry.exists(spark, f"{snapshot}/_SUCCESS")
    rated = spark.read.schema(RATINGS).parquet(snapshot) if done else current_ratings(store, snapshot)
    train, valid = evaluate.split(rated)
    # the snapshot holds one rating per pair
    trials = evaluate.sweep(train, valid, grid, parallelism=parallelism, seed=seed, unique_pairs=True, path=store._p("models", "trials", f"run-{run_id}"))
    best = evaluate.select_best(trials, max_rmse=max_rmse).first()
    params = {"rank": int(best["rank"]), "max_iter": int(best["max_iter"]), "reg_param": float(best["reg_param"])}
    told("sweep")
    als_version, als_path = save_als(store, rated, params, seed)
    told("als")
    trials.write.mode("overwrite").parquet(store.trials_path(als_version))
    told("trials")
    km_version, km_path, _ = fit_clusters(store, n_clusters, kmeans_iter, 1, feature_cols, store.als_users())
    told("clusters and donors")
    registry.register_all(spark, store.models, [("als", als_version, als_path), ("kmeans", km_version, km_path)])
    told("switch")
    backfill(store, als_version, km_version, k, feature_cols)
    told("backfill")
    row = (als_version, km_version, len(grid), params["rank"], params["max_iter"], params["reg_param"],
           best["rmse"], bool(best["is_default"]))
    return spark.createDataFrame(
        [row],
        "als_version bigint, kmeans_version bigint, n_trials bigint, rank int, max_iter int, "
        "reg_param double, rmse double, is_default boolean",
    )
