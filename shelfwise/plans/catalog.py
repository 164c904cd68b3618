"""The registered queries: one per operator group, each over whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the SQL in ``shelfwise.plans.oracle``.  Inputs are the
driver's tables or frames Spark derives from them (``shelfwise.fixtures``);
queries that need files (text sources, keyed tables, feeds) write them under
the session's checkpoint folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise import fixtures as fx
from shelfwise.functions import lists
from shelfwise.operators import clusters, evaluate, factors, features
from shelfwise.plans import jobs
from shelfwise.schemas import USERS
from shelfwise.session import scratch_path
from shelfwise.sources import text
from shelfwise.sources.keyed import KeyedTable

ROUND = 6


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage, for queries that use a derived frame several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- sources (S1-S3) -------------------------------------------------------------------


def ratings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings rendered as comma text, written, read back through the parser."""
    path = scratch_path(spark, "ratings-text")
    text.write_lines(fx.rating_lines(fx.ratings(spark, sf_dir)), path)
    return text.read_ratings(spark, path).good


def users_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "users-text")
    text.write_lines(fx.user_lines(fx.users(spark, sf_dir)), path)
    return text.read_users(spark, path).good


def books_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "books-text")
    text.write_lines(fx.book_lines(fx.books(spark, sf_dir)), path)
    return text.read_books(spark, path).good


def users_parse_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept user lines of a faulty producer: gender or age null where it is no number, ids past INT."""
    return text.parse_users(fx.faulty_user_lines(spark, sf_dir), keep=["event_id"]).good


def skipped_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a faulty producer, counted by the scan that writes their features: rejected ones, and users a missing feature keeps out."""
    parsed = text.parse_users(fx.faulty_user_lines(spark, sf_dir), keep=["event_id"])
    rejected = Observation()
    tagged = parsed.tagged.observe(rejected, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejected"))
    names = features.feature_names()
    rows, seen = features.counted(features.user_features(tagged.filter(F.col("reason").isNull())), names)
    path = scratch_path(spark, "features")
    rows.write.parquet(path)
    vectors = features.assemble(spark.read.schema(rows.schema).parquet(path), names).count()
    counts = (rejected.get["lines"], rejected.get["rejected"], seen.get["skipped"], vectors)
    return spark.createDataFrame([counts], "n_lines bigint, n_rejected bigint, n_skipped bigint, n_vectors bigint")


def books_parse_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept book lines of a faulty producer: 13-digit ids, averages null where they are no number."""
    return text.parse_books(fx.faulty_book_lines(spark, sf_dir), keep=["event_id"]).good


def parse_wide_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating lines whose ids are past INT, read back whole."""
    feed = fx.rating_feed(spark, sf_dir)
    moved = feed.select("event_id", fx.wide(F.col("user_id")).alias("user_id"), fx.wide(F.col("product_id")).alias("product_id"), "rating")
    lines = moved.select("event_id", F.concat_ws(",", "user_id", "product_id", "rating").alias("value"))
    return text.parse_ratings(lines, keep=["event_id"]).good


def feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted lines of the faulty rating feed."""
    return text.parse_ratings(fx.faulty_feed_lines(spark, sf_dir), keep=["event_id"]).good


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined lines of the faulty rating feed, with the reason."""
    return text.parse_ratings(fx.faulty_feed_lines(spark, sf_dir), keep=["event_id"]).rejected


def history_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5's whitespace tokenising.  Feed events are paired (event_id div 2)
    into one space-separated line - as a producer may drop them - and split
    back into one rating line per token before parsing."""
    feed = fx.rating_feed(spark, sf_dir)
    tokens = feed.select(
        (F.col("event_id") / 2).cast("bigint").alias("pair"),
        F.struct("event_id", F.concat_ws(",", "user_id", "product_id", "rating").alias("tok")).alias("t"),
    )
    # groups hold at most two events
    lines = tokens.groupBy("pair").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda x: x["tok"]), " ").alias("value")
    )
    good = text.parse_ratings(text.tokens_to_lines(lines)).good
    return good.groupBy("user_id", "product_id", "rating").agg(F.count(F.lit(1)).alias("n"))


# --- known users (A1, F1, J2) ------------------------------------------------------------


def _training_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.ratings(spark, sf_dir).filter(~fx.is_new_user(F.col("user_id")))


def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.distinct_users(fx.ratings(spark, sf_dir))


def known_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.rating_feed(spark, sf_dir)
    known = factors.distinct_users(_training_ratings(spark, sf_dir))
    return factors.flag_known(feed, known)


# --- features (P1, P2) ---------------------------------------------------------------------


def user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = features.feature_names()
    assembled = features.assemble(features.user_features(fx.users(spark, sf_dir)), cols)
    arr = features.to_array(assembled, "features")
    return arr.select("user_id", *[F.col("features")[i].alias(c) for i, c in enumerate(cols)])


# --- evaluation (M3, J1, A2, A3) -------------------------------------------------------------


def train_valid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.split_flag(fx.ratings(spark, sf_dir))


def rmse_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-product mean of the training side predicts the validation side."""
    train, valid = evaluate.split(staged(fx.ratings(spark, sf_dir), "ratings"))
    means = train.groupBy("product_id").agg(F.avg("rating").alias("prediction"))
    pred = valid.select("user_id", "product_id").join(means, "product_id")
    out = evaluate.rmse_frame(pred, valid)
    return out.select(F.round("rmse", ROUND).alias("rmse"), "n_pairs")


def rmse_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed scored against itself: repeated pairs join m x m times."""
    feed = fx.rating_feed(spark, sf_dir)
    pred = feed.select("user_id", "product_id", F.col("rating").alias("prediction"))
    out = evaluate.rmse_frame(pred, feed)
    return out.select(F.round("rmse", ROUND).alias("rmse"), "n_pairs")


# Damping values of the baseline sweep used to feed select_best.
BASELINE_DAMPING = [0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0]
SELECT_THRESHOLDS = [1.0, 10.0]


def baseline_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials table of a damped per-product-mean predictor, one pass for all trials."""
    train, valid = evaluate.split(staged(fx.ratings(spark, sf_dir), "ratings"))
    stats = train.groupBy("product_id").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n"))
    mu = train.agg(F.avg("rating")).first()[0]  # one scalar
    params = F.explode(
        F.array(*[F.struct(F.lit(i + 1).alias("trial_no"), F.lit(d).alias("d")) for i, d in enumerate(BASELINE_DAMPING)])
    )
    scored = (
        valid.join(stats, "product_id")
        .select("rating", "s", "n", F.lit(mu).alias("mu"), params.alias("t"))
        .select(
            F.col("t.trial_no").alias("trial_no"),
            F.col("t.d").alias("d"),
            ((F.col("s") + F.col("t.d") * F.col("mu")) / (F.col("n") + F.col("t.d")) - F.col("rating")).alias("err"),
        )
    )
    return scored.groupBy("trial_no", "d").agg(F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse")).select(
        F.col("trial_no").cast("int"),
        F.lit(1).alias("rank"),
        F.lit(1).alias("max_iter"),
        F.col("d").cast("double").alias("reg_param"),
        F.round("rmse", ROUND).alias("rmse"),
    )


def select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = staged(baseline_trials(spark, sf_dir), "trials")
    outs = [
        evaluate.select_best(trials, max_rmse=t).withColumn("threshold", F.lit(t))
        for t in SELECT_THRESHOLDS
    ]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


# --- factor tables (J4, J5, L1, P6, P7) ----------------------------------------------------------


def predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.rating_feed(spark, sf_dir).select("event_id", "user_id", "product_id")
    return factors.predict_pairs(pairs, fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), ROUND).select(
        "event_id", "user_id", "product_id", "score"
    )


def topk_from_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.topk_from_factors(fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), 10, ROUND)


def topk_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact top-k without the products that the items' and users' norms rule out."""
    return factors.topk_from_factors(fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), 10, ROUND, prune=True)


def topk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k where all scores tie: every fifth user has zero factors, so the smallest item ids win."""
    zero = F.transform("features", lambda x: x * 0.0)
    users = fx.user_factors(spark, sf_dir).withColumn("features", F.when(F.col("id") % 5 == 0, zero).otherwise(F.col("features")))
    return factors.topk_from_factors(users, fx.item_factors(spark, sf_dir), 10, ROUND)


def topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same top-k with items dealt into several broadcast blocks."""
    return factors.topk_from_factors(fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), 10, ROUND, block_bytes=64 * 1024)


def recs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = factors.collect_recs(topk_from_factors(spark, sf_dir))
    return recs.select("user_id", lists.books_text(F.col("recs")).alias("books"),
                       lists.scores_text(F.col("recs")).alias("scores"))


def recs_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    txt = recs_text(spark, sf_dir)
    parsed = txt.select("user_id", lists.recs_from_text(F.col("books"), F.col("scores")).alias("recs"))
    return factors.explode_recs(parsed)


# --- clusters (M7, F2, L2, M8, J3, M9) -------------------------------------------------------------


def assign_to_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters.assign_to_centers(fx.embedding_points(spark, sf_dir), fx.embedding_centers(spark, sf_dir))
    return out.select("id", "center_id", F.round("dist", ROUND).alias("dist"))


CLUSTER_FEATURES = ("gender", "age")


def _user_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's nearest fixed centre (every 150th user, on gender and age)."""
    users = fx.users(spark, sf_dir)
    pts = users.select(F.col("user_id").alias("id"), F.array(*[F.col(c) for c in CLUSTER_FEATURES]).alias("features"))
    centers = pts.filter(F.col("id") % fx.USER_CENTER_MODULUS == 0).select(F.col("id").alias("center_id"), "features")
    return clusters.assign_to_centers(pts, centers).select(
        F.col("id").alias("user_id"), F.col("center_id").alias("cluster")
    )


def _given_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recommendation table for existing users: their 10 best-rated products."""
    r = _training_ratings(spark, sf_dir)
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc(), F.col("product_id").asc())
    ranked = r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 10).select(
        "user_id", "rank", "product_id", F.col("rating").alias("score")
    )
    return factors.collect_recs(ranked)


def same_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _user_clusters(spark, sf_dir)
    new = assigned.filter(fx.is_new_user(F.col("user_id")))
    existing = assigned.filter(~fx.is_new_user(F.col("user_id")))
    members = clusters.cluster_sizes(clusters.same_cluster(existing, new))
    return new.join(members, "cluster").select("user_id", "cluster", "n_members")


def cluster_donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _given_recs(spark, sf_dir)
    return clusters.donors(_user_clusters(spark, sf_dir), recs)


def donors_from_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Donors by the original's pool: rating rows as points (user, product, rating) against centres (user, gender, age)."""
    centers = fx.users(spark, sf_dir).filter(F.col("user_id") % fx.USER_CENTER_MODULUS == 0)
    centers = centers.select(F.col("user_id").alias("center_id"), F.array(F.col("user_id").cast("double"), "gender", "age").alias("features"))
    rated = staged(_training_ratings(spark, sf_dir), "ratings")
    return clusters.donors(clusters.rating_pool(centers, rated), rated.select("user_id").distinct())


def cold_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = staged(_user_clusters(spark, sf_dir), "assigned")
    recs = staged(_given_recs(spark, sf_dir), "recs")
    donor_table = staged(clusters.donors(assigned, recs), "donors")
    new = assigned.filter(fx.is_new_user(F.col("user_id")))
    out = clusters.cold_start(new, donor_table, recs, served=recs)
    return factors.explode_recs(out, keep=["donor_id"]).select("user_id", "donor_id", "rank", "product_id")


# --- keyed tables (K1-K4, S7, S8) -------------------------------------------------------------------


def _users_table(spark: SparkSession, name: str) -> KeyedTable:
    return KeyedTable(spark, scratch_path(spark, name), USERS, ["user_id"], merge="cell")


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap all users, then a feed batch rewrites every third user."""
    users = fx.users(spark, sf_dir)
    table = _users_table(spark, "users-latest")
    table.create()
    table.upsert(users, writer="bootstrap", batch_id=0, generation=0)
    changed = users.filter(F.col("user_id") % 3 == 0).select(
        "user_id", "nick_name", "gender",
        (F.col("age") + 1).alias("age"),
        F.concat(F.col("read_style"), F.lit("-2")).alias("read_style"),
        "user_label",
    )
    table.upsert(changed, writer="users-feed-g1", batch_id=0, generation=1)
    return table.latest()


def upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial write (key + one cell) keeps every other cell of the row."""
    users = fx.users(spark, sf_dir)
    table = _users_table(spark, "users-partial")
    table.upsert(users, writer="bootstrap", batch_id=0, generation=0)
    renamed = users.filter(F.col("user_id") % 4 == 0).select(
        "user_id", F.concat(F.col("nick_name"), F.lit("-renamed")).alias("nick_name")
    )
    table.upsert(renamed, writer="users-feed-g1", batch_id=0, generation=1)
    # a replay of the same batch must not duplicate or change anything
    table.upsert(renamed, writer="users-feed-g1", batch_id=0, generation=1)
    return table.latest()


def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest name and label of every user that appears in the rating feed."""
    table = _users_table(spark, "users-lookup")
    table.upsert(fx.users(spark, sf_dir), writer="bootstrap", batch_id=0)
    keys = fx.rating_feed(spark, sf_dir).select("user_id")
    return table.lookup(keys, ["nick_name", "user_label"])


def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _users_table(spark, "users-create")
    first = table.create()
    table.upsert(fx.users(spark, sf_dir), writer="bootstrap", batch_id=0)
    second = table.create()
    n = table.latest(["nick_name"]).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(F.lit(first).alias("created_first"), F.lit(second).alias("created_second"), "n_rows")


def keyed_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup of the user of the latest event, and the answer for keys that are absent."""
    table = _users_table(spark, "users-get")
    table.upsert(fx.users(spark, sf_dir), writer="bootstrap", batch_id=0)
    last = fx.rating_feed(spark, sf_dir).agg(F.max_by("user_id", "event_id").alias("u")).first()["u"]
    point = table.get({"user_id": last}, ["nick_name", "age"]).withColumn("how", F.lit("get"))
    keys = fx.rating_feed(spark, sf_dir).select((F.col("user_id") * 100).alias("user_id"))
    looked = table.lookup(keys, ["nick_name", "age"], keep_absent=True).withColumn("how", F.lit("lookup"))
    return point.unionByName(looked)


def _placed(df: DataFrame, order: str, *cols: str) -> DataFrame:
    """Rows with a ``_seq`` that follows ``order``, as the lines of one file have."""
    seq = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("at", "file", "block")], F.col(order).alias("pos"))
    return df.select(*cols, seq.alias("_seq"))


def upsert_same_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many lines of one user in one batch: the last line wins as a whole, cells of two lines never mix."""
    table = _users_table(spark, "users-same-batch")
    table.upsert(fx.users(spark, sf_dir), writer="bootstrap", batch_id=0, generation=0, full=True)
    e = F.col("event_id")
    lines = fx.read(spark, sf_dir, "events").select(
        e, F.col("user_id"), F.concat(F.lit("n"), e).alias("nick_name"), (e % 2).cast("double").alias("gender"),
        F.when(e % 3 > 0, (100 - e % 83).cast("double")).alias("age"), F.concat(F.lit("s"), e % 7).alias("read_style"), F.concat(F.lit("l"), 9 - e % 9).alias("user_label"),
    )
    rows = _placed(lines, "event_id", "user_id", "nick_name", "gender", "age", "read_style", "user_label")
    table.upsert(rows, writer="users-feed-g1", batch_id=0, generation=1, full=True)
    return table.latest()


def history_same_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of one pair in one batch: the last wins, not the largest."""
    table = jobs.Store(spark, scratch_path(spark, "store")).history
    feed = fx.rating_feed(spark, sf_dir)
    table.upsert(_placed(feed, "event_id", "user_id", "product_id", "rating"), writer="ratings-g1", batch_id=0, generation=1)
    return table.latest()


def reload_after_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load after a fold: changed and added users are there, the rest is as before."""
    users = fx.users(spark, sf_dir)
    table = _users_table(spark, "users-reload")
    table.upsert(users.filter(F.col("user_id") % 7 != 0), writer="bootstrap", batch_id=1, generation=0, full=True)
    table.compact()
    again = users.filter((F.col("user_id") % 7 == 0) | (F.col("user_id") % 4 == 0))
    table.upsert(again.withColumn("nick_name", F.concat("nick_name", F.lit("-2"))), writer="bootstrap", batch_id=2, generation=0, full=True)
    return table.latest()


def keyed_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction keeps the latest state; writes after it still apply per cell."""
    users = fx.users(spark, sf_dir)
    table = _users_table(spark, "users-compact")
    table.upsert(users, writer="bootstrap", batch_id=0, generation=0)
    table.upsert(
        users.filter(F.col("user_id") % 4 == 0).select(
            "user_id", F.concat(F.col("nick_name"), F.lit("-renamed")).alias("nick_name")
        ),
        writer="users-feed-g1", batch_id=0, generation=1,
    )
    table.compact()
    table.upsert(
        users.filter(F.col("user_id") % 6 == 0).select(
            "user_id", F.concat(F.col("read_style"), F.lit("-c")).alias("read_style")
        ),
        writer="users-feed-g1", batch_id=1, generation=1,
    )
    return table.latest()


# --- recommendation table merge (K8) -----------------------------------------------------------


def recs_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row merge of the recommendation table across writers.

    ALS lists (model 1) for existing users; cold-start lists for *every*
    user, which must not displace an ALS list; a compaction; then ALS lists
    of model 2 for every tenth user.  Result: the list each user is served.
    """
    store = jobs.Store(spark, scratch_path(spark, "store"))
    store.create()
    given = staged(_given_recs(spark, sf_dir), "recs")
    store.write_recs(given, "als", 1, "bootstrap", 0, 0)
    assigned = staged(_user_clusters(spark, sf_dir), "assigned")
    copied = clusters.cold_start(assigned, staged(clusters.donors(assigned, given), "donors"), given)
    store.write_recs(copied.select("user_id", "recs"), "cold_start", None, "users-g1", 0, 1)
    store.recs.compact()  # whole-row merge across a compacted base and newer batches
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc(), F.col("product_id").asc())
    top = (
        fx.ratings(spark, sf_dir).filter(F.col("user_id") % 10 == 0)
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 10)
        .select("user_id", "rank", "product_id", F.col("rating").alias("score"))
    )
    store.write_recs(factors.collect_recs(top), "als", 2, "ratings-g1", 0, 1)
    latest = store.recs_latest()
    return latest.select(
        "user_id", "source", "model_version",
        F.array_join(F.transform("recs", lambda x: x["product_id"].cast("string")), ",").alias("products"),
        F.size("recs").alias("n_recs"),
    )


# --- bootstrap from text (S1-S3, K3, K4, quarantine) ---------------------------------------------


def bootstrap_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full bootstrap from comma text; the ratings file also carries the
    faulty feed's lines.  Result: quarantined lines per (kind, reason)."""
    ratings = staged(fx.ratings(spark, sf_dir), "ratings")
    root = scratch_path(spark, "bootstrap")
    paths = {k: f"{root}/input/{k}" for k in ("ratings", "users", "books")}
    faulty = fx.faulty_feed_lines(spark, sf_dir).select("value")
    text.write_lines(fx.rating_lines(ratings).unionByName(faulty), paths["ratings"])
    text.write_lines(fx.user_lines(fx.users(spark, sf_dir)), paths["users"])
    text.write_lines(fx.book_lines(fx.books(spark, sf_dir, ratings)), paths["books"])
    jobs.bootstrap(spark, f"{root}/store", paths["ratings"], paths["users"], paths["books"])
    rejected = jobs.Store(spark, f"{root}/store").rejected()
    return rejected.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))
