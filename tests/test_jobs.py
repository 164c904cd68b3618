"""Bootstrap from text, model versions, retrain."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import fixtures as fx
from shelfwise.operators import evaluate, factors, registry
from shelfwise.plans import jobs
from shelfwise.sources import text


def test_model_resave_gets_new_version(spark, tmp_dir):
    model = factors.fit_als(fx.ratings(spark, SF_SMALL), rank=2, max_iter=1)
    v1, p1 = registry.save(spark, model, tmp_dir, "als")
    v2, p2 = registry.save(spark, model, tmp_dir, "als")
    assert (v1, v2) == (1, 2) and p1 != p2
    version, loaded = registry.load(spark, tmp_dir, "als", factors.FactorModel.load)
    assert version == 2 and loaded.rank == 2


def test_bootstrap_from_text_with_quarantine(spark, tmp_dir):
    ratings = fx.ratings(spark, SF_SMALL)
    paths = {k: f"{tmp_dir}/{k}" for k in ("r", "u", "b")}
    bad = spark.createDataFrame([("not,a,rating",)], "value string")
    text.write_lines(fx.rating_lines(ratings).unionByName(bad), paths["r"])
    text.write_lines(fx.user_lines(fx.users(spark, SF_SMALL)), paths["u"])
    text.write_lines(fx.book_lines(fx.books(spark, SF_SMALL, ratings)), paths["b"])
    summary = jobs.bootstrap(spark, f"{tmp_dir}/store", paths["r"], paths["u"], paths["b"],
                             als_params={"rank": 3, "max_iter": 2}, n_clusters=5, kmeans_iter=3).first()
    store = jobs.Store(spark, f"{tmp_dir}/store")
    assert (summary["als_version"], summary["kmeans_version"]) == (1, 1)
    assert store.history.latest().count() == ratings.count()
    assert store.rejected().filter(F.col("kind") == "ratings").count() == 1
    n_users = ratings.select("user_id").distinct().count()
    assert store.recs_latest().filter(F.col("source") == "als").count() == n_users


def test_retrain_adds_versions(spark, tmp_dir):
    store = jobs.Store(spark, f"{tmp_dir}/store")
    ratings = fx.ratings(spark, SF_SMALL)
    jobs.bootstrap_frames(store, ratings, fx.users(spark, SF_SMALL), fx.books(spark, SF_SMALL, ratings),
                          als_params={"rank": 3, "max_iter": 2}, n_clusters=5, kmeans_iter=3)
    row = jobs.retrain(store, evaluate.grid([2, 3], [2], [0.1]), n_clusters=5, kmeans_iter=3).first()
    assert (row["als_version"], row["kmeans_version"], row["n_trials"]) == (2, 2, 2)
    assert row["is_default"] or row["rmse"] < 1.0


def test_retrain_fills_gaps(spark, tmp_dir):
    store = jobs.Store(spark, f"{tmp_dir}/store")
    ratings, users = fx.ratings(spark, SF_SMALL), fx.users(spark, SF_SMALL)
    old = ~fx.is_new_user(F.col("user_id"))
    jobs.bootstrap_frames(store, ratings.filter(old), users.filter(old), fx.books(spark, SF_SMALL, ratings),
                          als_params={"rank": 3, "max_iter": 2}, n_clusters=5, kmeans_iter=3)
    store.history.upsert(ratings.filter(~old), "ratings-g1", 0, 1)
    # a user who never rated and signs up between retrains
    idle = users.filter(F.col("user_id") == 7).withColumn("user_id", F.lit(7_000_000_000))
    store.users.upsert(idle, "users-g1", 0, 1, full=True)
    jobs.retrain(store, evaluate.grid([2], [2], [0.1]), n_clusters=5, kmeans_iter=3)
    got = {r["user_id"]: r["source"] for r in store.recs_latest().collect()}
    rated = {r["user_id"] for r in ratings.select("user_id").distinct().collect()}
    assert {u for u, s in got.items() if s == "als"} == rated
    cluster_has_donor = got.get(7_000_000_000)
    assert cluster_has_donor in (None, "cold_start")


def test_rating_batches_pick_up_a_retrain(spark, tmp_dir):
    from conftest import lines_df
    from shelfwise.streaming.handlers import OnRatings

    store = jobs.Store(spark, f"{tmp_dir}/store")
    ratings = fx.ratings(spark, SF_SMALL)
    jobs.bootstrap_frames(store, ratings, fx.users(spark, SF_SMALL), fx.books(spark, SF_SMALL, ratings),
                          als_params={"rank": 3, "max_iter": 2}, n_clusters=5, kmeans_iter=3)
    handler = OnRatings(store, "ratings-g1", 1)  # one instance, as a running stream holds it
    handler(lines_df(spark, ["1,1,4"]), 0)
    jobs.retrain(store, evaluate.grid([2], [2], [0.1]), n_clusters=5, kmeans_iter=3)
    handler(lines_df(spark, ["1,2,5"]), 1)
    written = {r["batch_id"]: r["model_version"] for r in
               store.recs.log().filter(F.col("writer") == "ratings-g1").select("batch_id", "model_version").collect()}
    assert written == {0: 1, 1: 2}
    latest = store.recs_latest().filter(F.col("user_id") == 1).first()
    assert (latest["source"], latest["model_version"]) == ("als", 2)


def test_bootstrap_fits_on_ratings_merged_once(spark, tmp_dir, monkeypatch):
    fitted, fit = [], factors.fit_als
    monkeypatch.setattr(factors, "fit_als", lambda rated, **kw: fitted.append(rated) or fit(rated, **kw))
    store = jobs.Store(spark, f"{tmp_dir}/store")
    ratings = spark.createDataFrame([(u, p, float(1 + (u * p) % 5)) for u in range(1, 10) for p in range(1, 6)], "user_id bigint, product_id bigint, rating double")
    users = spark.createDataFrame([(u, "n", float(u % 2), 20.0 + u, "s", "l") for u in range(1, 13)], "user_id bigint, nick_name string, gender double, age double, read_style string, user_label string")
    books = spark.createDataFrame([], "book_id bigint, book_name string, author string, average double, book_style string, book_label string")
    jobs.bootstrap_frames(store, ratings.unionByName(ratings), users, books, als_params={"rank": 2, "max_iter": 2}, n_clusters=3, kmeans_iter=3)
    assert "Aggregate" not in fitted[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, fitted[0].collect())) == sorted(map(tuple, ratings.collect()))


def test_stores_are_filled_from_ratings_made_once(spark, monkeypatch):
    """The ratings that a store is filled with come from a table, not from the join and the merge of order lines."""
    from shelfwise.plans import catalog, models, streams

    class Seen(Exception):
        pass

    def look(rated, *rest, **kw):
        raise Seen(rated._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(jobs, "bootstrap_frames", lambda store, ratings, *rest, **kw: look(ratings))
    monkeypatch.setattr(fx, "rating_lines", look)
    for query in (streams.cold_start_current, streams._refresh_store, streams._users_store, models.retrain_switch, catalog.bootstrap_quarantine):
        try:
            query(spark, SF_SMALL + "/")  # no other test's store
        except Seen as plan:
            assert "Join" not in str(plan) and "Aggregate" not in str(plan), query.__name__
        else:
            raise AssertionError(query.__name__)


def test_backfill_sends_no_items_when_every_user_has_a_list(spark, tmp_dir, monkeypatch):
    store = jobs.Store(spark, f"{tmp_dir}/store")
    ratings = spark.createDataFrame([(u, p, float(1 + (u * p) % 5)) for u in range(1, 10) for p in range(1, 6)], "user_id bigint, product_id bigint, rating double")
    users = spark.createDataFrame([(u, "n", float(u % 2), 20.0 + u, "s", "l") for u in range(1, 13)], "user_id bigint, nick_name string, gender double, age double, read_style string, user_label string")
    books = spark.createDataFrame([], "book_id bigint, book_name string, author string, average double, book_style string, book_label string")
    jobs.bootstrap_frames(store, ratings, users, books, als_params={"rank": 2, "max_iter": 2}, n_clusters=3, kmeans_iter=3)
    sent, send = [], factors._send
    monkeypatch.setattr(factors, "_send", lambda items: sent.append(1) or send(items))
    reader = jobs.Store(spark, store.root)
    before = sorted((r["user_id"], str(r["recs"])) for r in reader.recs_latest().filter("source = 'als'").collect())
    jobs.backfill(reader, 1, 1)
    assert not sent
    assert before == sorted((r["user_id"], str(r["recs"])) for r in reader.recs_latest().filter("source = 'als'").collect())
