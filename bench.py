"""Headline timings at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_EVENT_LOG_DIR=/tmp/run-xyz/events ...   # also write Spark's event log

Steps follow the jobs a deployment runs: bootstrap (ratings of all users into
the store, ALS fit, top-10 for every user, k-means, donors), validation RMSE,
the block top-k over factor tables, one rating micro-batch (refresh) and one
user micro-batch (cold start).  Each step is forced with a write (to the store or
the ``noop`` sink), never a collect of its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise import fixtures as fx  # noqa: E402
from shelfwise.operators import clusters, evaluate, factors, features  # noqa: E402
from shelfwise.plans import jobs  # noqa: E402
from shelfwise.schemas import RATINGS  # noqa: E402
from shelfwise.session import local_session, scratch_path  # noqa: E402
from shelfwise.sources import text  # noqa: E402
from shelfwise.streaming.handlers import OnRatings, OnUsers  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # opt-in: stage and task times
    if event_dir:
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir}
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="shelfwise-bench", extra=extra)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm the JVM and the parquet footers (not timed)
    noop(fx.read(spark, sf_dir, "customer"))

    store = jobs.Store(spark, scratch_path(spark, "bench-store"))
    store.create()
    ratings = fx.ratings(spark, sf_dir)

    def load_tables():
        store.history.upsert(ratings, "bootstrap", 0, 0)
        store.users.upsert(fx.users(spark, sf_dir), "bootstrap", 0, 0, full=True)
        # book averages from the stored history, not a second derivation
        store.books.upsert(fx.books(spark, sf_dir, store.history.latest()), "bootstrap", 0, 0, full=True)

    timed("load_tables", load_tables)
    # the steps below read snapshots: none of them derives its input again
    snapshot = store.snapshot_path("ratings")
    timed("history_snapshot", lambda: store.history.latest().write.parquet(snapshot))
    rated = spark.read.schema(RATINGS).parquet(snapshot)
    params = {"rank": 10, "max_iter": 20, "reg_param": 0.1}
    als_version, model = timed("als_fit", lambda: jobs.refit_als(store, rated, params, 42))
    timed("recommend_all", lambda: store.write_recs(factors.recommend(model, 10), "als", als_version, "bootstrap", 0))
    users = store.snapshot_path("features")
    features.user_features(store.users.latest(["gender", "age"])).write.parquet(users)
    vecs = features.assemble(spark.read.parquet(users), features.feature_names())
    timed("kmeans_fit", lambda: clusters.fit_kmeans(vecs, 100, 20))
    timed("clusters_and_donors", lambda: jobs.refresh_clusters(store, 100, 20))
    _, valid = evaluate.split(rated)
    timed("rmse_validation", lambda: evaluate.model_rmse(model, valid, unique_pairs=True))
    timed("topk_factors", lambda: noop(factors.topk_from_factors(fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), 10)))

    feed_dir = scratch_path(spark, "bench-feed")
    text.write_lines(fx.rating_lines(fx.rating_feed(spark, sf_dir)), f"{feed_dir}/ratings")
    # sign-ups: every fifth user again, under an id that nobody has
    signups = fx.users(spark, sf_dir).filter(fx.is_new_user(F.col("user_id"))).withColumn("user_id", fx.wide(F.col("user_id")))
    text.write_lines(fx.user_lines(signups), f"{feed_dir}/users")
    lines = lambda kind: text.with_file(spark.read.text(f"{feed_dir}/{kind}"))
    timed("stream_refresh_batch", lambda: OnRatings(store, "ratings-g1", 1)(lines("ratings"), 0))
    timed("cold_start_batch", lambda: OnUsers(store, "users-g1", 1)(lines("users"), 0))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
