"""Print the physical plans of the main jobs (operator tree + scan details).

    python tools/show_plans.py [sf_dir] > docs/PLANS.md

For each job: the formatted plan's operator tree, then the ``ReadSchema`` and
``PushedFilters`` of every scan - what to look at for pruning and pushdown.
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from shelfwise import fixtures as fx  # noqa: E402
from shelfwise.operators import clusters, evaluate, factors  # noqa: E402
from shelfwise.plans import catalog, jobs  # noqa: E402
from shelfwise.session import local_session, scratch_path  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> str:
    lines = text.splitlines()
    tree, details, in_tree = [], [], True
    for line in lines:
        if in_tree:
            if line.startswith("(") and tree:
                in_tree = False
            elif line.strip():
                tree.append(line)
                continue
        if line.startswith(("ReadSchema", "PushedFilters", "Location", "PartitionFilters")) or (
            line.startswith("(") and "Scan" in line
        ):
            details.append(line)
    return "\n".join(tree + [""] + details)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    store = jobs.Store(spark, scratch_path(spark, "plans"))
    ratings = fx.ratings(spark, sf)
    old = ~fx.is_new_user(F.col("user_id"))
    jobs.bootstrap_frames(store, ratings.filter(old), fx.users(spark, sf).filter(old), fx.books(spark, sf, ratings),
                          als_params={"max_iter": 2}, n_clusters=10, kmeans_iter=3)
    batch_users = fx.users(spark, sf).filter(~old)
    version, km = store.current_kmeans()
    from shelfwise.operators import features

    vecs = features.assemble(features.user_features(batch_users), features.feature_names())
    jobs_to_show = {
        "ratings derivation (join + latest per pair)": fx.ratings(spark, sf),
        "keyed latest, per cell (users)": store.users.latest(["nick_name", "age"]),
        "keyed lookup (recs of feed users)": store.recs.lookup(fx.rating_feed(spark, sf).select("user_id"), ["recs"]),
        "exact top-k over factor tables (one item block)": factors.topk_from_factors(
            fx.user_factors(spark, sf), fx.item_factors(spark, sf), 10),
        "recommendations of a micro-batch": factors.recommend(store.current_als()[1], 10, fx.rating_feed(spark, sf).select("user_id")),
        "predict given pairs": catalog.predict_pairs(spark, sf),
        "RMSE with m x n join semantics (pre-aggregated)": catalog.rmse_duplicate_pairs(spark, sf),
        "nearest given centre (broadcast centres)": catalog.assign_to_centers(spark, sf),
        "cold start of a user batch (donor snapshot)": clusters.copy_from_donors(
            clusters.assign(km, vecs).select("user_id", "cluster"), store.donors(version)),
        "known flag (single left join)": catalog.known_split(spark, sf),
        "hash split": evaluate.split(store.history.latest())[0],
    }
    print("# Physical plans of the main jobs\n")
    print(f"Generated by `tools/show_plans.py` at `{sf}` on local[8]. Operator trees from "
          "`explain('formatted')`, then each scan's pushed filters and read schema.\n")
    for title, df in jobs_to_show.items():
        print(f"## {title}\n\n```\n{summarise(plan_text(df))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
