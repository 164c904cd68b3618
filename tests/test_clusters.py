"""Clustering and cold start edge cases."""


from shelfwise.operators import clusters, features


def test_assign_to_centers_tie_goes_to_lowest_id(spark):
    pts = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id int, features array<double>")
    ctr = spark.createDataFrame([(5, [1.0]), (4, [-1.0]), (6, [3.0])], "center_id int, features array<double>")
    got = sorted(tuple(r) for r in clusters.assign_to_centers(pts, ctr).collect())
    assert got == [(1, 4, 1.0), (2, 6, 0.0)]


def test_k_larger_than_users(spark):
    users = spark.createDataFrame([(1, 0.0, 20.0), (2, 1.0, 30.0), (3, 0.0, 60.0)], "user_id int, gender double, age double")
    vecs = features.assemble(features.user_features(users), features.feature_names())
    model = clusters.fit_kmeans(vecs, k=100, max_iter=5)
    assert len(model.clusterCenters()) == 3
    assigned = clusters.assign(model, vecs)
    assert assigned.select("cluster").distinct().count() == 3


def test_assemble_skips_invalid(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, float("nan"), 1.0)], "user_id int, a double, b double")
    assert features.assemble(df, ["a", "b"]).count() == 1
    assert features.invalid_features(df, ["a", "b"]).count() == 2


def _recs(spark, rows):
    return spark.createDataFrame(rows, "user_id int, recs array<struct<product_id:int,score:double>>")


def test_cold_start_copies_donor_ids_only(spark):
    new = spark.createDataFrame([(10, 0), (11, 1), (12, 0)], "user_id int, cluster int")
    donors = spark.createDataFrame([(0, 1)], "cluster int, donor_id int")
    recs = _recs(spark, [(1, [(5, 4.5), (6, 4.0)]), (12, [(9, 3.0)])])
    served = spark.createDataFrame([(12,)], "user_id int")
    out = clusters.cold_start(new, donors, recs, served)
    rows = {r["user_id"]: r for r in out.collect()}
    # 11: cluster without donor -> no row; 12: already has an ALS list -> unchanged
    assert set(rows) == {10}
    assert rows[10]["donor_id"] == 1
    assert [(x["product_id"], x["score"]) for x in rows[10]["recs"]] == [(5, None), (6, None)]


def test_donors_are_min_eligible_user(spark):
    assigned = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 2)], "user_id int, cluster int")
    eligible = spark.createDataFrame([(2,), (3,)], "user_id int")
    got = sorted(tuple(r) for r in clusters.donors(assigned, eligible).collect())
    assert got == [(0, 2), (1, 3)]


def test_same_cluster_set_form(spark):
    assigned = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "user_id int, cluster int")
    wanted = spark.createDataFrame([(0,)], "cluster int")
    assert sorted(r["user_id"] for r in clusters.same_cluster(assigned, wanted).collect()) == [1, 2]


def test_donors_from_rating_rows(spark, tmp_dir):
    from shelfwise.plans import jobs

    centers = spark.createDataFrame([(0, [0.0, 0.0, 30.0]), (1, [9.0, 1.0, 50.0])], "center_id int, features array<double>")
    rated = spark.createDataFrame([(8, 2, 5.0), (7, 1, 4.0), (1, 1, 3.0), (2, 40, 1.0)], "user_id bigint, product_id bigint, rating double")
    want = set()
    for u, p, r in ((8, 2, 5.0), (7, 1, 4.0), (1, 1, 3.0), (2, 40, 1.0)):
        far = [(u - a) ** 2 + (p - b) ** 2 + (r - c) ** 2 for a, b, c in ((0, 0, 30), (9, 1, 50))]
        want.add((u, far.index(min(far))))
    pool = clusters.rating_pool(centers, rated)
    assert {tuple(x) for x in pool.collect()} == want
    # as a parameter of a store's clustering: every donor is a user who has rated and has an ALS list
    store = jobs.Store(spark, f"{tmp_dir}/store")
    users = spark.createDataFrame([(u, f"n{u}", float(u % 2), 20.0 + u, "s", "l") for u in range(1, 13)], "user_id bigint, nick_name string, gender double, age double, read_style string, user_label string")
    books = spark.createDataFrame([], "book_id bigint, book_name string, author string, average double, book_style string, book_label string")
    ratings = spark.createDataFrame([(u, p, float(1 + (u * p) % 5)) for u in range(1, 10) for p in range(1, 6)], "user_id bigint, product_id bigint, rating double")
    jobs.bootstrap_frames(store, ratings, users, books, als_params={"rank": 2, "max_iter": 2}, n_clusters=3, kmeans_iter=3)
    version = jobs.refresh_clusters(store, 3, 3, donor_pool="ratings")
    found = store.donors(version).collect()
    assert found and all(1 <= r["donor_id"] <= 9 and r["recs"] for r in found)


def test_nearest_is_bounded_and_exact():
    """All points against all centres at once would take 400 MB a matrix; ties and equal centres go to the first."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(5)
    points, centers = rng.integers(0, 40, (10_000, 3)).astype(float), rng.integers(0, 40, (5_000, 3)).astype(float)
    tracemalloc.start()
    ids, kept = clusters.distinct_centers(np.arange(5_000) * 3, centers)
    best, dist = clusters.nearest(points, kept)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    for at in range(0, 10_000, 1_000):
        want = sum((points[at : at + 1_000, j, None] - centers[None, :, j]) ** 2 for j in range(3))
        assert (ids[best[at : at + 1_000]] == 3 * want.argmin(axis=1)).all() and (dist[at : at + 1_000] == want.min(axis=1)).all()


def test_recs_merge_makes_its_inputs_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from shelfwise.plans import catalog

    names, staged = [], catalog.staged
    monkeypatch.setattr(catalog, "staged", lambda df, name: names.append(name) or staged(df, name))
    assert catalog.recs_merge(spark, SF_SMALL).count() > 0
    assert names == ["recs", "assigned", "donors"]


def test_nearest_of_many_centers_meets_few_of_them():
    """Centres along a line, as (user, gender, age) are, and points far off it: what a point meets does not grow with the centres."""
    import numpy as np

    rng = np.random.default_rng(6)
    user = np.repeat(np.arange(20_000) * 150.0, 2)  # every centre twice: the first wins
    centers = np.stack([user, user // 150 % 2, 18 + user * 7 % 60], axis=1)
    points = np.stack([rng.integers(0, 3_000_000, 20_000), rng.integers(0, 4_000_000, 20_000), rng.integers(1, 6, 20_000)], axis=1).astype(float)
    made = []
    clusters.Centers(centers).candidates(points, made)
    assert 0 < sum(made) < len(points) * len(centers) / 100
    best, dist = clusters.nearest(points, centers)
    for at in range(0, 600, 200):
        want = sum((points[at : at + 200, j, None] - centers[None, :, j]) ** 2 for j in range(3))
        assert (best[at : at + 200] == want.argmin(axis=1)).all() and (dist[at : at + 200] == want.min(axis=1)).all()
    # points that are no numbers or too large to square fall back on all centres
    odd = np.array([[np.nan, 1.0, 1.0], [1e200, 0.0, 0.0], points[0]])
    with np.errstate(over="ignore"):
        assert clusters.nearest(odd, centers)[0].tolist() == [0, 0, best[0]]


def test_donors_from_ratings_makes_its_ratings_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from shelfwise.plans import catalog

    names, staged = [], catalog.staged
    monkeypatch.setattr(catalog, "staged", lambda df, name: names.append(name) or staged(df, name))
    assert catalog.donors_from_ratings(spark, SF_SMALL).count() > 0
    assert names == ["ratings"]
