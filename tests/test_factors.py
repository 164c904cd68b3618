"""Factor-table operators against brute force; ALS fit invariants."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import fixtures as fx
from shelfwise.operators import factors
from shelfwise.session import scratch_path


def _brute_topk(users, items, k):
    out = []
    for uid, uf in users:
        scored = [(round(sum(a * b for a, b in zip(uf, itf)), 6), iid) for iid, itf in items]
        scored.sort(key=lambda s: (-s[0], s[1]))
        out += [(uid, r + 1, iid, s) for r, (s, iid) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_matches_brute_force(spark):
    uf = fx.user_factors(spark, SF_SMALL)
    itf = fx.item_factors(spark, SF_SMALL)
    users = [(r["id"], r["features"]) for r in uf.collect()]
    items = [(r["id"], r["features"]) for r in itf.collect()]
    got = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, 10).collect())
    assert got == _brute_topk(users, items, 10)


def test_topk_many_blocks_equals_one_block(spark):
    uf = fx.user_factors(spark, SF_SMALL)
    itf = fx.item_factors(spark, SF_SMALL)
    one = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, 5).collect())
    many = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, 5, block_bytes=4096).collect())
    assert one == many
    blocked = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, 5, block_bytes=64 * 1024).collect())
    assert one == blocked


def test_topk_ties_break_on_item_id(spark):
    uf = spark.createDataFrame([(1, [1.0, 0.0])], "id int, features array<double>")
    itf = spark.createDataFrame([(9, [2.0, 5.0]), (3, [2.0, 1.0]), (5, [2.0, 0.0]), (4, [1.0, 0.0])],
                                "id int, features array<double>")
    got = [tuple(r) for r in factors.topk_from_factors(uf, itf, 2).orderBy("rank").collect()]
    assert got == [(1, 1, 3, 2.0), (1, 2, 5, 2.0)]


def test_heavy_ties_leave_k_candidates_a_block(spark):
    """Zero users tie on every item; no more than k rows per user leave a block."""
    iid, itf = np.arange(3000), np.random.default_rng(0).normal(size=(3000, 8))
    out = list(factors._best(np.array([5, 6]), np.zeros((2, 8)), iid, itf, 10, 6))
    assert sum(len(o) for o in out) == 20
    assert out[0]["iid"].tolist() == list(range(10)) * 2


def test_dictionary_numbers_densely(spark):
    ids = spark.createDataFrame([(i * 7_000_000_000,) for i in range(500)] + [(0,)], "user_id bigint")
    rows = factors.dictionary(ids, "user_id").collect()
    assert sorted(r["idx"] for r in rows) == list(range(500))
    assert len({r["id"] for r in rows}) == 500


def test_sweep_leaves_nothing_persisted(spark):
    from shelfwise.operators import evaluate

    train, valid = evaluate.split(fx.ratings(spark, SF_SMALL))
    before = factors.persistent(spark)
    evaluate.sweep(train, valid, evaluate.grid([2], [1, 2], [0.1]), parallelism=2)
    assert factors.persistent(spark) <= before


def test_fewer_items_than_k(spark):
    uf = spark.createDataFrame([(1, [1.0])], "id int, features array<double>")
    itf = spark.createDataFrame([(2, [1.0]), (3, [2.0])], "id int, features array<double>")
    assert factors.topk_from_factors(uf, itf, 10).count() == 2


def test_predict_pairs_drops_unknown_ids(spark):
    uf = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<double>")
    itf = spark.createDataFrame([(7, [3.0, 4.0])], "id int, features array<double>")
    pairs = spark.createDataFrame([(1, 7), (1, 8), (2, 7)], "user_id int, product_id int")
    got = [tuple(r) for r in factors.predict_pairs(pairs, uf, itf).collect()]
    assert got == [(7, 1, 11.0)]


def test_split_known(spark):
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "user_id int, product_id int")
    known = spark.createDataFrame([(1,), (3,)], "user_id int")
    hit, miss = factors.split_known(rows, known)
    assert sorted(r["user_id"] for r in hit.collect()) == [1, 3]
    assert [r["user_id"] for r in miss.collect()] == [2]


def test_als_recommendations_invariants(spark):
    ratings = fx.ratings(spark, SF_SMALL)
    model = factors.fit_als(ratings, rank=5, max_iter=5, seed=7)
    n_items = ratings.select("product_id").distinct().count()
    recs = factors.recommend(model, 10)
    sizes = {r[0] for r in recs.select(F.size("recs")).distinct().collect()}
    assert sizes == {min(10, n_items)}
    assert recs.count() == ratings.select("user_id").distinct().count()
    for r in recs.collect():
        scores = [x["score"] for x in r["recs"]]
        assert scores == sorted(scores, reverse=True)
        assert len({x["product_id"] for x in r["recs"]}) == len(scores)


def test_recommend_subset_skips_unseen_user(spark):
    ratings = fx.ratings(spark, SF_SMALL)
    model = factors.fit_als(ratings, rank=3, max_iter=2, seed=7)
    users = spark.createDataFrame([(99_999_999,)], "user_id int")
    assert factors.recommend(model, 10, users).count() == 0


def test_same_seed_same_factors(spark):
    ratings = fx.ratings(spark, SF_SMALL).cache()
    a = factors.fit_als(ratings, rank=3, max_iter=3, seed=11, num_blocks=2)
    b = factors.fit_als(ratings, rank=3, max_iter=3, seed=11, num_blocks=2)
    fa = {r["id"]: np.array(r["features"]) for r in a.users.collect()}
    fb = {r["id"]: np.array(r["features"]) for r in b.users.collect()}
    assert max(float(np.abs(fa[i] - fb[i]).max()) for i in fa) == 0.0


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_vec = st.lists(st.integers(-2, 2).map(float), min_size=3, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_vec, min_size=1, max_size=6), st.lists(_vec, min_size=1, max_size=12), st.integers(1, 5))
def test_topk_exact_with_ties_on_both_paths(spark, users, items, k):
    schema = "id int, features array<double>"
    uf = spark.createDataFrame(list(enumerate(users)), schema)
    itf = spark.createDataFrame([(100 + i, v) for i, v in enumerate(items)], schema)
    want = _brute_topk(list(enumerate(users)), [(100 + i, v) for i, v in enumerate(items)], k)
    broadcast = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, k).collect())
    blocked = sorted(tuple(r) for r in factors.topk_from_factors(uf, itf, k, block_bytes=80).collect())
    assert broadcast == want
    assert blocked == want


def test_a_batch_reads_few_of_the_factor_rows(spark, tmp_dir):
    """300 users of 100,000: less than a tenth of the saved factor rows is read, and all 300 come back."""
    from shelfwise.sources import placed

    users = spark.range(100_000).select((F.col("id") * 7).alias("id"), F.array(*[F.rand(i) for i in range(10)]).alias("features"))
    items = spark.createDataFrame([(1, [0.5] * 10)], "id bigint, features array<double>")
    factors.FactorModel(users, items, 10).save_to(f"{tmp_dir}/m")
    model = factors.FactorModel.load(f"{tmp_dir}/m")
    asked = spark.range(300).select((F.pmod(F.xxhash64("id"), F.lit(100_000)) * 7).alias("user_id")).distinct()
    n = asked.count()
    found = model.of_users(asked)
    assert len(found.collect()) == n
    assert placed.scanned(found)["numOutputRows"] < 10_000
    unknown = model.of_users(spark.createDataFrame([(3,), (None,)], "user_id bigint"))
    assert unknown.collect() == []


def test_narrow_ids_are_not_numbered_again(spark):
    rated = spark.createDataFrame([(u, 100 + i, float(1 + (u * i) % 5)) for u in range(1, 9) for i in range(1, 7)], "user_id bigint, product_id bigint, rating double")
    assert factors.numbered(rated).ids == {}
    wide = rated.withColumn("user_id", F.col("user_id") - 2**40)
    given = factors.numbered(wide)
    assert set(given.ids) == {"u"} and given.ratings.count() == rated.count()
    model = factors.fit_als(given, rank=2, max_iter=2)
    assert {r["id"] for r in model.users.collect()} == {u - 2**40 for u in range(1, 9)}
    assert {r["id"] for r in model.items.collect()} == set(range(101, 107))


def test_pruned_topk_is_exact_and_skips_products(spark):
    rng = np.random.default_rng(3)
    items = rng.normal(size=(6000, 8)) * (1.0 / np.arange(1, 6001))[:, None] ** 0.5
    items[50:70] = items[50]  # ties
    users = rng.normal(size=(300, 8))
    users[0] = 0.0
    order = np.argsort(-np.linalg.norm(items, axis=1), kind="stable")
    made: list = []
    for margin in (0.0, 1e-6):
        rows, cols = factors.pruned_near(users, items[order], 10, margin, made)
        want = factors._all_near(users, items[order], 10, margin)
        assert set(zip(rows.tolist(), cols.tolist())) == set(zip(*(x.tolist() for x in want)))
    # far fewer than all products
    assert sum(made) < 2 * users.shape[0] * len(items) * 0.5
    uf = spark.createDataFrame([(i, [float(x) for x in u]) for i, u in enumerate(users[:40])], "id bigint, features array<double>")
    itf = spark.createDataFrame([(1000 + i, [float(x) for x in v]) for i, v in enumerate(items[:1500])], "id bigint, features array<double>")
    plain = factors.topk_from_factors(uf, itf, 7)
    for bytes_ in (factors.BLOCK_BYTES, 32_000):
        assert sorted(factors.topk_from_factors(uf, itf, 7, block_bytes=bytes_, prune=True).collect()) == sorted(plain.collect())
    one = factors.topk_from_factors(uf, itf.limit(3), 7, prune=True)
    assert one.count() == 120


def test_leaves_rule_out_products_and_change_no_list():
    """Items near one another are left out together; the k best are those of all products, blocks taken one by one or not."""
    import pandas as pd

    rng = np.random.default_rng(3)
    items, users = rng.normal(size=(9000, 4)), rng.normal(size=(200, 4))
    items[50:90], users[::9] = items[7], 0.0
    iid, uid = rng.permutation(9000), np.arange(200)
    for digits in (None, 6, 1):
        def ranked(frames):
            out = pd.concat(frames)
            out["score"] = out["score"] if digits is None else out["score"].round(digits)
            return out.sort_values(["uid", "score", "iid"], ascending=[True, False, True]).groupby("uid").head(10).reset_index(drop=True)

        want = ranked(factors._best(uid, users, iid, items, 10, digits, factors._all_near))
        assert ranked(factors._best(uid, users, iid, items, 10, digits)).equals(want)
        blocks = [factors.with_leaves(iid[b::20], items[b::20]) for b in range(20)]
        assert ranked(factors._best_of(uid, users, blocks, 10, digits)).equals(want)
    made, users = [], users[users.any(axis=1)]
    _, dealt, leaves = factors.with_leaves(iid, items)
    list(factors.leaf_near(users, dealt, leaves, 10, 0.0, np.full(len(users), -np.inf), made))
    assert sum(made) < len(users) * 9000 / 2


def test_small_blocks_share_a_broadcast(spark, monkeypatch):
    """Blocks far smaller than a broadcast are sent together, not in a job each."""
    sent, send = [], factors._send
    monkeypatch.setattr(factors, "_send", lambda items: sent.append(1) or send(items))
    uf, itf = fx.user_factors(spark, SF_SMALL), fx.item_factors(spark, SF_SMALL)
    one = sorted(factors.topk_from_factors(uf, itf, 5).collect())
    assert sorted(factors.topk_from_factors(uf, itf, 5, block_bytes=4096).collect()) == one
    assert len(sent) == 2


def test_single_precision_only_chooses():
    """Scores that single precision cannot tell apart, vectors of any size and flags at any place: the k best are those of all products."""
    import pandas as pd

    rng = np.random.default_rng(8)
    flags = np.zeros(77 + 8, bool)
    flags[[0, 7, 8, 40, 63, 64, 76, 77, 80]] = True
    assert factors._places(flags, 77).tolist() == [0, 7, 8, 40, 63, 64, 76]
    base, users = rng.normal(size=4), rng.normal(size=(60, 4))
    near = base + rng.normal(size=(3000, 4)) * 1e-9
    for size_u, size_i in ((1.0, 1.0), (1e-60, 1e-70), (1e60, 1e40), (1e-160, 1.0)):
        items, rows = near * size_i, users * size_u
        frames = [pd.concat(factors._best_of(np.arange(60), rows, [block], 10, None, how)) for block, how in ((factors.with_leaves(np.arange(3000), items), None), ((np.arange(3000), items, None), factors._all_near))]
        got, want = (f.sort_values(["uid", "score", "iid"], ascending=[True, False, True]).reset_index(drop=True) for f in frames)
        assert got.groupby("uid").head(10).reset_index(drop=True).equals(want.groupby("uid").head(10).reset_index(drop=True))
    leaves = factors.with_leaves(np.arange(3000), rng.normal(size=(3000, 4)))[2]
    assert leaves[3].dtype == np.float32 and np.linalg.norm(leaves[3], axis=1).max() <= 1.0 + 1e-6


def test_lists_of_a_saved_model_are_made_where_users_lie(spark):
    """A saved fit whose items fit one broadcast: no shuffle, and the lists that ranking all candidates gives, leaf by leaf or from all products."""
    rng = np.random.default_rng(12)
    users = [(int(i), rng.normal(size=4).tolist()) for i in rng.permutation(700)] + [(900, [0.0] * 4)]
    items = [(int(i), rng.normal(size=4).tolist()) for i in rng.permutation(3000)] + [(i, [1.0, 0.5, 0.0, 2.0]) for i in range(5000, 5030)]
    path = scratch_path(spark, "model")
    factors.FactorModel(spark.createDataFrame(users, factors.FACTORS), spark.createDataFrame(items, factors.FACTORS), 4).save_to(path)
    model = factors.FactorModel.load(path)
    recs = factors.recommend(model, 7)
    assert "Exchange" not in recs._jdf.queryExecution().toString()
    got = {r["user_id"]: [tuple(x) for x in r["recs"]] for r in recs.collect()}
    ranked = factors.topk_from_factors(model.users, model.items, 7, round_digits=None, block_bytes=4096).orderBy("user_id", "rank").collect()
    want: dict = {}
    for r in ranked:
        want.setdefault(r["user_id"], []).append((r["product_id"], r["score"]))
    assert len(got) == 701 and got == want
    asked = spark.createDataFrame([(3,), (900,), (12345,)], "user_id bigint")
    assert {r["user_id"]: [tuple(x) for x in r["recs"]] for r in factors.recommend(model, 7, asked).collect()} == {u: want[u] for u in (3, 900)}


def test_leaf_products_are_made_in_tiles(monkeypatch):
    """Rows and leaves far larger than a tile: no product matrix is larger than TILE, and the pairs found are those of one matrix."""
    rng = np.random.default_rng(13)
    items, users = rng.normal(size=(2000, 4)), rng.normal(size=(500, 4))
    uid, iid = np.arange(500), np.arange(2000)
    whole, sizes, matmul = list(factors._best(uid, users, iid, items, 10, None)), [], np.matmul
    monkeypatch.setattr(factors, "TILE", 3000)
    monkeypatch.setattr(np, "matmul", lambda a, b, out: sizes.append(out.size) or matmul(a, b, out=out))
    tiled = list(factors._best(uid, users, iid, items, 10, None))
    assert sizes and max(sizes) <= 3000
    assert all(a.equals(b) for a, b in zip(whole, tiled, strict=True))


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    """A block's ratings are what a task holds: more ratings make more blocks, not larger ones, unless the caller names their number."""
    asked, als = [], factors.als
    monkeypatch.setattr(factors, "als", lambda *a, **kw: asked.append(a[4]) or als(*a, **kw))
    monkeypatch.setattr(factors, "BLOCK_RATINGS", 20)
    ratings = spark.createDataFrame([(u, p, float(1 + (u * p) % 5)) for u in range(30) for p in range(8)], "user_id bigint, product_id bigint, rating double")
    few = ratings.filter("user_id < 5")
    factors.fit_als(ratings, rank=2, max_iter=1)
    factors.fit_als(factors.numbered(ratings), rank=2, max_iter=1)
    factors.fit_als(few, rank=2, max_iter=1)
    factors.fit_als(ratings, rank=2, max_iter=1, num_blocks=3)
    assert asked == [12, 12, factors.NUM_BLOCKS, 3]


def test_factors_of_a_fit_are_sent_in_single_precision():
    """What single precision holds exactly is sent once, at less than half the bytes, and chooses and scores the same as in double."""
    import pickle

    import pandas as pd

    rng = np.random.default_rng(8)
    items = (rng.normal(size=(5000, 10)) * 0.2 + 0.5).astype(np.float32).astype(np.float64)
    items[5] = items[9]
    iid, users = rng.permutation(5000), rng.normal(size=(400, 10)) * 0.3 + 0.5
    block = factors.with_leaves(iid, items)
    assert len(pickle.dumps(block)) < 1.5 * 4 * items.size + 2 * 8 * len(iid)
    assert block[1].dtype == np.float32 and factors.with_leaves(iid, items + 1e-12)[1].dtype == np.float64
    for scale, digits in ((1.0, None), (1.0, 6), (1e4, None)):
        for near in (None, factors._all_near):
            got = pd.concat(factors._best_of(np.arange(400), users, [factors.with_leaves(iid, items * np.float32(scale).astype(float))], 10, digits, near))
            if near is None:
                first = got.sort_values(["uid", "iid"]).reset_index(drop=True)
        assert got.sort_values(["uid", "iid"]).reset_index(drop=True).equals(first)
