"""Column-expression helpers: vectors, list text form, hash split."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from shelfwise.functions import books_text, dot, first_id, hash_bucket, key_string, recs_from_text, scores_text, sq_dist, train_flag


def test_dot_and_distance_match_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=16), rng.normal(size=16)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<double>, b array<double>")
    row = df.select(dot(F.col("a"), F.col("b")).alias("d"), sq_dist(F.col("a"), F.col("b")).alias("s")).first()
    assert abs(row["d"] - float(a @ b)) < 1e-12
    assert abs(row["s"] - float(((a - b) ** 2).sum())) < 1e-12


def test_list_text_round_trip(spark):
    df = spark.createDataFrame([(1, [(5, 4.5), (7, 3.25)]), (2, [])],
                               "user_id int, recs array<struct<product_id:bigint,score:double>>")
    txt = df.select("user_id", books_text(F.col("recs")).alias("b"), scores_text(F.col("recs")).alias("s"))
    rows = {r["user_id"]: (r["b"], r["s"]) for r in txt.collect()}
    assert rows == {1: ("5,7", "4.500000,3.250000"), 2: ("", "")}
    back = txt.select("user_id", recs_from_text(F.col("b"), F.col("s")).alias("recs"), first_id(F.col("b")).alias("first"))
    got = {r["user_id"]: ([(x["product_id"], x["score"]) for x in r["recs"]], r["first"]) for r in back.collect()}
    assert got == {1: ([(5, 4.5), (7, 3.25)], 5), 2: ([], None)}
    ids_only = txt.select(recs_from_text(F.col("b")).alias("r")).first()["r"]
    assert [(x["product_id"], x["score"]) for x in ids_only] == [(5, None), (7, None)]


def test_hash_split_matches_sql(spark):
    keys = [(u, p) for u in range(0, 40, 3) for p in range(0, 30, 7)]
    df = spark.createDataFrame(keys, "user_id int, product_id int")
    got = {(r["user_id"], r["product_id"]): (r["b"], r["t"]) for r in df.select(
        "user_id", "product_id",
        hash_bucket(key_string("user_id", "product_id")).alias("b"),
        train_flag(key_string("user_id", "product_id")).alias("t")).collect()}
    con = duckdb.connect()
    rows = con.sql(
        "SELECT u, p, ('0x' || substr(md5(CAST(concat_ws(':', u, p) AS VARCHAR)), 1, 8))::BIGINT % 10 AS b "
        f"FROM (VALUES {', '.join(f'({u}, {p})' for u, p in keys)}) t(u, p)"
    ).fetchall()
    for u, p, b in rows:
        assert got[(u, p)] == (b, b < 7)
