"""Recommendation inputs derived from the driver's Parquet tables.

The original system read header-less comma text (ratings, users, books and
their feeds).  These functions derive the same shapes, with Spark, from the
star-schema tables: ratings from order lines, users from customers, books
from parts, the rating feed from events, factor tables from embeddings.
Gender, age and rating values are stand-ins computed from existing columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import table_path

# Fixed values of the test derivations (shared with the SQL oracles).
NEW_USER_MODULUS = 5  # user_id % 5 = 0 -> "new" user, hidden from training
FACTOR_MODULUS = 5  # embeddings vec_id % 5 = 0 are user factors (numbered vec_id / 5), the rest items (numbered on)
CENTER_MODULUS = 50  # vec_id % 50 = 0 are the fixed centres
USER_CENTER_MODULUS = 150  # user_id % 150 = 0 are the fixed centres of users


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def rating_value(quantity: Column) -> Column:
    """Rating 1..5 from an order-line quantity (1..50)."""
    return (F.lit(1) + F.floor((quantity - F.lit(1)) / F.lit(10))).cast("double")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, product): the latest order line wins.

    Order is ``(o_orderdate, o_orderkey, l_linenumber, rating)``; the rating
    itself is in the order because ``(l_orderkey, l_linenumber)`` repeats.
    The aggregate is partial (map-side) so a hot user or product is reduced
    before the shuffle.
    """
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn(
        "rating", rating_value(F.col("l_quantity"))
    )
    order = F.struct("o_orderdate", "o_orderkey", "l_linenumber", "rating")
    return joined.groupBy(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
    ).agg(F.max(order)["rating"].alias("rating"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")  # fixed 25-row dimension
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.col("c_name").alias("nick_name"),
        (F.col("c_nationkey") % 2).cast("double").alias("gender"),
        (F.lit(18) + F.col("c_custkey") * 7 % 60).cast("double").alias("age"),
        F.col("c_mktsegment").alias("read_style"),
        F.col("n_name").alias("user_label"),
    )


def books(spark: SparkSession, sf_dir: str, rated: DataFrame | None = None) -> DataFrame:
    rated = rated if rated is not None else ratings(spark, sf_dir)
    averages = rated.groupBy("product_id").agg(
        F.round(F.avg("rating"), 6).alias("average")
    )
    part = read(spark, sf_dir, "part")
    return part.join(averages, part.p_partkey == averages.product_id, "left").select(
        F.col("p_partkey").cast("bigint").alias("book_id"),
        F.col("p_name").alias("book_name"),
        F.col("p_brand").alias("author"),
        F.col("average"),
        F.col("p_type").alias("book_style"),
        F.concat(F.lit("size-"), F.col("p_size").cast("string")).alias("book_label"),
    )


def rating_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New ratings arriving after bootstrap: one per event."""
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.least(F.lit(5.0), F.lit(1.0) + F.floor(F.col("value") / 20)).cast("double").alias("rating"),
    )


def is_new_user(user_id: Column) -> Column:
    return user_id % NEW_USER_MODULUS == 0


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, features array<double>)`` of every fifth embedding."""
    emb = read(spark, sf_dir, "embeddings")
    return emb.filter(F.col("vec_id") % FACTOR_MODULUS == 0).select(
        F.floor(F.col("vec_id") / FACTOR_MODULUS).cast("bigint").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other embeddings, numbered 0, 1, ... in the order of their ids."""
    emb = read(spark, sf_dir, "embeddings")
    return emb.filter(F.col("vec_id") % FACTOR_MODULUS != 0).select(
        (F.col("vec_id") - F.floor(F.col("vec_id") / FACTOR_MODULUS) - 1).cast("bigint").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))


def embedding_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_points(spark, sf_dir).filter(F.col("id") % CENTER_MODULUS == 0).select(
        F.col("id").alias("center_id"), "features"
    )


# --- text renderings (what a producer drops into a feed folder) -------------


def _field(c: str) -> Column:
    # nulls render as empty fields so positions never shift
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def as_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Render rows as header-less comma text in a ``value`` column."""
    return df.select(F.concat_ws(",", *[_field(c) for c in cols]).alias("value"))


def rating_lines(df: DataFrame) -> DataFrame:
    return as_lines(df, ["user_id", "product_id", "rating"])


def user_lines(df: DataFrame) -> DataFrame:
    return as_lines(df, ["user_id", "nick_name", "gender", "age", "read_style", "user_label"])


def book_lines(df: DataFrame) -> DataFrame:
    return as_lines(df, ["book_id", "book_name", "author", "average", "book_style", "book_label"])


def faulty_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating feed as a producer with faults would drop it.

    Each event renders one line; the event type decides the fault, so every
    quarantine rule is exercised in proportion to the data:

    - view:     ``user,product,rating``                 (well formed)
    - click:    ``user,product,rating,event_id``        (extra field, kept)
    - purchase: ``user, product,rating``                (blank, trimmed, kept)
    - signup:   ``user,product``                        (too few fields)
    - error:    ``user,product,NaN``                    (rating not finite)
    - any type with value >= 300: user id + 2^63        (id out of range)
    """
    feed = read(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        F.col("user_id").cast("string").alias("u"),
        F.get_json_object("props", "$.k").alias("p"),
        F.least(F.lit(5.0), F.lit(1.0) + F.floor(F.col("value") / 20)).cast("double").cast("string").alias("r"),
    )
    beyond = (F.col("u").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)")
    u = F.when(F.col("value") >= 300, beyond.cast("string")).otherwise(F.col("u"))
    line = (
        F.when(F.col("event_type") == "click", F.concat_ws(",", u, "p", "r", F.col("event_id").cast("string")))
        .when(F.col("event_type") == "purchase", F.concat(u, F.lit(", "), F.col("p"), F.lit(","), F.col("r")))
        .when(F.col("event_type") == "signup", F.concat_ws(",", u, "p"))
        .when(F.col("event_type") == "error", F.concat_ws(",", u, "p", F.lit("NaN")))
        .otherwise(F.concat_ws(",", u, "p", "r"))
    )
    return feed.select("event_id", line.alias("value"))


def faulty_user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user line per event, with the fields producers get wrong.

    By event type: click lines have a gender in words, purchase lines an
    empty age, error lines both and an id beyond 2^31, signup lines lack
    fields.
    """
    u = F.col("user_id").cast("string")
    wide = (F.col("user_id") + F.lit(1 << 33)).cast("string")
    age = (F.col("event_id") % 90).cast("string")
    line = (
        F.when(F.col("event_type") == "click", F.concat_ws(",", u, F.lit("n"), F.lit("female"), age, F.lit("s"), F.lit("l")))
        .when(F.col("event_type") == "purchase", F.concat_ws(",", u, F.lit("n"), F.lit("1"), F.lit(""), F.lit("s"), F.lit("l")))
        .when(F.col("event_type") == "signup", F.concat_ws(",", u, F.lit("n")))
        .when(F.col("event_type") == "error", F.concat_ws(",", wide, F.lit("n"), F.lit("?"), F.lit("old"), F.lit("s"), F.lit("l")))
        .otherwise(F.concat_ws(",", u, F.lit("n"), F.lit("0"), age, F.lit("s"), F.lit("l")))
    )
    return read(spark, sf_dir, "events").select("event_id", line.alias("value"))


def faulty_book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book line per event: 13-digit ids, averages in words, empty or infinite, missing fields."""
    isbn = (F.lit(9780000000000) + F.col("event_id")).cast("string")
    average = (
        F.when(F.col("event_type") == "click", F.lit("n/a")).when(F.col("event_type") == "purchase", F.lit(""))
        .when(F.col("event_type") == "error", F.lit("Infinity")).otherwise((F.col("event_id") % 5).cast("string"))
    )
    full = F.concat_ws(",", isbn, F.lit("t"), F.lit("a"), average, F.lit("s"), F.lit("l"))
    line = F.when(F.col("event_type") == "signup", F.concat_ws(",", isbn, F.lit("t"))).otherwise(full)
    return read(spark, sf_dir, "events").select("event_id", line.alias("value"))


def wide(ids: Column) -> Column:
    """Ids moved past the INT range, as book and user keys of large catalogues are."""
    return ids + F.lit(1 << 40)
