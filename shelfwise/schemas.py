"""Typed schemas of the records the jobs read, keep and write."""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("product_id", T.LongType(), False),
        T.StructField("rating", T.DoubleType(), False),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("nick_name", T.StringType(), True),
        T.StructField("gender", T.DoubleType(), True),
        T.StructField("age", T.DoubleType(), True),
        T.StructField("read_style", T.StringType(), True),
        T.StructField("user_label", T.StringType(), True),
    ]
)

BOOKS = T.StructType(
    [
        T.StructField("book_id", T.LongType(), False),
        T.StructField("book_name", T.StringType(), True),
        T.StructField("author", T.StringType(), True),
        T.StructField("average", T.DoubleType(), True),
        T.StructField("book_style", T.StringType(), True),
        T.StructField("book_label", T.StringType(), True),
    ]
)

REC_ITEM = T.StructType(
    [
        T.StructField("product_id", T.LongType(), False),
        T.StructField("score", T.DoubleType(), True),
    ]
)

RECS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("recs", T.ArrayType(REC_ITEM, False), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("model_version", T.LongType(), True),
    ]
)

REJECTED = T.StructType(
    [
        T.StructField("line", T.StringType(), True),
        T.StructField("reason", T.StringType(), False),
    ]
)

FACTORS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("features", T.ArrayType(T.DoubleType(), False), False),
    ]
)

TRIALS = T.StructType(
    [
        T.StructField("trial_no", T.IntegerType(), False),
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("max_iter", T.IntegerType(), False),
        T.StructField("reg_param", T.DoubleType(), False),
        T.StructField("rmse", T.DoubleType(), True),
    ]
)

# Most distinct users or items pyspark.ml ALS accepts (it numbers them as INT).
MAX_DISTINCT = 2_147_483_647
