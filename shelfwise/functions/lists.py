"""Recommendation lists: typed arrays <-> the comma-joined text form.

The keyed store of the original system held a user's list as two strings,
book ids and scores, comma-joined in rank order without a trailing comma.
We keep ``array<struct<product_id, score>>`` and render/parse the text form
only at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text format for a score: six decimals (scores are rounded to 6 places).
SCORE_FORMAT = "%.6f"


def books_text(recs: Column) -> Column:
    """'12,7,40' - product ids in rank order."""
    return F.array_join(F.transform(recs, lambda x: x["product_id"].cast("string")), ",")


def scores_text(recs: Column) -> Column:
    """'4.812345,4.700000,...' - scores in rank order, fixed six decimals."""
    return F.array_join(
        F.transform(recs, lambda x: F.format_string(SCORE_FORMAT, x["score"])), ","
    )


def recs_from_text(books: Column, scores: Column | None = None) -> Column:
    """Parse the text form back into ``array<struct<product_id, score>>``.

    Blank lists give an empty array; scores are optional (cold-start rows
    carry book ids only).
    """
    ids = F.when(F.trim(books) == "", F.array().cast("array<string>")).otherwise(
        F.split(books, ",")
    )
    if scores is None:
        return F.transform(
            ids,
            lambda b: F.struct(
                F.trim(b).try_cast("bigint").alias("product_id"),
                F.lit(None).cast("double").alias("score"),
            ),
        )
    vals = F.split(scores, ",")
    return F.transform(
        ids,
        lambda b, i: F.struct(
            F.trim(b).try_cast("bigint").alias("product_id"),
            F.trim(F.get(vals, i)).try_cast("double").alias("score"),
        ),
    )


def first_id(books: Column) -> Column:
    """First product id of a comma list (the donor-key idiom of the feed)."""
    return F.trim(F.split(books, ",").getItem(0)).try_cast("bigint")
