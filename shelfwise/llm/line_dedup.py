"""Line dedup: drop lines that many documents share, except in the last document holding them.

Native DataFrame operations only.  Lines are exploded with their position,
their normalised keys are hashed, each hash counts its distinct documents,
and the lines that stay are put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import keep

BLANKS = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null id: below all others.
NO_ID = -(1 << 63)


def lines(text: Column) -> Column:
    """The text's lines; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ASCII text takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """One row per document that loses lines: ``d``, ``v`` (its text's md5), ``gone`` (sorted positions from 0)."""
    found = (
        docs.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
            F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("v"),
            F.posexplode(lines(F.col(text_col))).alias("p", "line"),
        )
        .withColumn("line", F.btrim("line", F.lit(BLANKS)))
        .where(F.char_length("line") >= min_chars)
        .select("d", "v", "p", F.unhex(F.md5(ascii_lower(F.col("line")))).alias("k"))
    )
    found = keep(found, "lines")
    common = (
        found.groupBy("k", "d").agg(F.lit(1).alias("one"))
        .groupBy("k").agg(F.count("one").alias("n"), F.max("d").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("k", "last")
    )
    # a table of its own, so that Spark can split the partition of a very common key in the join
    common = keep(common, "common-lines")
    return (
        found.join(common, "k")
        .where(F.col("d") < F.col("last"))
        .groupBy("d", "v").agg(F.sort_array(F.collect_set("p")).alias("gone"))
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``docs`` with ``text_col`` cut down to the lines that stay, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A-Z in lower
    case.  Keys of at least ``min_chars`` code points found in at least
    ``min_docs`` different documents lose all their lines except in the
    document with the largest id.  Other lines stay as they are.

    Nulls: a null text counts as empty (one empty line, which stays) and
    comes back as empty; a null id counts as one document below all others.
    Rows that repeat an id are one document for counting and are each cut
    on their own.  An empty table gives an empty result.  Other columns
    pass through; ``n_lines`` and ``n_dropped`` replace columns so named.

    Only hashes and positions are shuffled by line; the texts move once, to
    meet their list of positions.
    """
    gone = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(
        F.struct(*names).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("v"),
    )
    met = base.join(gone, ["d", "v"], "left").withColumn("all", lines(F.col(f"row.{text_col}")))
    # between two dropped positions lies a slice that stays
    cut = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    before = F.concat(F.array(F.lit(-1)), cut)
    after = F.concat(cut, F.array(F.size("all")))
    stay = F.flatten(
        F.transform(
            F.arrays_zip(before.alias("b"), after.alias("a")),
            lambda z: F.slice(F.col("all"), z["b"] + 2, z["a"] - z["b"] - 1),
        )
    )
    text = F.when(F.col("gone").isNull(), F.coalesce(F.col(f"row.{text_col}"), F.lit(""))).otherwise(F.array_join(stay, "\n"))
    return met.select(
        *[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names],
        F.size("all").cast("long").alias("n_lines"),
        F.size(cut).cast("long").alias("n_dropped"),
    )
