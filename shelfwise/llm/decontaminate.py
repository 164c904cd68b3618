"""Benchmark decontamination: size-partitioned MinHash containment, verified exactly.

Native DataFrame operations only.  Test items are partitioned by the power
of two of their shingle count.  An item of n shingles that is contained to
80 % misses at most n / 5 of them, so at least one of its n / 5 + 1 smallest
MinHash values is in the document; each size class keeps as many as its
largest member needs.  Documents too short for a class are not probed for
it.  Candidates are verified by comparing the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.store import keep

#: Words are runs of letters and digits.
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def digest(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def _shingles(rows: DataFrame, width: int, *keys: str) -> DataFrame:
    """A row per run of ``width`` words of column ``w``: the keys, ``n`` (their number) and ``g0``, ``g1``, ..."""
    n = F.size("w") - width + 1
    runs = F.arrays_zip(*[F.slice("w", j + 1, F.greatest(n, F.lit(0))).alias(f"g{j}") for j in range(width)])
    exploded = rows.where(F.size("w") >= width).select(*keys, n.alias("n"), F.explode(runs).alias("g"))
    return exploded.select(*keys, "n", "g.*")


def item_shingles(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct shingles of every item: ``item_id s h n`` (``n`` distinct shingles)."""
    rows = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w"))
    grams = [f"g{j}" for j in range(width)]
    each = _shingles(rows, width, "item_id").select("item_id", F.concat_ws(" ", *grams).alias("s"), F.xxhash64(*grams).alias("h")).distinct()
    count = each.groupBy("item_id").agg(F.count("*").alias("n"))
    return each.join(count.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i"))).drop("i")


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """``item_id h need``: per item the smallest MinHash values, as many as its size class asks for."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1).cast("long") - 1
    size = F.floor(largest * (100 - percent) / 100) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("h", F.lit("minhash")), "h"))
    ranked = shingles.withColumn("rank", rank).where(F.col("rank") <= size)
    return ranked.select("item_id", "h", F.ceil(F.col("n") * percent / 100).alias("need"))


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = 5, percent: int = 80,
) -> DataFrame:
    """Pairs ``doc_id item_id n_shared n_item containment`` where a document holds at least ``percent`` of an item's shingles.

    Words are runs of letters and digits in lower case; a shingle is
    ``width`` words, wherever it stands in the document.

    Items of fewer than ``width`` words, null ones included, have no shingle
    and match nothing; so do null, empty or shorter documents.  Every row is
    judged by its own text; a pair found in several rows with one id is
    reported once, with its largest overlap.  Items with one id are one
    item with all their shingles.  Null ids are reported as null.  Empty
    tables give an empty result; other columns are not read.
    """
    overlap = overlaps(docs, items, id_col, text_col, item_col, item_text_col, width, percent)
    overlap = overlap.groupBy("doc_id", "item_id", F.col("n").alias("n_item")).agg(F.max("n_shared").alias("n_shared"))
    return overlap.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def overlaps(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, width: int, percent: int) -> DataFrame:
    """``doc_id v item_id n n_shared``: as ``contaminated``, for each text of an id by itself; ``v`` is the text's digest."""
    shingles = keep(item_shingles(items, item_col, item_text_col, width), "items")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), digest(text_col).alias("v"))
    grams = [f"g{j}" for j in range(width)]

    worded = rows.select("doc_id", "v", words(F.col("text")).alias("w"))
    probes = _shingles(worded, width, "doc_id", "v").select("doc_id", "v", F.col("n").alias("size"), F.xxhash64(*grams).alias("h"))
    found = probes.join(sketches(shingles, percent), "h").where(F.col("size") >= F.col("need"))
    candidates = keep(found.select("doc_id", "v", "item_id").distinct(), "candidates")

    # only candidate documents are read again, and compared by the words themselves
    asked = candidates.select(F.col("doc_id").alias("d"), "v").distinct()
    again = rows.alias("r").join(asked.alias("a"), (F.col("r.v") == F.col("a.v")) & F.col("r.doc_id").eqNullSafe(F.col("a.d")), "left_semi")
    again = _shingles(again.select("doc_id", "v", words(F.col("text")).alias("w")), width, "doc_id", "v")
    shared = again.select("doc_id", "v", F.concat_ws(" ", *grams).alias("s")).join(shingles.select("item_id", "s", "n"), "s").distinct()
    overlap = shared.groupBy("doc_id", "v", "item_id", "n").agg(F.count("*").alias("n_shared"))
    return overlap.where(F.col("n_shared") * 100 >= F.col("n") * percent)


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = 5, percent: int = 80,
) -> DataFrame:
    """``docs`` without the rows whose text holds an item, all columns kept; see ``contaminated``.  Other rows of the same id stay."""
    bad = overlaps(docs, items, id_col, text_col, item_col, item_text_col, width, percent)
    bad = bad.select(F.col("doc_id").alias("__bad"), F.col("v").alias("__v")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("__bad")) & (digest(text_col) == F.col("__v")), "left_anti")
