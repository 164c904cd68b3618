"""Corpus pipeline: five stages over ``documents``, each written to the shared folder and read back.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept; all but the last return the columns of ``documents``.
Null texts are rejected by the first stage (no language); repeated rows meet
in the near-duplicate stage, where one of each group stays; an empty table
passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from shelfwise.llm.store import keep

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a recognisable language: no letter, or no language with half of the posterior."""
    model = language_id.fit(docs.where(~language_id.held_out("doc_id", 4, 2)))
    told = language_id.predict(docs.select(*DOCUMENT), model, with_text=True)
    return told.where((F.col("lang_pred") != language_id.UNDEFINED) & (F.col("score") >= 0.5)).select(*DOCUMENT)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that five documents or more share, except in the last of them.

    ``n_chars`` follows the text; a document that loses all its lines stays as an empty one.
    """
    kept = line_dedup.dedup_lines(docs.select(*DOCUMENT))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows count by their own texts, also where they share an id or have none.
    """
    return jaccard_join.drop_similar(docs.select(*DOCUMENT), width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.decontaminate(docs.select(*DOCUMENT), items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to the sources' target weights: every document with how many of its words are taken, copies counted."""
    return mixing.plan(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The first stage is a fitted model, which SQL can't express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
