"""Source divergence audit: how far the sources of a language stand apart, and by which terms.

Terms are counted inside the tasks and summed by Spark.  A source's distance
from another is a sum over the language's kept terms; terms that only one of
the two holds enter through a histogram of their counts, so only terms that
both hold are looked at one by one.  The most telling terms of a source are
found by a dominance skyband: a term that k others beat in group count
(higher), language count (lower) and UTF-8 order (earlier) cannot be among
the first k, whatever the totals are.  Each partition keeps its skyband, the
skybands are merged, and what is left is ranked exactly.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep
from shelfwise.llm.words import raw, slices

#: In UTF-8 every byte of a character past ASCII is 0x80 or more; A-Z are lower-cased before.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Probabilities are whole multiples of 1 / SCALE.
SCALE = 1_000_000_000
#: Terms that a task counts before it hands them on.
HELD = 400_000
#: Rows whose dominators are counted at once, and rows that a task gathers beyond its skybands before it cuts them.
BLOCK = 256
SETTLE = 100_000

_COUNTS = "lang string, source string, term string, n long, df long"
_TERMS = "lang string, source string, term string, n long, total long"


# --- counts -----------------------------------------------------------------------


def _flush(groups: dict):
    for (lang, source), (n, df) in groups.items():
        terms = list(n)
        # a row without a term says that the group occurs
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([source] * (len(terms) + 1), pa.string()),
                pa.array([b"", *terms], pa.binary()).cast(pa.string()),
                pa.array([0, *n.values()], pa.int64()), pa.array([0, *(df[t] for t in terms)], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "df"],
        )


def _count(batches):
    groups: dict = {}
    held = 0
    for batch in slices(batches, "text"):
        data, offsets = raw(batch.column("text"))
        data, offsets = data.tobytes(), offsets.tolist()
        keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for i, key in enumerate(keys):
            n, df = groups.setdefault(key, (Counter(), Counter()))
            held -= len(n)
            found = TERM.findall(data[offsets[i] : offsets[i + 1]].lower())
            n.update(found)
            df.update(set(found))
            held += len(n)
            if held > HELD:
                yield from _flush(groups)
                groups, held = {}, 0
    yield from _flush(groups)


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang source term n df``: occurrences and documents of every term in every group, and a row with an empty term per group."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    counted = rows.mapInArrow(_count, _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


# --- exact arithmetic -------------------------------------------------------------


def probability(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + kept))`` in whole numbers of any size."""
    wide = "decimal(19,0)"
    above = (F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast(wide)).cast("decimal(29,0)")
    return F.call_function("div", above, (total + kept).cast(wide)) + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; both are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


# --- skyband ----------------------------------------------------------------------


def skyband(n: np.ndarray, total: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions dominated by fewer than ``k`` others: ``n`` not lower, ``total`` not higher, ``place`` earlier.

    In the order (n down, total up, place up) all that dominate a row come
    before it.  The first k of a row's dominators are in the skyband
    themselves, so rows are compared with the skyband so far and with the
    rows of their own block.
    """
    order = np.lexsort((place, total, -n))
    total = np.searchsorted(np.unique(total), total)[order].astype(np.int32)
    place = place[order].astype(np.int32)
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), BLOCK):
        t, u = total[at : at + BLOCK, None], place[at : at + BLOCK, None]
        own = (t.T <= t) & (u.T < u)
        beaten = np.count_nonzero((total[kept] <= t) & (place[kept] < u), axis=1) + np.count_nonzero(np.tril(own, -1), axis=1)
        kept = np.concatenate([kept, at + np.flatnonzero(beaten < k)])
    return order[kept]


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().dictionary_encode().indices).astype(np.int64)


def _skybands(table: pa.Table, k: int) -> pa.Table:
    """The rows of every group that are in its skyband."""
    place = np.empty(table.num_rows, np.int64)
    place[np.asarray(pc.sort_indices(table["term"]))] = np.arange(table.num_rows)
    n, total = np.asarray(table["n"]), np.asarray(table["total"])
    group = _codes(table["lang"]) * table.num_rows + _codes(table["source"])
    rows = np.argsort(group, kind="stable")
    parts = np.split(rows, np.flatnonzero(np.diff(group[rows])) + 1)
    return table.take(np.concatenate([part[skyband(n[part], total[part], place[part], k)] for part in parts]))


def _band(k: int):
    def run(batches):
        held, limit = [], SETTLE
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= limit:
                held = [_skybands(pa.concat_tables(held), k)]
                limit = 2 * held[0].num_rows + SETTLE
        if sum(t.num_rows for t in held):
            yield from _skybands(pa.concat_tables(held), k).to_batches(max_chunksize=10_000)

    return run


def telling_terms(found: DataFrame, k: int) -> DataFrame:
    """``lang source term n total`` cut down to terms that can be among a group's first ``k``: skybands of partitions, merged."""
    bands = keep(found.select("lang", "source", "term", "n", "total").mapInArrow(_band(k), _TERMS), "skybands")
    # a group's skybands meet in a few tasks, dealt by term, and are cut once more before they are ranked
    return bands.repartition(F.col("lang"), F.col("source"), F.pmod(F.xxhash64("term"), F.lit(4))).mapInArrow(_band(k), _TERMS)


# --- audit ------------------------------------------------------------------------


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang source part item value rank``: every source's distance from the others of its language, and its most telling terms.

    Terms are runs of ASCII letters and characters past ASCII, A-Z
    lower-cased.  A language keeps the terms of at least ``min_docs`` of its
    documents; each group (language and source) and each language gives a
    kept term the smoothed probability of ``probability``.  Part ``pair``:
    the other sources of the language by ``gap`` summed over all kept terms.
    Part ``term``: kept terms that the group holds and uses more than the
    language does, the first ``top`` by ``gap``.  Ties go to the earlier
    UTF-8.

    Null texts, languages and sources count as empty ones; every row is a
    document of its own, repeated rows too.  A group without terms, or of a
    language that keeps none, still has its pairs (value 0 where no term is
    kept).  An empty table gives an empty result; other columns are not read.

    Sums are partial aggregates, so a source or a language with a third of
    all rows shuffles its distinct terms once a task.
    """
    counts = keep(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    groups = counts.where("term = ''").select("lang", "source")
    terms = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_docs)
    found = keep(counts.where("term != ''").join(terms.select("lang", "term", "total"), ["lang", "term"]), "kept-terms")
    # every kept term occurs in a group, so a language's totals are the sums over its groups
    held = found.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("types"))
    langs = (
        found.groupBy("lang", "term").agg(F.sum("n").alias("total"))
        .groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count("*").alias("kept"))
    )
    sizes = (
        groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
        .withColumn("zero", F.when(F.col("kept") > 0, probability(F.lit(0).cast("long"), F.col("size"), F.col("kept"))).otherwise(1))
    )
    sizes = keep(sizes, "groups")

    return pairs(found, sizes).unionByName(first_terms(found, sizes, top))


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))))


def pairs(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """Part ``pair``: every ordered pair of sources of a language.

    The sum over all kept terms starts as if no term were held by both:
    terms of the one against the other's probability of an unseen term, by
    distinct count, and the unseen rest.  Terms that both hold then replace
    what was assumed of them; their rows are as many as pairs of sources
    that hold a term, and are summed where they arise.
    """
    a = sizes.select("lang", F.col("source").alias("sa"), F.col("size").alias("na"), F.col("types").alias("va"), F.col("zero").alias("za"), "kept")
    b = sizes.select("lang", F.col("source").alias("sb"), F.col("size").alias("nb"), F.col("types").alias("vb"), F.col("zero").alias("zb"))
    histogram = found.groupBy("lang", "source", "n").agg(F.count("*").alias("many"))
    both = a.join(b, "lang").where("sa != sb")
    rest = both.select("lang", "sa", "sb", (gap(F.col("za"), F.col("zb")) * (F.col("kept") - F.col("va") - F.col("vb"))).alias("value"))

    seen = histogram.join(sizes.select("lang", "source", "size", "kept"), ["lang", "source"])
    seen = seen.select("lang", "source", "many", probability(F.col("n"), F.col("size"), F.col("kept")).alias("p"))
    others = sizes.select("lang", F.col("source").alias("other"), "zero")
    met = seen.join(others, "lang").where(F.col("source") != F.col("other"))
    mine = met.select("lang", F.col("source").alias("sa"), F.col("other").alias("sb"), (gap(F.col("p"), F.col("zero")) * F.col("many")).alias("value"))
    theirs = met.select("lang", F.col("other").alias("sa"), F.col("source").alias("sb"), (gap(F.col("zero"), F.col("p")) * F.col("many")).alias("value"))

    worth = found.join(sizes.select("lang", "source", "size", "kept", "zero"), ["lang", "source"])
    worth = worth.select("lang", "term", "source", "zero", probability(F.col("n"), F.col("size"), F.col("kept")).alias("p"))
    one = worth.select("lang", "term", F.col("source").alias("sa"), F.col("zero").alias("za"), F.col("p").alias("pa"))
    two = worth.select("lang", "term", F.col("source").alias("sb"), F.col("zero").alias("zb"), F.col("p").alias("pb"))
    shared = one.join(two, ["lang", "term"]).where("sa < sb")

    def instead(p, z, q, y):
        return F.sum(gap(p, q) - gap(p, y) - gap(z, q) + gap(z, y))

    pa_, za, pb, zb = (F.col(c) for c in ("pa", "za", "pb", "zb"))
    shared = shared.groupBy("lang", "sa", "sb").agg(instead(pa_, za, pb, zb).alias("there"), instead(pb, zb, pa_, za).alias("back"))
    shared = keep(shared, "shared-terms")
    there = shared.select("lang", "sa", "sb", F.col("there").alias("value"))
    back = shared.select("lang", F.col("sb").alias("sa"), F.col("sa").alias("sb"), F.col("back").alias("value"))

    value = rest.unionByName(mine).unionByName(theirs).unionByName(there).unionByName(back)
    value = value.groupBy("lang", F.col("sa").alias("source"), F.col("sb").alias("item")).agg(F.sum("value").alias("value"))
    return _ranked(value).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def first_terms(found: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """Part ``term``: the first ``top`` terms of each group."""
    worth = sizes.where("types > 0").select("lang", "source", "size", "kept", "lang_size")

    def judged(rows: DataFrame) -> DataFrame:
        p = probability(F.col("n"), F.col("size"), F.col("kept"))
        q = probability(F.col("total"), F.col("lang_size"), F.col("kept"))
        return rows.join(worth, ["lang", "source"]).withColumn("p", p).withColumn("q", q).where("p > q")

    left = telling_terms(judged(found), top)
    value = judged(left).select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(value).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


by_value(__name__)
