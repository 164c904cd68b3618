"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of shuffled documents, up to ``most`` times over.  A
copy's virtual finish time is the source's cumulative words divided by the
source's target; all copies are ordered by finish time and the order is cut
where the total budget of words is used up.  Cumulative sums are made in two
levels (buckets of the shuffle order, then rows within a bucket), so that no
source, however large, is handled by one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.store import keep

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Per source (``source``, ``source_size``): ``target``, filled up by weight and stopped at ``most`` sizes.

    ``sizes`` has a row per source.  In the order of size over weight the
    level at which the rest of the budget would be shared rises; the first
    source not reached by it sets the level for itself and all after it.
    """
    every = Window.orderBy("null_last", "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    by, whole = Window.orderBy("ratio", "null_last", "source"), Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * F.lit(float(most))
    full = (
        sizes.withColumn("null_last", F.col("source").isNull().cast("int"))
        .withColumn("w", w)
        .withColumn("ratio", cap / F.col("w"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("used", F.coalesce(F.sum(cap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("used")) / F.col("left_w"))
        .withColumn("place", F.row_number().over(by))
        .withColumn("common", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("place", "level"))).over(whole))
    )
    target = F.when(F.col("place") >= F.col("common.place"), F.col("w") * F.col("common.level")).otherwise(cap)
    return full.select("source", "source_size", "budget", target.alias("target"))


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id size source_size target taken``, ``source``, ``finish`` and the columns of ``carry``.

    ``taken`` is how many words of the document the mix holds, copies
    counted; ``finish`` is the virtual finish time of its first copy.  A
    document has at most ``most`` copies; only the one at the budget's end
    is taken in part.  Reruns agree: the shuffle is a hash of seed and id.

    Nulls: a null text has size 0 and takes nothing; null sources are one
    source, last in the order of weights; a null id is shuffled as the
    empty string.  Repeated rows are documents of their own.  An empty
    table gives an empty result; so does nothing but empty texts, with
    targets of 0.
    """
    rows = keep(
        docs.select(
            F.struct(F.col(id_col).alias("doc_id"), *[F.col(c) for c in carry]).alias("row"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("turn"),
        ),
        "sized",
    )
    buckets = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("bucket", _bucket(F.conv(F.substring("turn", 1, 12), 16, 10).cast("double") / float(1 << 48), buckets))
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    parts = keep(parts, "mix-parts")
    aims = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    parts = parts.alias("p").join(aims.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source"))).select("p.source", "bucket", "ahead", "source_size", "budget", "target")
    queue = Window.partitionBy("source", "bucket").orderBy("turn", "row.doc_id", "size")
    queued = (
        rows.alias("r")
        .join(parts.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.bucket") == F.col("p.bucket")))
        .select("r.row", "r.source", "r.size", "r.turn", "r.bucket", "ahead", "source_size", "budget", "target")
        .withColumn("upto", F.col("ahead") + F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("bucket", "ahead")
    )
    queued = keep(queued, "mix-queued")

    # the virtual time axis in buckets, to find the one in which the budget ends
    copies = queued.where("size > 0").select(
        "size", "turn", F.col("row.doc_id").alias("id"), "source", F.floor("budget").alias("budget"),
        F.posexplode(F.array(*[(F.col("upto") + c * F.col("source_size")) / F.col("target") for c in range(most)])).alias("copy", "finish"),
    )
    # beyond 4 lies no cut in practice: one slot for all of it keeps the axis short
    copies = copies.withColumn("slot", F.least(F.floor(F.col("finish") * buckets), F.lit(4 * buckets)))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    slots = slots.withColumn("before", F.sum("words").over(Window.orderBy("slot")) - F.col("words"))
    ends = (F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words"))
    last = slots.where(ends).select("slot", "before").first()
    edge = None
    if last is not None:
        # in that one, the copy at which it ends
        key = _key("finish", "turn", "id", "source", "copy")
        here = copies.where(F.col("slot") == last.slot).withColumn("key", key)
        here = here.withColumn("before", F.lit(last.before) + F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        edge = here.where((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("size"))).select("key.*", (F.col("budget") - F.col("before")).alias("rest")).first()
    taken = F.lit(0).cast("long")
    for c in range(most):
        if edge is None:
            taken = taken + F.col("size")
            continue
        key = _key((F.col("upto") + c * F.col("source_size")) / F.col("target"), "turn", F.col("row.doc_id"), "source", F.lit(c))
        at = F.struct(*[F.lit(edge[f]).alias(f) for f in ("finish", "turn", "no_id", "id", "no_source", "source", "copy")])
        taken = taken + F.when(F.col("size") == 0, 0).when(key < at, F.col("size")).when(key == at, F.lit(edge.rest)).otherwise(0)
    return queued.select(
        "row.*", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("upto") / F.col("target")).alias("finish"),
    )


def _bucket(share: Column, buckets: int) -> Column:
    return F.floor(share * buckets).cast("int")


def _key(finish, turn, id_, source, copy) -> Column:
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.struct(
        col(finish).alias("finish"), col(turn).alias("turn"), col(id_).isNull().alias("no_id"), F.coalesce(col(id_).cast("string"), F.lit("")).alias("id"),
        col(source).isNull().alias("no_source"), F.coalesce(col(source), F.lit("")).alias("source"), col(copy).cast("int").alias("copy"),
    )
