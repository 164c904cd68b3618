"""Chat formatting: best branches of reply trees as conversations with a loss mask.

A tree's nodes name their parents.  Pointer doubling (self-joins that double
the reach of every node's ancestor pointer) gives each node its depth and
the summed score of its path; the best leaves are chosen by rank, and the
same pointers, taken in falling order, mark the nodes on their paths.

The template marks a turn as ``<s>[INST] role [/INST] text</s>``.  Where a
control string or a backslash stands in a role or text, a backslash is put
before it, so that the output reads back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
ESCAPED = r"(\\|</?s>|\[/?INST\])"
#: Role whose text is under the loss mask.
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """A backslash before each backslash and control string."""
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|</?s>|\[/?INST\])", r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, parts, at = [], [], 0
    for m in re.finditer(r"\\(?:\\|</?s>|\[/?INST\])|<s>\[INST\] | \[/INST\] |</s>", formatted):
        if m.group().startswith("\\"):
            continue
        if m.group() != OPEN:
            parts.append(unescape(formatted[at : m.start()]))
        if m.group() == CLOSE:
            turns.append((parts[0], parts[1]))
            parts = []
        at = m.end()
    return turns


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """Of ``nodes`` (``tree node parent score``, all but score any orderable type), the nodes on the chosen paths.

    Returns ``tree leaf rank node depth``: the ``best`` root-to-leaf paths of
    every tree by summed score (ties to the smaller leaf), node by node from
    depth 0.  A node without a parent among its tree's nodes is a root; a
    tree may have several.  Node names are distinct within a tree and
    parents form no cycle.
    """
    known = nodes.select("tree", F.col("node").alias("parent"))
    start = nodes.join(known.withColumn("has", F.lit(True)), ["tree", "parent"], "left")
    now = start.select("tree", "node", F.when(F.col("has"), F.col("parent")).alias("up"), F.lit(0).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    now = keep(now.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1)), "reply-0")
    # levels[i]: each node's ancestor 2^i up; depth and score cover the nodes from it (without it)
    # down to the node.  Nodes that have reached a root are done and are only looked up.
    levels, done, active = [], now.where("up is null"), now.where("up is not null")
    while active.limit(1).count():
        levels.append(active.select("tree", "node", "up"))
        other = done.union(active).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        met = active.join(other, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("score") + F.col("score2")).alias("score"))
        met = keep(met, f"reply-{len(levels)}")
        done, active = done.union(met.where("up is null")), met.where("up is not null")
    now = done
    parents = levels[0].select("tree", F.col("up").alias("node")).distinct() if levels else None
    leaves = now.join(parents, ["tree", "node"], "left_anti") if parents is not None else now
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= best).select("tree", F.col("node").alias("leaf"), "rank", "node", "depth", F.lit(0).cast("long").alias("below"))
    if levels:
        chosen = keep(chosen, "leaves")
    for i in reversed(range(len(levels))):
        step = levels[i]
        above = chosen.join(step, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), "depth", (F.col("below") + (1 << i)).alias("below"))
        chosen = keep(chosen.union(above), f"path-{i}")
    return chosen.select("tree", "leaf", "rank", "node", (F.col("depth") - F.col("below")).alias("depth"))


def format_trees(turns: DataFrame, best: int = 1) -> DataFrame:
    """``tree rank formatted mask`` for the ``best`` branches of every tree of ``turns``.

    ``turns``: ``tree node parent score role text``.  ``mask`` lists the
    spans of ``formatted`` (start, end in code points) under the loss: the
    escaped text of every assistant turn.

    Null roles and texts are empty; a null score is 0; rows of null trees
    belong to one tree (named null).  Repeated rows must carry node names of
    their own.  An empty table gives an empty result; other columns are not
    read.
    """
    rows = turns.select(
        F.struct("tree").alias("key"), F.struct(F.col("tree").isNull().alias("none"), F.coalesce(F.col("tree").cast("string"), F.lit(""))).alias("tree"),
        "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = keep(rows.withColumn("tree", F.to_json("tree")), "turns")
    chosen = paths(rows.select("tree", "node", "parent", "score"), best)
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    met = chosen.join(rows, ["tree", "node"]).select(
        "tree", "key", "rank", "depth", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == LEARNED).alias("learned")
    )
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    ahead = Window.partitionBy("tree", "key", "rank").orderBy("depth")
    met = met.withColumn("at", F.sum(size).over(ahead) - size + F.char_length("head"))
    told = met.groupBy("tree", "key", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "head", "body", "learned", "at"))).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["learned"]),
        lambda t: F.struct(t["at"].alias("start"), (t["at"] + F.char_length(t["body"])).alias("end")),
    )
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return told.select("key.tree", "rank", formatted.alias("formatted"), spans.alias("mask"))


def chains(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Linear conversations as trees of one branch: every row replies to the one before it.

    Rows are ordered by turn (null last), then role and text, so that ties
    and repeated rows have a defined order and all are kept.
    """
    order = Window.partitionBy(id_col).orderBy(F.col(turn_col).asc_nulls_last(), "role", "text")
    rows = conversations.select(F.col(id_col).alias("tree"), F.row_number().over(order).alias("node"), "role", "text")
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """``conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars``, read back from the formatted text and its mask."""
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            out = []
            for tree, text, mask in zip(batch["tree"], batch["formatted"], batch["mask"], strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in mask)
                out.append((tree, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "formatted", "mask").mapInPandas(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


by_value(__name__)
