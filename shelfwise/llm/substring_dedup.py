"""Substring dedup: words in long runs that an earlier document also holds, found by FM-indexes.

Windows of ``length`` words are routed by their minimizer, the smallest hash
of a run of GRAM words in them: equal windows have equal minimizers.  The
windows of a document that share one minimizer form a segment; equal
segments are reduced to the first document before anything else moves.
Segments that share a minimizer but differ are indexed shard by shard: an
FM-index over earlier documents' segments, against which later documents'
segments are streamed for matching statistics by backward search.  Within a
minimizer every pair of documents is told apart by one bit of their ranks,
so one index per bit sees each pair once, the earlier side indexed.

A minimizer with more than CROWD different segments (the edge of a passage
that very many documents hold) would be one task's work; its windows are
compared by their 128-bit hashes over the whole cluster instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.fm_index import FMIndex, matching_windows
from shelfwise.llm.store import by_value, keep
from shelfwise.llm.words import Words, mix, rolled, rows_of, slices, spread

#: Words in a minimizer's run; most different segments of one minimizer in an index; words of a shard.
GRAM, CROWD, SHARD_WORDS = 8, 64, 400_000
#: Stands for a null id: before all others.
NO_ID = -(1 << 63)
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
PLACE = np.uint64((1 << 22) - 1)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


class Prints:
    """128-bit hashes of any runs of words."""

    def __init__(self, hashes: np.ndarray):
        self.parts = []
        for base in BASES:
            power = np.cumprod(np.full(len(hashes) + 1, base)) * np.uint64(pow(int(base), -1, 1 << 64))
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(hashes * power[:-1], out=sums[1:])
            back = np.cumprod(np.full(len(hashes) + 1, np.uint64(pow(int(base), -1, 1 << 64)))) * base
            self.parts.append((sums, back))

    def of(self, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        tag = mix(np.asarray(size).astype(np.uint64))
        return [mix((sums[start + size] - sums[start]) * back[start] ^ tag).view(np.int64) for sums, back in self.parts]


def segments(words: Words, length: int) -> tuple[np.ndarray, ...]:
    """Row, minimizer, first window, number of windows and print of every segment."""
    hashes = words.hashes()
    inner = length - GRAM + 1
    windows = np.maximum(words.count - length + 1, 0)
    at = spread(words.first[:-1], windows)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    n = len(hashes) - GRAM + 1
    key = (rolled(hashes, np.arange(n), GRAM) & ~PLACE) | (np.arange(n).astype(np.uint64) & PLACE)
    least = _least(key, inner)[at]
    row = rows_of(windows)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(fresh)
    size = np.diff(np.append(head, len(at)))
    s1, s2 = Prints(hashes).of(at[head], size + length - 1)
    return row[head], (least[head] & ~PLACE).view(np.int64), at[head] - words.first[:-1][row[head]], size, s1, s2


def _segmented(length: int):
    def run(batches):
        for batch in slices(batches, "text"):
            row, gram, start, size, s1, s2 = segments(Words(batch.column("text")), length)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").take(pa.array(row)), batch.column("v").take(pa.array(row)), pa.array(gram), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(s1), pa.array(s2)],
                names=["d", "v", "gram", "start", "size", "s1", "s2"],
            )

    return run


def _contents(length: int):
    def run(batches):
        """The text of each asked segment; of a crowded minimizer's segments, every window's print."""
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            prints = Prints(words.hashes())
            asked = batch.column("asked")
            flat, row = asked.flatten(), rows_of(np.asarray(pa.compute.list_value_length(asked)))
            gram, s1, s2 = (np.asarray(flat.field(k)) for k in ("gram", "s1", "s2"))
            size, crowd = np.asarray(flat.field("size")).astype(np.int64), np.asarray(flat.field("crowd"))
            start = words.first[:-1][row] + np.asarray(flat.field("start"))
            some = np.flatnonzero(~crowd)
            low, high = words.start[start[some]], words.end[start[some] + size[some] + length - 2]
            text = words.data.tobytes()
            texts = [text[x:y] for x, y in zip(low, high, strict=True)]
            many = np.flatnonzero(crowd)
            each = np.repeat(many, size[many])
            nth = spread(np.zeros(len(many), np.int64), size[many])
            w1, w2 = prints.of(start[each] + nth, np.full(len(each), length))
            of = np.concatenate([some, each])
            nulls = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram[of]), pa.array(s1[of]), pa.array(s2[of]), batch.column("d").take(pa.array(row[of])),
                    pa.concat_arrays([pa.array(texts, pa.binary()), pa.nulls(len(each), pa.binary())]),
                    *[pa.concat_arrays([nulls, pa.array(x.astype(np.int64))]) for x in (nth, w1, w2)],
                ],
                names=["gram", "s1", "s2", "d", "words", "nth", "w1", "w2"],
            )

    return run


def _indexed(length: int):
    def run(table):
        """One shard: where each segment's windows stand in an earlier document's segment, as words from and to."""
        table = table.combine_chunks()
        words = Words(pa.concat_arrays(table.column("words").chunks).cast(pa.string()))
        hashes, count = words.hashes(), words.count
        gram, d = np.asarray(table.column("gram")), np.asarray(table.column("d"))
        order = np.lexsort((d, gram))
        g, e = gram[order], d[order]
        bucket = np.cumsum(np.append(False, g[1:] != g[:-1]))
        later = np.cumsum(np.append(False, (g[1:] != g[:-1]) | (e[1:] != e[:-1])))
        rank, group = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
        head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        rank[order], group[order] = later - later[head][bucket], bucket
        first, last = np.full(len(g), 1 << 40), np.full(len(g), -1)
        for bit in range(int(rank.max(initial=0)).bit_length()):
            near = group * (1 << 32) + (rank >> (bit + 1))
            late = (rank >> bit) & 1 == 1
            early = np.flatnonzero(~late & np.isin(near, near[late]))
            late = np.flatnonzero(late)
            # symbols are words within one group of ranks, so that no match crosses groups
            symbol = mix(hashes ^ mix(np.repeat(near, count).astype(np.uint64)))
            at = spread(words.first[early], count[early])
            kinds, dense = np.unique(symbol[at], return_inverse=True)
            text = np.zeros(len(at) + len(early), np.int64)
            text[np.arange(len(at)) + rows_of(count[early])] = dense + 1
            index = FMIndex(text, len(kinds) + 1, length)
            at = spread(words.first[late], count[late])
            place = np.minimum(np.searchsorted(kinds, symbol[at]), len(kinds) - 1)
            streamed = np.where(kinds[place] == symbol[at], place + 1, -1)
            begin = np.cumsum(count[late]) - count[late]
            low, high = matching_windows(index, streamed, begin, count[late] - length + 1, length)
            hit = low >= 0
            first[late[hit]] = np.minimum(first[late[hit]], low[hit])
            last[late[hit]] = np.maximum(last[late[hit]], high[hit])
        hit = pa.array(np.flatnonzero(last >= 0))
        return pa.table({
            **{k: table.column(k).take(hit) for k in ("gram", "s1", "s2")},
            "low": pa.array(first[last >= 0].astype(np.int32)), "high": pa.array((last[last >= 0] + length).astype(np.int32)),
        })

    return run


def covered(docs: DataFrame, length: int) -> DataFrame:
    """``docs``: ``d v text``.  Per text that loses words: ``d v spans`` (structs of words ``low`` to ``high``, may overlap)."""
    found = keep(docs.mapInArrow(_segmented(length), "d long, v long, gram long, start int, size int, s1 long, s2 long"), "segments")
    name = ["gram", "s1", "s2"]
    kinds = found.groupBy(*name).agg(F.min(F.struct("d", "v", "start", "size")).alias("o"), F.max("d").alias("last"))
    kinds = keep(kinds.select(*name, "o.*", "last"), "segment-kinds")
    variants = kinds.groupBy("gram").agg(F.count("*").alias("variants"))
    kinds = kinds.join(variants, "gram").where("variants > 1 or d < last").withColumn("crowd", F.col("variants") > CROWD)
    kinds = keep(kinds, "shared-kinds")

    differ = kinds.where("variants > 1")
    total = differ.where("not crowd").agg(F.sum(F.col("size") + (length - 1))).first()[0] or 0
    shards = -(-total // SHARD_WORDS) or 1
    asked = differ.groupBy("d", "v").agg(F.collect_list(F.struct(*name, "start", "size", "crowd")).alias("asked"))
    contents = docs.join(asked, ["d", "v"]).select("d", "text", "asked")
    contents = keep(contents.mapInArrow(_contents(length), "gram long, s1 long, s2 long, d long, words binary, nth long, w1 long, w2 long"), "contents")
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard")
    spans = contents.where("words is not null").select("gram", "s1", "s2", "d", "words", shard).groupBy("shard").applyInArrow(_indexed(length), "gram long, s1 long, s2 long, low int, high int")
    windows = contents.where("words is null").select(*name, "d", F.col("nth").cast("int").alias("nth"), "w1", "w2")
    earliest = keep(windows.groupBy("w1", "w2").agg(F.min("d").alias("least")), "window-kinds")
    late = windows.join(earliest, ["w1", "w2"]).where("d > least")
    crowded = late.groupBy(*name).agg(F.min("nth").alias("low"), (F.max("nth") + length).alias("high"))
    kinds = kinds.select(*name, F.col("d").alias("first")).join(spans.union(crowded), name, "left")
    kinds = keep(kinds, "covered-kinds")

    met = found.join(kinds, name)
    low = F.when(F.col("d") > F.col("first"), F.col("start")).otherwise(F.col("start") + F.col("low"))
    high = F.when(F.col("d") > F.col("first"), F.col("start") + F.col("size") + (length - 1)).otherwise(F.col("start") + F.col("high"))
    return met.select("d", "v", low.alias("low"), high.alias("high")).where("low is not null").groupBy("d", "v").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def _cut(batches):
    """Drops the covered words of each text and joins the rest by one space."""
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        spans = batch.column("spans")
        steps = np.zeros(len(words.start) + len(words.count) + 1, np.int32)
        flat, row = spans.flatten(), rows_of(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(spans), 0)))
        base = words.first[:-1][row]
        np.add.at(steps, base + np.asarray(flat.field("low")), 1)
        np.add.at(steps, base + np.asarray(flat.field("high")), -1)
        gone = np.cumsum(steps)[: len(words.start)] > 0
        removed = np.bincount(rows_of(words.count)[gone], minlength=batch.num_rows)
        data = words.data.tobytes()
        start, end = words.start.tolist(), words.end.tolist()
        stay = np.flatnonzero(~gone)
        ends = np.searchsorted(stay, words.first)
        stay = stay.tolist()
        kept = [b" ".join([data[start[w] : end[w]] for w in stay[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        rest = [c for c in batch.schema.names if c not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in rest], pa.array(words.count.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[*rest, "n_words", "n_removed", "kept"],
        )


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id n_words n_removed kept`` for every row of ``docs``.

    A word goes if a window of ``length`` consecutive words that covers it
    also starts in a document with a smaller id; windows are judged on the
    input.  ``kept`` is the other words joined by one space.

    Words are runs of bytes other than space and 0x09-0x0D, unchanged.  A
    null or blank text has no words and is kept as empty; a null id is
    before all others.  Rows that repeat an id are one document (a window
    never matches within it) and are each cut by their own text.  An empty
    table gives an empty result; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("v", F.xxhash64("text"))
    spans = covered(rows.select("d", "v", "text"), length)
    met = rows.join(spans, ["d", "v"], "left").select("doc_id", "text", "spans")
    return met.mapInArrow(_cut, f"doc_id {id_type}, n_words long, n_removed long, kept string")


by_value(__name__)
