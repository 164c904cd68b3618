"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's shingles are put in one global order, frequent ones last.  Two
sets of similarity t share at least l shingles among the first
``n - ceil(t n) + l`` of each (the l-prefix).  Every document picks its own
l: a longer prefix costs more postings but asks for more matches before a
pair is verified.  Of two prefixes the one that ends first in the order
holds every common shingle up to there, so a pair whose sets must share o
shingles must share o less the longer rest behind a prefix within the
prefixes; that is ``min(l, l')`` at least, and far more for sets of like
size.  So only the rarest of the shingles that a set shares with any other
are looked up, as many as leave room for l matches of those, and a pair that
meets in fewer than l of them is never verified.

Copies of one set are one class from the start.  Classes that agree with a
bucket's pivot are joined first, and the multi-match join then only looks at
pairs of classes that are not yet in one component.  All links lie within the
components so found.  Each component's classes are dealt into tiles, and a
task compares the whole sets of two tiles with one matrix product, so that
every link is counted (or listed, where asked for) without a row per pair.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.store import by_value, discard, keep, remove, shared_dir
from shelfwise.llm.words import Words, mix, rolled, rows_of, slices

#: Cells of the table of shingle frequencies, and of one row of it.
CELLS, BLOCK = 1 << 21, 1 << 14
#: Longest prefix extension tried, and the cost of verifying one candidate in postings read.
LONGEST, VERIFY = 4, 20
#: Rounds of linking to pivots before the exact join.
ROUNDS = 2
#: Classes of one shingle or component that meet in one task, and bytes of their texts; larger groups are dealt by a second key.
TILE, TILE_BYTES = 256, 1 << 23
#: Columns of 64 bits that hold a set's signature.
SIGNS = [f"s{k}" for k in range(8)]
#: Tasks that first add up the frequencies of one block of cells.
PARTS = 16


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, row after row, and their number.  A shorter row is one shingle."""
    hashes = words.hashes()
    grams, count = words.shingles(hashes, width)
    row = rows_of(count)
    for n in range(1, width):
        short = np.flatnonzero(words.count == n)
        grams = np.concatenate([grams, rolled(hashes, words.first[short], n)])
        row = np.concatenate([row, short])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[fresh], np.bincount(row[fresh], minlength=len(words.count))


def digests(grams: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each set, whatever its order: a 64-bit key and a 128-bit name."""
    ends = np.cumsum(count)
    out = np.zeros((len(count), 2), np.uint64)
    for k in range(2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams + np.uint64(k + 1)), dtype=np.uint64)])
        out[:, k] = mix(sums[ends] - sums[ends - count])
    names = pa.Array.from_buffers(pa.binary(16), len(out), [None, pa.py_buffer(out.tobytes())])
    return out[:, 0].view(np.int64).copy(), names.cast(pa.binary())


def _fold(width: int):
    def run(batches):
        """Per document its set's size and digest; per task the frequencies met, a block of cells a row."""
        cells = np.zeros(CELLS, np.uint32)
        for batch in slices(batches, "text"):
            grams, count = shingle_sets(Words(batch.column("text"), fold=True), width)
            cells += np.bincount((grams & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            key, name = digests(grams, count)
            none = pa.nulls(len(key), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(key), name, pa.nulls(len(key), pa.int32()), none, none],
                names=["doc_id", "n", "key", "c", "block", "cell", "often"],
            )
        blocks = _blocks(cells)
        none = pa.nulls(blocks.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.nulls(blocks.num_rows, pa.binary()), *blocks.columns], names=["doc_id", "n", "key", "c", *blocks.schema.names])

    return run


def _blocks(cells: np.ndarray) -> pa.RecordBatch:
    """The cells that are not zero, a block a row: ``block``, their places ``cell`` in it and their counts ``often``."""
    rows = []
    for block in range(CELLS // BLOCK):
        part = cells[block * BLOCK : (block + 1) * BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            rows.append((block, at.astype(np.uint16).tobytes(), np.minimum(part[at], 2**32 - 1).astype(np.uint32).tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["block", "cell", "often"])


def _add(batches):
    """The sum of a task's blocks."""
    cells = np.zeros(CELLS, np.uint64)
    for batch in batches:
        for block, cell, often in zip(batch.column("block").to_pylist(), batch.column("cell"), batch.column("often"), strict=True):
            cells[block * BLOCK + np.frombuffer(cell.as_buffer(), np.uint16).astype(np.int64)] += np.frombuffer(often.as_buffer(), np.uint32)
    yield _blocks(cells)


def _frequencies(folded: DataFrame) -> np.ndarray:
    """The table of all shingles' frequencies: CELLS counters, whatever the input.  Its blocks are added up in two rounds."""
    kind = "block int, cell binary, often binary"
    blocks = folded.where("block is not null").select("block", "cell", "often", F.floor(F.rand(0) * PARTS).alias("part"))
    blocks = blocks.repartition("block", "part").select("block", "cell", "often").mapInArrow(_add, kind)
    cells = np.zeros(CELLS, np.uint32)
    for row in blocks.repartition("block").mapInArrow(_add, kind).collect():
        cells[row.block * BLOCK + np.frombuffer(row.cell, np.uint16).astype(np.int64)] = np.frombuffer(row.often, np.uint32)
    return cells


def needed(n, t: int):
    """Smallest overlap that a set of n can have with any set it links to, for a threshold of t percent."""
    return -(-n * t // 100)


def _ordered(grams, count, cells):
    """Grams of each row by rising frequency; the frequencies."""
    often = cells[(grams & np.uint64(CELLS - 1)).astype(np.int64)]
    order = np.lexsort((grams, often, rows_of(count)))
    return grams[order], often[order].astype(np.float64)


def _prefixes(width: int, t: int, table):
    def run(batches):
        """The prefix of every set once per task: shingle, set key, and size, l and place in one number."""
        seen = np.zeros(0, np.int64)
        for batch in slices(batches, "text"):
            grams, count = shingle_sets(Words(batch.column("text"), fold=True), width)
            grams, often = _ordered(grams, count, table.value)
            key, _ = digests(grams, count)
            first = np.cumsum(count) - count
            sums = np.concatenate([[0.0], np.cumsum(often)])
            best, length = np.full(len(count), np.inf), np.ones(len(count), np.int64)
            for l in range(1, LONGEST + 1):
                size = np.minimum(count, count - needed(count, t) + l)
                read = sums[first + size] - sums[first]
                cost = np.where(needed(count, t) >= l, read * (1 + VERIFY / l), np.inf)
                length = np.where(cost < best, l, length)
                best = np.minimum(best, cost)
            size = np.minimum(count, count - needed(count, t) + length)
            new = np.zeros(len(key), bool)
            new[np.unique(key, return_index=True)[1]] = True
            new &= ~np.isin(key, seen)
            seen = np.concatenate([seen, key[new]])
            size = np.where(new, size, 0)
            row = rows_of(size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[first[row] + place].view(np.int64)), pa.array(key[row]), pa.array(place * 8 + length[row])],
                names=["gram", "key", "at"],
            )

    return run


def _shared(batches):
    """Of postings sorted by shingle and key: each once, and none whose shingle has only one key."""
    g, k, at, met = (np.zeros(0, np.int64) for _ in range(4))
    for batch in batches:
        g = np.concatenate([g, batch.column("gram").to_numpy()])
        k = np.concatenate([k, batch.column("key").to_numpy()])
        at = np.concatenate([at, batch.column("at").to_numpy()])
        met = np.concatenate([met, np.zeros(len(g) - len(met), np.int64)])
        fresh = np.ones(len(g), bool)
        fresh[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
        g, k, at, met = g[fresh], k[fresh], at[fresh], met[fresh]
        met[1:] |= g[1:] == g[:-1]
        out = met.astype(bool)
        out[:-1] |= g[1:] == g[:-1]
        out[-1:] = False
        yield pa.RecordBatch.from_arrays([pa.array(g[out]), pa.array(k[out]), pa.array(at[out])], names=["gram", "key", "at"])
        g, k, at, met = g[-1:], k[-1:], at[-1:], met[-1:]
    out = met.astype(bool)
    yield pa.RecordBatch.from_arrays([pa.array(g[out]), pa.array(k[out]), pa.array(at[out])], names=["gram", "key", "at"])


def cells_of(count: np.ndarray) -> np.ndarray:
    """Length of a set's profile: the power of two from half its size up, 16 at least."""
    return 1 << np.ceil(np.log2(np.maximum(count / 2, 16))).astype(np.int64)


def signatures(grams: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each set, whether the number of its shingles in each of 64 * len(SIGNS) cells is odd, a bit a cell.

    Shingles that two sets share leave equal bits in both, so no two sets
    differ in more bits than in shingles.
    """
    bit = (grams >> np.uint64(40)) % np.uint64(64 * len(SIGNS))
    out = np.zeros(len(count) * len(SIGNS), np.uint64)
    np.bitwise_xor.at(out, rows_of(count) * len(SIGNS) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(len(count), len(SIGNS)).view(np.int64)


def _profiled(width: int):
    def run(batches):
        """Each text with its set's name, signature and profile: how many shingles fall into each cell of the hash range (255: or more)."""
        for batch in slices(batches, "text"):
            grams, count = shingle_sets(Words(batch.column("text"), fold=True), width)
            size = cells_of(count)
            first = np.cumsum(size) - size
            row = rows_of(count)
            cell = first[row] + (grams & (size[row] - 1).astype(np.uint64)).astype(np.int64)
            profile = np.minimum(np.bincount(cell, minlength=int(size.sum())), 255).astype(np.uint8)
            signs = [pa.array(s) for s in np.ascontiguousarray(signatures(grams, count).T)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("f"), digests(grams, count)[1], *signs, pa.array([profile[x : x + m].tobytes() for x, m in zip(first, size, strict=True)], pa.binary()), batch.column("text")],
                names=["f", "c", *SIGNS, "profile", "text"],
            )

    return run


def _named(batch):
    """The rows whose names are those asked for (an id may come with several texts)."""
    return batch.filter(pa.compute.and_(pa.compute.equal(batch.column("a"), batch.column("ca")), pa.compute.equal(batch.column("b"), batch.column("cb"))))


def _possible(t: int):
    def run(batches):
        """Pairs whose profiles allow the overlap: the sum of the smaller counts bounds it."""
        for batch in map(_named, batches):
            keep_row = np.zeros(batch.num_rows, bool)
            for i, (x, y, n, m) in enumerate(zip(batch.column("x"), batch.column("y"), batch.column("na").to_numpy(), batch.column("nb").to_numpy(), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                full = bool((x == 255).any() or (y == 255).any())
                if len(x) != len(y):
                    small = min(len(x), len(y))
                    x, y = (v.reshape(-1, small).sum(axis=0) for v in (x, y))
                keep_row[i] = full or int(np.minimum(x, y).sum()) * (100 + t) >= t * int(n + m)
            yield batch.select(["a", "fa", "b", "fb"]).filter(pa.array(keep_row))

    return run


def _verified(width: int, t: int):
    def run(batches):
        """Pairs whose sets overlap enough: 100 |A and B| >= t |A or B|."""
        for batch in slices(map(_named, batches), "x", 1 << 20):
            x, nx = shingle_sets(Words(batch.column("x"), fold=True), width)
            y, ny = shingle_sets(Words(batch.column("y"), fold=True), width)
            grams, row = np.concatenate([x, y]), np.concatenate([rows_of(nx), rows_of(ny)])
            order = np.lexsort((grams, row))
            grams, row = grams[order], row[order]
            same = (grams[1:] == grams[:-1]) & (row[1:] == row[:-1])
            common = np.bincount(row[1:][same], minlength=batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array(100 * common >= t * (nx + ny - common)))

    return run


def _compared(width: int, t: int, each: bool):
    def run(key, table):
        """Two tiles of a component (or one with itself): all links between them, or for each class how many documents it links to."""
        c, side, size = table.column("c").to_pylist(), table.column("side").to_numpy(), table.column("size").to_numpy()
        grams, count = shingle_sets(Words(table.column("text").combine_chunks(), fold=True), width)
        row = rows_of(count)
        _, gram, met = np.unique(grams, return_inverse=True, return_counts=True)
        # shingles of one class only add nothing; the others are numbered anew
        row, gram = row[met[gram] > 1], (np.cumsum(met > 1) - 1)[gram[met[gram] > 1]]
        order = np.argsort(gram, kind="stable")
        row, gram = row[order], gram[order]
        common, wide = np.zeros((len(c), len(c))), max(256, (1 << 21) // len(c))
        for start in range(0, int(gram[-1]) + 1 if len(gram) else 0, wide):
            lo, hi = np.searchsorted(gram, [start, start + wide])
            has = np.zeros((len(c), wide), np.float32)
            has[row[lo:hi], gram[lo:hi] - start] = 1
            common += has @ has.T
        alike = 100 * common >= t * (count[:, None] + count[None, :] - common)
        np.fill_diagonal(alike, False)
        if key[1].as_py() != key[2].as_py():
            alike &= side[:, None] != side[None, :]
        if each:
            pairs = [(min(c[i], c[j]), max(c[i], c[j])) for i, j in zip(*np.nonzero(np.triu(alike)), strict=True)]
            return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})
        return pa.table({"c": pa.array(c, pa.binary()), "beside": pa.array((alike * size[None, :]).sum(axis=1).astype(np.int64))})

    return run


def _within(texts: DataFrame, classes: DataFrame, roots: DataFrame, width: int, percent: int, each: bool) -> DataFrame:
    """All links ``a b`` within the components ``roots``, or ``c beside``: with how many documents of other classes each class links.

    A class meets the other tiles of its component in one task each, and its
    own tile in another; no row stands for a pair.
    """
    grouped = classes.join(roots.withColumnRenamed("node", "c"), "c").select("c", "f", "size", "root")
    rows = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("f"), "text").join(grouped.select("f").distinct(), "f", "left_semi")
    named = rows.mapInArrow(_named_texts(width), "f long, name binary, text string")
    joined = named.join(grouped, (named["f"] == grouped["f"]) & (named["name"] == grouped["c"])).select("c", "size", "root", "text")
    # an id that repeats a text gives it once
    joined = keep(joined.groupBy("c").agg(F.first("size").alias("size"), F.first("root").alias("root"), F.min("text").alias("text")), "grouped")
    tiles = joined.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum(F.length("text")) / TILE_BYTES)).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int")
    dealt = joined.join(tiles, "root").withColumn("own", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "c", "size", F.col("own").alias("side"), "text")
    found = dealt.groupBy("root", "lo", "hi").applyInArrow(_compared(width, percent, each), "a binary, b binary" if each else "c binary, beside long")
    if not each:
        found = found.groupBy("c").agg(F.sum("beside").alias("beside"))
    found = keep(found, "within")
    discard(joined)
    return found


def _named_texts(width: int):
    def run(batches):
        """Each text with its set's name."""
        for batch in slices(batches, "text"):
            name = digests(*shingle_sets(Words(batch.column("text"), fold=True), width))[1]
            yield pa.RecordBatch.from_arrays([batch.column("f"), name, batch.column("text")], names=["f", "name", "text"])

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, every: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(classes, links, members)`` of the similarity join.

    ``members``: ``doc_id n c``, every row with its set's size and 128-bit
    name (null for an empty set).  ``classes``: ``c key f n size``, every
    distinct set with the smallest id ``f`` that holds it and the number of
    ids that do.  ``links``: all pairs ``a b`` of different classes that are
    similar, each once; without ``every``, enough verified pairs to connect
    every pair of linked classes.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    folded = keep(texts.mapInArrow(_fold(width), "doc_id long, n long, key long, c binary, block int, cell binary, often binary"), "folded")
    table = spark.sparkContext.broadcast(_frequencies(folded))
    members = keep(folded.where("block is null").select("doc_id", "n", F.when(F.col("n") > 0, F.col("c")).alias("c"), "key"), "members")
    discard(folded)

    at = F.coalesce("doc_id", F.lit(NO_ID))
    sets = members.where("n > 0").select("c", "key", "n", at.alias("at")).distinct()
    classes = keep(sets.groupBy("c", "key").agg(F.min("at").alias("f"), F.max("n").alias("n"), F.count("*").alias("size")), "classes")
    found = texts.mapInArrow(_prefixes(width, percent, table), "gram long, key long, at long")
    found = found.repartition("gram").sortWithinPartitions("gram", "key").mapInArrow(_shared, "gram long, key long, at long")
    found = found.join(classes, "key").select("gram", "c", "f", "n", (F.col("at") % 8).alias("l"), F.floor(F.col("at") / 8).alias("place"))
    found = keep(found, "postings-all")
    table.unpersist()
    # m: how many prefix shingles a class shares with any other; rank: this one's place among
    # them; rest: what lies behind the prefix (a class has no more rows than its prefix is long)
    own = Window.partitionBy("c")
    rest = F.greatest(needed_col(F.col("n"), percent) - F.col("l"), F.lit(0))
    postings = keep(found.select("*", F.count("*").over(own).alias("m"), F.row_number().over(own.orderBy("place")).alias("rank"), rest.alias("rest")), "postings")
    discard(found)

    # texts of classes that share a prefix shingle, in buckets by id: joining pairs to them moves the pairs only
    active = postings.select("f").distinct()
    rows = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("f"), "text").join(active, "f", "left_semi")
    name = f"active_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_dir(spark)}/llm/{name}"
    signs = ", ".join(f"{s} long" for s in SIGNS)
    rows = rows.mapInArrow(_profiled(width), f"f long, c binary, {signs}, profile binary, text string").write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "f")
    rows.option("compression", "zstd").option("path", folder).saveAsTable(name)
    rows = spark.table(name)

    def meet(pairs: DataFrame, column: str) -> DataFrame:
        for k, v in (("a", "x"), ("b", "y")):
            pairs = pairs.join(rows.select(F.col("f").alias(f"f{k}"), F.col("c").alias(f"c{k}"), F.col(column).alias(v)), f"f{k}")
        return pairs

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        """Of pairs ``a fa na b fb nb``, those that link."""
        pairs = meet(pairs, "profile").mapInArrow(_possible(percent), "a binary, fa long, b binary, fb long")
        possible = keep(pairs, name + "-possible")
        met = meet(possible, "text").select("a", "b", "ca", "cb", "x", "y")
        linked = keep(met.mapInArrow(_verified(width, percent), "a binary, b binary"), name)
        discard(possible)
        return linked

    links, roots = [], None
    for turn in range(ROUNDS):
        rooted = _rooted(postings, roots)
        # the pivot of a bucket: the class that shares most, such as the text that the
        # others are copies of; in later rounds a pseudo-random one
        pivot = rooted.groupBy("gram").agg(F.min(F.struct((-F.col("m") if turn == 0 else F.lit(0)).alias("o"), F.xxhash64("c", F.lit(turn)).alias("h"), "c", "f", "n", "m", "rest", "root")).alias("p"))
        pairs = rooted.join(pivot, "gram").where((F.col("root") != F.col("p.root")) & _sizes(F.col("n"), F.col("p.n"), percent))
        pairs = pairs.where(F.least("m", "p.m") >= matches(F.col("n"), F.col("rest"), F.col("p.n"), F.col("p.rest"), percent))
        pairs = pairs.select(F.col("c").alias("a"), F.col("f").alias("fa"), F.col("p.c").alias("b"), F.col("p.f").alias("fb"), F.col("n").alias("na"), F.col("p.n").alias("nb")).distinct()
        links.append(verify(pairs, "pivot-links"))
        before, roots = roots, keep(components(reduce(DataFrame.union, links)), "roots")
        discard(before)
    rooted = _rooted(postings, roots)
    mixed = rooted.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("gram")
    signed = rows.select("f", "c", *SIGNS).dropDuplicates(["f", "c"])
    opened = keep(rooted.join(mixed, "gram", "left_semi").join(signed, ["f", "c"]), "open")
    discard(postings, roots)
    # a crowded bucket is dealt: each class on one side to one of its tiles, on the other to all of them
    crowded = keep(opened.groupBy("gram").count().where(F.col("count") > TILE).select("gram", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "crowded")
    met = _met(opened.join(crowded, "gram", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))), percent)
    pairs = met.groupBy("c1", "f1", "n1", "c2", "f2", "n2").agg(F.count("*").alias("met"), F.max("l").alias("l")).where("met >= l").drop("met", "l")
    links.append(verify(pairs.toDF("a", "fa", "na", "b", "fb", "nb"), "exact-links"))
    discard(opened, crowded)
    spark.sql(f"DROP TABLE {name}")
    remove(spark, folder)
    links = reduce(DataFrame.union, links)
    if every:
        links = _within(texts, classes, keep(components(links), "components"), width, percent, True)
    return classes, links, members


#: Stands for a null id: below all others.
NO_ID = -(1 << 63)


def _rooted(postings: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return postings.withColumn("root", F.col("c"))
    return postings.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))


def _met(rooted: DataFrame, percent: int) -> DataFrame:
    """A row for each open shingle in which two classes of different components meet, as far as they can be similar; ``l``: how many must match."""
    tile = {1: F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int"), 2: F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))}
    x, y = (rooted.select("gram", tile[i].alias("tile"), *[F.col(k).alias(f"{k}{i}") for k in ("c", "f", "n", "l", "m", "rank", "rest", "place", "root", *SIGNS)]) for i in (1, 2))
    # what can still be shared: the places before this shingle, itself, and the rest of the shorter set
    most = F.least("place1", "place2") + 1 + F.least(F.col("n1") - F.col("place1") - 1, F.col("n2") - F.col("place2") - 1)
    enough = most * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent
    # of the shingles that two classes must share within their prefixes, the first l stand
    # among the first m - least + l that each shares with any class: so many must match
    least = F.greatest(matches(F.col("n1"), F.col("rest1"), F.col("n2"), F.col("rest2"), percent), F.lit(1))
    l = F.least("l1", "l2", least)
    early = (F.col("rank1") <= F.col("m1") - least + l) & (F.col("rank2") <= F.col("m2") - least + l)
    return x.join(y, ["gram", "tile"]).where((F.col("root1") < F.col("root2")) & _sizes(F.col("n1"), F.col("n2"), percent) & (F.least("m1", "m2") >= least) & early & enough & _near(percent)).withColumn("l", l)


def _near(t: int):
    """Whether the signatures leave room for a link: what differs in one of them is not shared."""
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{s}1").bitwiseXOR(F.col(f"{s}2"))) for s in SIGNS))
    both = F.col("n1") + F.col("n2")
    return (both - differ) * (100 + t) >= both * (2 * t)


def needed_col(n, t: int):
    return F.ceil(n * t / 100).cast("int")


def matches(n, rest_n, m, rest_m, t: int):
    """Prefix shingles that two linked sets of n and m share at least."""
    overlap = F.ceil((n + m) * t / (100 + t))
    return overlap - F.greatest(rest_n, rest_m)


def _sizes(n, m, t: int):
    return (n * 100 >= m * t) & (m * 100 >= n * t)


def similarity_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, every: bool = True
) -> DataFrame:
    """``doc_id n_shingles component_id n_links`` for every row of ``docs``; ``n_links`` only with ``every``.

    Words are runs of other bytes than space and 0x09-0x0D, A-Z folded; a
    document's set holds its distinct shingles of ``width`` words (a shorter
    text is one shingle).  Documents link when 100 times the intersection is
    at least ``percent`` times the union; a component's id is the smallest
    document id in it.  ``n_links``: how many other documents this row links
    to, copies of its set and of the sets like it included; a document is an
    id with one set.

    Nulls: a null or blank text has an empty set, links with nothing and is
    its own component.  A null id counts below all others and comes back as
    null.  Rows that repeat an id with one text are one document; with
    different texts, each row links by its own text.  An empty table gives
    an empty result.
    """
    classes, links, members = similar_classes(docs, id_col, text_col, width, percent, False)
    roots = keep(components(links), "components")
    rooted = classes.select("c", "f").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = rooted.groupBy("root").agg(F.min("f").alias("component"))
    rooted = rooted.join(least, "root").select(F.col("c").alias("name"), "component")
    if every:
        beside = _within(_texts(docs, id_col, text_col), classes, roots, width, percent, False).withColumnRenamed("c", "name")
        own = classes.select(F.col("c").alias("name"), "size").join(beside, "name", "left")
        own = own.select("name", (F.col("size") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"))
        rooted = rooted.join(own, "name")
    out = members.join(rooted, members["c"] == rooted["name"], "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).when(F.col("component") != NO_ID, F.col("component"))
    linked = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if every else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), *linked)


def _with_name(width: int):
    def run(batches):
        """Each row with the 128-bit name of its set, null for an empty set."""
        for batch in slices(batches, "text"):
            sets = shingle_sets(Words(batch.column("text"), fold=True), width)
            names = digests(*sets)[1]
            names = pa.compute.if_else(pa.array(np.asarray(sets[1]) > 0), names, pa.nulls(batch.num_rows, names.type))
            yield pa.RecordBatch.from_arrays([*batch.columns, names], names=[*batch.schema.names, "__name"])

    return run


def drop_similar(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (``doc_id text`` and others) with one row of each group of linked rows.

    Rows are judged by their own texts, also where they share an id or have
    none.  The row with the smallest id stays, a null id below all others;
    among several of one id the one whose set's name is smallest, and of
    equal sets the text with the smallest digest.  Null and blank texts link with
    nothing: of those only rows that repeat an id and its text go.  An empty
    table gives an empty result.
    """
    classes, links, _ = similar_classes(docs, width=width, percent=percent, every=False)
    roots = keep(components(links), "components")
    rooted = classes.select("c", "f").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    first = rooted.groupBy("root").agg(F.min(F.struct("f", "c")).alias("first")).select(F.col("first.f").alias("__f"), F.col("first.c").alias("__c"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["__name binary"])
    rows = docs.mapInArrow(_with_name(width), schema)
    own = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("__f")) & (F.col("__name") == F.col("__c"))
    worded = rows.where("__name is not null").join(first, own, "left_semi")
    rows = worded.union(rows.where("__name is null")).withColumn("__text", F.md5(F.coalesce("text", F.lit(""))))
    alike = Window.partitionBy("doc_id", F.coalesce(F.hex("__name"), "__text"), F.when(F.col("__name").isNull(), F.col("text").isNull()))
    return rows.withColumn("__nth", F.row_number().over(alike.orderBy("__text"))).where("__nth = 1").drop("__nth", "__text", "__name")


by_value(__name__)
