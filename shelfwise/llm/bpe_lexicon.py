"""Byte-pair encoding through a lexicon of frequent words, and decoding.

The words of the corpus are counted by Spark; the most frequent ones are
merged once and compiled into a minimal acyclic transducer: words share
prefixes and suffixes, and the numbers along a word's way add up to its
place in the table of id sequences.  The transducer is one file in the
shared folder, which Spark hands to the executors and every task maps into
memory.  Distinct words of a slice of texts walk it all at once; words it
does not hold are merged exactly, so it decides on cost alone.

A word is what stands between ASCII blanks, as it is written; the vocabulary
never joins across them.  The vocabulary file is the JSON of a word-level
BPE: within a word special tokens are cut out, the rest is put in NFC and
lower case and cut into pieces by a pattern, and a piece's bytes are merged,
the last one with a suffix.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep, shared_dir
from shelfwise.llm.words import raw, slices, spread

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Words in the lexicon, and the longest one in bytes; all others are merged where they occur.
LEXICON = 131_072
LONGEST = 64
#: Bytes up to which pieces are merged all at once; longer ones take a heap each.
SHORT = 64
#: Above all ranks and all ids.
NEVER = WIDE = 1 << 31
#: Bytes of text, or of ids, that a task codes at once; a single longer text is taken whole.
SLICE = 1 << 20
#: Distinct words that a task counts before it hands them on.
HELD = 200_000

# What the vocabulary's tokenizer knows of Unicode beyond version 15.1, whose tables Python has.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LOWER_17 = {
    0x03A3: 0x03C3,  # a sigma at a word's end as well
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
SPACES = "".join(f"\\U{c:08x}" for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def _class(kind: str, more: tuple) -> str:
    """A character class's inside: all characters of a general category, by Python's tables and ``more``."""
    spans = list(more)
    low = None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == kind
        if inside and low is None:
            low = c
        elif not inside and low is not None:
            spans.append((low, c - 1))
            low = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in sorted(spans))


class Coder:
    """The vocabulary: what a text's words are, and how a word's bytes are merged."""

    def __init__(self, tokens: dict[str, int], merges: list, special: dict[str, int], suffix: str):
        self.special, self.suffix = special, suffix
        self.tokens = {i: t for t, i in (tokens | special).items()}
        # printable stand-ins of bytes: those that are printable themselves, the others from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        stands = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.inner = [tokens[stands[b]] for b in range(256)]
        self.final = [tokens[stands[b] + suffix] for b in range(256)]
        self.made = np.array([tokens[a + b] for a, b in merges], np.int64)
        if len(np.unique(self.made)) < len(merges):
            raise ValueError("a token with two merges: the order of merging would be ambiguous")
        pairs = np.array([tokens[a] * WIDE + tokens[b] for a, b in merges], np.int64)
        self.order = np.argsort(pairs)  # the rank of each pair
        self.pairs = pairs[self.order]
        letters, numbers = _class("L", LETTERS_16), _class("N", NUMBERS_16)
        self.pattern = f"{ENDINGS}|[{letters}]+|[{numbers}]|[^{SPACES}{letters}{numbers}]+"

    @staticmethod
    def from_file(path: str = VOCABULARY) -> "Coder":
        """Reads the vocabulary file on the driver."""
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
        model = known["model"]
        return Coder(model["vocab"], model["merges"], {t["content"]: t["id"] for t in known["added_tokens"]}, model["end_of_word_suffix"])

    def pieces(self):
        """A function from a word between blanks to its pieces; a special token is a piece."""
        split = re.compile(self.pattern).findall
        special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        def plain(text: str) -> list[str]:
            text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).translate(LOWER_17).lower()
            return [text] if text.isalpha() else split(text)  # letters of any alphabet are one piece

        def pieces(word: bytes) -> list[str]:
            text = word.decode()
            if special is None or not special.search(text):
                return plain(text)
            return [x for i, part in enumerate(special.split(text)) for x in ([part] if i % 2 else plain(part))]

        return pieces

    def code(self, words: list[bytes], pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        parts = [pieces(w) for w in words]
        place: dict[str, int] = {}
        at = np.array([place.setdefault(p, len(place)) for part in parts for p in part], np.int64)
        many = np.fromiter(map(len, parts), np.int64, len(parts))
        ids, size = self.merge([self.special.get(p, p.encode()) for p in place])
        flat = ids[spread((np.cumsum(size) - size)[at], size[at])]
        ends = np.concatenate([[0], np.cumsum(size[at])])[np.concatenate([[0], np.cumsum(many)])]
        return flat, np.diff(ends)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the list of merges, or NEVER."""
        pair = left * WIDE + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.order[at], NEVER)

    def merge(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces (bytes, or the id of a special token), one after the other, and how many each has.

        Of a piece's neighbours, the pair earliest in the list of merges is
        merged first, the leftmost of them first.  All pieces take a step at
        once; those with nothing left to merge drop out.
        """
        symbols = [np.array([p], np.int64) if isinstance(p, int) else None for p in pieces]
        for i, p in enumerate(pieces):
            if symbols[i] is None and len(p) > SHORT:
                symbols[i] = np.array(self._merge_long(p), np.int64)
        size = np.array([len(pieces[i]) if s is None else len(s) for i, s in enumerate(symbols)], np.int64)
        out = np.full(int(size.sum()), -1, np.int64)
        start = np.cumsum(size) - size
        for i, s in enumerate(symbols):
            if s is not None:
                out[start[i] : start[i] + len(s)] = s
        open_ = np.array([i for i, s in enumerate(symbols) if s is None], np.int64)
        data = np.frombuffer(b"".join([pieces[i] for i in open_.tolist()]), np.uint8)
        owner = np.repeat(open_, size[open_])
        last = np.ones(len(owner), bool)
        last[:-1] = owner[1:] != owner[:-1]
        symbol = np.where(last, np.array(self.final)[data], np.array(self.inner)[data])
        rank = np.full(len(owner), NEVER, np.int64)
        inside = np.flatnonzero(~last)
        rank[inside] = self.rank(symbol[inside], symbol[inside + 1])
        while len(owner):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.concatenate([first, [len(owner)]]))
            least = np.minimum.reduceat(rank, first)
            done = np.repeat(least == NEVER, count)
            if done.any():
                ended = owner[first[least == NEVER]]
                out[spread(start[ended], count[least == NEVER])] = symbol[done]
                size[ended] = count[least == NEVER]
                owner, symbol, rank = owner[~done], symbol[~done], rank[~done]
                least, count = least[least != NEVER], count[least != NEVER]
            if not len(owner):
                break
            at = np.flatnonzero(rank == np.repeat(least, count))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            symbol[at] = self.made[least]
            stay = np.ones(len(owner), bool)
            stay[at + 1] = False
            owner, symbol, rank, at = owner[stay], symbol[stay], rank[stay], at - np.arange(len(at))
            for x in (at, at - 1):
                x = x[x >= 0]
                rank[x] = NEVER
                x = x[x + 1 < len(owner)]
                x = x[owner[x] == owner[x + 1]]
                rank[x] = self.rank(symbol[x], symbol[x + 1])
        kept = spread(start, size)
        return out[kept], size

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs, for pieces of any length."""
        symbols = [self.inner[b] for b in piece[:-1]] + [self.final[piece[-1]]]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.rank(np.array(symbols[:-1]), np.array(symbols[1:])).tolist()
        heap = [(rank, i, symbols[i], symbols[i + 1]) for i, rank in enumerate(ranks) if rank != NEVER]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            rank = int(self.rank(np.array([symbols[i]]), np.array([symbols[j]]))[0])
            if rank != NEVER:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return [s for s in symbols if s >= 0]


# --- transducer -------------------------------------------------------------------


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """The transducer of ``(word, ids)``: a header and tables of 4-byte numbers.

    Words are added in order.  The nodes behind the prefix that a word
    shares with the next are final, and one that equals an earlier node
    (end of a word or not, same steps) is replaced by it.
    """
    entries = sorted(entries)
    register: dict = {}
    nodes: list = []  # (ends a word, ((byte, node), ...)) by number
    below: list[int] = []  # words behind each node, itself included

    def settle(ends: bool, steps: list) -> int:
        node = (ends, tuple(steps))
        number = register.get(node)
        if number is None:
            number = register[node] = len(nodes)
            nodes.append(node)
            below.append(ends + sum(below[child] for _, child in steps))
        return number

    way: list = [[False, []]]  # open nodes of the last word, root first
    last = b""

    def close(depth: int) -> None:
        while len(way) > depth + 1:
            ends, steps = way.pop()
            way[-1][1].append((last[len(way) - 1], settle(ends, steps)))

    for word, _ in entries:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        way += [[False, []] for _ in word[shared:]]
        way[-1][0] = True
        last = word
    close(0)
    root = settle(*way[0])

    keys, targets, adds = [], [], []
    for number, (ends, steps) in enumerate(nodes):
        at = int(ends)
        for byte, child in steps:
            keys.append(number * 256 + byte)
            targets.append(child)
            adds.append(at)
            at += below[child]
    ends_at = np.cumsum([0, *(len(ids) for _, ids in entries)])
    flat = [i for _, ids in entries for i in ids]
    tables = [keys, targets, adds, [int(ends) for ends, _ in nodes], ends_at, flat]
    header = [root, *map(len, tables)]
    return np.concatenate([np.asarray(t, np.int32) for t in (header, *tables)]).tobytes()


class Lexicon:
    """A compiled transducer, mapped into memory."""

    def __init__(self, path: str):
        table = np.memmap(path, np.int32, "r")
        self.root, sizes = int(table[0]), table[1:7]
        cuts = 7 + np.concatenate([[0], np.cumsum(sizes)])
        self.keys, self.targets, self.adds, self.ends, self.at, self.ids = (table[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1; all walk together, byte after byte."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        number = np.zeros(len(words), np.int64)
        state = np.full(len(words), self.root, np.int64)
        walking = np.flatnonzero(size <= LONGEST)
        lost = np.ones(len(words), bool)
        lost[walking] = False
        for j in range(LONGEST):
            walking = walking[size[walking] > j]
            if not len(walking) or not len(self.keys):
                break
            key = state[walking] * 256 + data[start[walking] + j]
            at = np.minimum(np.searchsorted(self.keys, key.astype(np.int32)), len(self.keys) - 1)
            on = self.keys[at] == key
            lost[walking[~on]] = True
            walking, at = walking[on], at[on]
            number[walking] += self.adds[at]
            state[walking] = self.targets[at]
        found = ~lost & (self.ends[state] == 1)
        return np.where(found, number, -1)


# --- Spark ------------------------------------------------------------------------


def _count(batches) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush():
        rows = [(w, n) for w, n in seen.items() if len(w) <= LONGEST]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"])

    for batch in slices(batches, "text"):
        data, offsets = raw(batch.column("text"))
        data, offsets = data.tobytes(), offsets.tolist()
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            seen.update(data[a:b].split())
            if len(seen) > HELD:
                yield flush()
                seen.clear()
    yield flush()


def build_lexicon(texts: DataFrame, coder: Coder, size: int = LEXICON) -> str:
    """Compiles the most frequent words of ``text``, at most ``size``, and hands the file to all executors; returns its name.

    The file is bounded by ``size`` words of LONGEST bytes, whatever the input.
    """
    spark = texts.sparkSession
    counts = texts.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = keep(counts, "word-counts")
    # as many of the steps of frequency, a few hundred, as leave room for their words
    steps = counts.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, room = None, size
    for step in sorted(steps, key=lambda r: -r["step"]):
        room -= step["words"]
        if room < 0:
            break
        least = step["least"]
    frequent = counts.where(F.col("n") >= least).select("word").collect() if least is not None else []
    words = [bytes(r["word"]) for r in frequent]
    ids, sizes = coder.code(words, coder.pieces())
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    out.write(bytearray(compile_lexicon([(w, ids[a:b].tolist()) for w, a, b in zip(words, ends[:-1], ends[1:], strict=True)])))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def _encode(sent, name: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(SparkFiles.get(name))
        coder = sent.value
        pieces = coder.pieces()
        for batch in slices(batches, "text", SLICE):
            data, offsets = raw(batch.column("text"))
            data, offsets = data.tobytes(), offsets.tolist()
            words: list[bytes] = []
            ends = [0]
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                words += data[a:b].split()  # at space and 0x09-0x0D
                ends.append(len(words))
            distinct = list(dict.fromkeys(words))
            number = lexicon.find(distinct)
            start = np.where(number >= 0, lexicon.at[np.maximum(number, 0)], 0).astype(np.int64)
            size = np.where(number >= 0, lexicon.at[np.minimum(number + 1, len(lexicon.at) - 1)] - start, 0).astype(np.int64)
            unseen = np.flatnonzero(number < 0)
            own, size[unseen] = coder.code([distinct[i] for i in unseen.tolist()], pieces)
            start[unseen] = len(lexicon.ids) + np.cumsum(size[unseen]) - size[unseen]
            flat = np.concatenate([lexicon.ids, own])
            place = dict(zip(distinct, range(len(distinct)), strict=True))
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            ids = flat[spread(start[at], size[at])].astype("<u4")
            bounds = 4 * np.concatenate([[0], np.cumsum(size[at])])[ends]
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], packed.cast(pa.binary())], names=[*rest, "ids"])

    return run


def encode(docs: DataFrame, coder: Coder, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON) -> DataFrame:
    """``doc_id ids`` for every row of ``docs``: token ids of the whole text, packed as little-endian unsigned 32-bit numbers.

    The result does not depend on ``lexicon_words``.  Special tokens in a
    text become their ids; none are added.

    A null or empty text, and one without words, has no ids (an empty
    binary).  Rows are coded each for itself, so repeated rows and null ids
    come back as they are.  An empty table gives an empty result; other
    columns are not read.

    Words are counted with sums inside the tasks first, so a word that
    makes up a third of the corpus is a row a task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(coder)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    name = build_lexicon(rows, coder, lexicon_words)
    return rows.mapInArrow(_encode(sent, name), f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids binary")


def _decode(sent, column: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        tokens = sent.value.tokens
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(whole.schema.get_field_index(column))), 0)
            # as many rows at a time as hold about SLICE bytes of ids, one at least
            parts = np.cumsum(np.asarray(sizes, np.int64)) // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), whole.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                batch = whole.slice(a, b - a)
                packed = batch.column(batch.schema.get_field_index(column))
                texts = [" ".join([tokens[i] for i in np.frombuffer(ids.as_py() or b"", "<u4").tolist() if i in tokens]) for ids in packed]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def decode(rows: DataFrame, coder: Coder, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the tokens of the packed ids joined by one space, special ones included, as the vocabulary names no decoder.

    Null or empty ids decode to an empty text; ids that the vocabulary does
    not hold are left out.  A column named ``decoded`` is replaced.
    """
    rows = rows.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    sent = rows.sparkSession.sparkContext.broadcast(coder)
    return rows.mapInArrow(_decode(sent, ids_col), f"{schema}, decoded string")


by_value(__name__)
