"""Language ID by unigram pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public
vocabulary.  A word's probability is the sum, over all ways to cut it into
pieces, of the product of their probabilities; a forward pass over the
word's bytes computes it, for all languages and many words at once.  The
vocabulary holds every single byte, so every word has a segmentation.  Words
are taken whole, however long, with all pieces of the vocabulary: where a
sum becomes small it is scaled up, and the scale kept as a logarithm.

Learning is expectation maximisation: a forward and a backward pass give
each piece's expected count in the words of each language, starting from
equal probabilities.  Counts are added up over all training documents by
Spark; the model has one number per language and piece.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value
from shelfwise.llm.words import Words, mix, rows_of, slices, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Added to every expected count.
PRIOR = 0.02
#: Words, bytes of words, and numbers of a forward pass worked on at once; one longer word is taken whole.
BLOCK_WORDS, BLOCK_BYTES, BLOCK_NUMBERS = 20_000, 400_000, 1 << 24
#: Sums below this are scaled up.
SMALL = 1e-100
#: Words of more bytes are told apart by a digest of the whole.
LONG_WORD = 64
UNDEFINED = "und"


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces in lower case, each once, and all single bytes."""
    pieces = set()
    with open(path, "rb") as file:
        for line in file:
            pieces.add(base64.b64decode(line.split()[0]).lower())
    return sorted(pieces | {bytes([b]) for b in range(256)})


def hashed(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """An open-addressed table of the pieces: hashes and piece numbers; the longest piece's bytes."""
    size = 1 << (len(pieces) * 4 - 1).bit_length()
    keys, values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
    for i, piece in enumerate(pieces):
        h = piece_hash(np.frombuffer(piece, np.uint8)[None, :])[0]
        at = int(h) & (size - 1)
        while values[at] >= 0:
            at = (at + 1) & (size - 1)
        keys[at], values[at] = h, i
    return keys, values, max(map(len, pieces))


def piece_hash(rows: np.ndarray) -> np.ndarray:
    total = np.zeros(rows.shape[0], np.uint64)
    for j in range(rows.shape[1]):
        total = step(total, rows[:, j])
    return mix(total)


def step(total: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return total * np.uint64(0x100000001B3) + byte.astype(np.uint64) + np.uint64(1)


def find(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Piece numbers of the hashes; -1 where there is none."""
    mask = np.uint64(len(keys) - 1)
    at = (h & mask).astype(np.int64)
    out = np.full(len(h), -1, np.int32)
    todo = np.arange(len(h))
    while len(todo):
        v = values[at]
        hit = keys[at] == h[todo]
        out[todo] = np.where(hit, v, -1)
        go = ~hit & (v >= 0)
        todo, at = todo[go], (at[go] + 1) & int(mask)
    return out


class Runs:
    """Distinct words (after a blank) with all pieces that fit at each place."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]):
        self.n, self.size = len(start), size
        width = int(size.max(initial=0))
        grid = np.zeros((self.n, width), np.uint8)
        row = rows_of(size)
        place = spread(np.zeros(self.n, np.int64), size)
        grid[row, place] = data[start[row] + place]
        #: at[j]: of each length k + 1 that has a piece at place j of any word, the words and their pieces
        self.at: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(width)]
        total = np.zeros((self.n, width), np.uint64)
        for k in range(min(table[2], width)):
            part = total[:, : width - k] * np.uint64(0x100000001B3) + grid[:, k:].astype(np.uint64) + np.uint64(1)
            total = part
            inside = np.arange(width - k)[None, :] + k < size[:, None]
            found = np.full(part.shape, -1, np.int32)
            found[inside] = find(*table[:2], mix(part[inside]))
            place, word = np.nonzero(found.T >= 0)
            piece = found[word, place].astype(np.int64)
            edge = np.searchsorted(place, np.arange(width - k + 1))
            for j in np.flatnonzero(np.diff(edge)):
                some = slice(edge[j], edge[j + 1])
                self.at[j].append((k, word[some], piece[some]))
        self.width = width
        #: sums reach at most this many places ahead
        self.reach = min(table[2], width) + 1

    def forward(self, p: np.ndarray) -> np.ndarray:
        """The log-probability of each word in each language, over all its segmentations.

        ``ahead`` holds the sums of the next places, times exp(-scale).
        """
        ahead = np.zeros((self.reach, self.n, p.shape[1]))
        ahead[0] = 1.0
        scale = np.zeros(ahead.shape[1:])
        out = np.zeros(scale.shape)
        ends = self._ends()
        for j in range(self.width + 1):
            here = ahead[j % self.reach]
            done = ends.get(j)
            if done is not None:
                out[done] = np.log(here[done]) + scale[done]
            if j == self.width:
                return out
            low = (here < SMALL) & (here > 0)
            if low.any():
                by = np.where(low, here, 1.0)
                ahead /= by
                scale += np.log(by)
            for k, some, piece in self.at[j]:
                ahead[(j + k + 1) % self.reach, some] += here[some] * p[piece]
            here[:] = 0.0
        return out

    def expected(self, p: np.ndarray, lang: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected count of each piece in each language, for words of language ``lang`` seen ``counts`` times."""
        langs, every = p.shape[1], np.arange(self.n)
        flat = p.ravel()
        edges = []
        alpha = np.zeros((self.width + 1, self.n))
        alpha[0] = 1.0
        #: the logarithm by which each place's sums are scaled; None while none is
        scales = None
        for j in range(self.width):
            low = (alpha[j] < SMALL) & (alpha[j] > 0)
            if low.any():
                if scales is None:
                    scales = np.zeros(alpha.shape)
                by = np.where(low, alpha[j], 1.0)
                alpha[j : j + self.reach] /= by
                scales[j] += np.log(by)
            if scales is not None:
                scales[j + 1] = scales[j]
            for k, some, piece in self.at[j]:
                which = piece * langs + lang[some]
                chance = flat[which]
                alpha[j + k + 1, some] += alpha[j, some] * chance
                edges.append((j, k, some, which, chance))
        # what follows a place, in the same scale, over the whole word's probability
        beta = np.zeros_like(alpha)
        beta[self.size, every] = counts / alpha[self.size, every]
        shares = []
        for j, k, some, _, chance in reversed(edges):
            part = chance * beta[j + k + 1, some]
            if scales is not None:
                part *= np.exp(scales[j, some] - scales[j + k + 1, some])
            beta[j, some] += part
            shares.append(part * alpha[j, some])
        if not edges:
            return np.zeros(p.shape)
        which = np.concatenate([e[3] for e in reversed(edges)])
        return np.bincount(which, np.concatenate(shares), minlength=p.size).reshape(p.shape)

    def _ends(self) -> dict[int, np.ndarray]:
        order = np.argsort(self.size, kind="stable")
        sizes, first = np.unique(self.size[order], return_index=True)
        return dict(zip(sizes.tolist(), np.split(order, first[1:]), strict=True))


def cut_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a blank before each word, and start, size and row of every word."""
    size = words.end - words.start
    ends = np.cumsum(size + 1)
    data = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    begin = ends - size - 1
    data[spread(begin + 1, size)] = words.data[spread(words.start, size)]
    return data, begin, size + 1, rows_of(words.count)


def distinct_runs(data, start, size, lang=None):
    """One word of every kind, and the kind of each word; words of different languages differ."""
    total = np.zeros(len(start), np.uint64)
    for j in range(min(int(size.max(initial=0)), LONG_WORD)):
        more = np.flatnonzero(size > j) if j else slice(None)
        total[more] = step(total[more], data[start[more] + j])
    for i in np.flatnonzero(size > LONG_WORD):
        total[i] = int.from_bytes(blake2b(data[start[i] : start[i] + size[i]].tobytes(), digest_size=8).digest(), "little")
    total = mix(total ^ mix(size.astype(np.uint64)))
    if lang is not None:
        total = mix(total + lang.astype(np.uint64) + np.uint64(1))
    _, one, kind = np.unique(total, return_index=True, return_inverse=True)
    return one, kind


def _count(langs: list[str], pieces, p):
    def run(batches):
        """Expected counts of this task's training words, a row per language and piece."""
        table, prob = _table(tuple(pieces.value)), p.value
        total = np.zeros(prob.shape)
        for batch in slices(batches, "text"):
            data, start, size, row = cut_words(Words(batch.column("text"), fold=True))
            if not len(start):
                continue
            number = {x: k for k, x in enumerate(langs)}
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()])[row]
            one, kind = distinct_runs(data, start, size, lang)
            seen = np.bincount(kind, minlength=len(one)).astype(float)
            for some in _blocks(size[one]):
                runs = Runs(data, start[one[some]], size[one[some]], table)
                total += runs.expected(prob, lang[one[some]], seen[some])
        piece, lang = np.nonzero(total > 1e-9)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

    return run


def _blocks(size: np.ndarray, numbers: int = 1):
    """Words of like length together, as many as a block holds; ``numbers``: those a forward pass keeps for a word."""
    order = np.argsort(size, kind="stable")
    most = max(1, min(BLOCK_WORDS, BLOCK_NUMBERS // numbers))
    at = 0
    while at < len(order):
        block = order[at : at + most]
        # a block's grid is its longest word times its words
        n = max(1, int(np.searchsorted(size[block] * np.arange(1, len(block) + 1), BLOCK_BYTES, "right")))
        yield block[:n]
        at += n


@lru_cache(2)
def _table(pieces: tuple[bytes, ...]):
    return hashed(list(pieces))


def _score(langs: list[str], pieces, p, prior, with_text: bool):
    def run(batches):
        table, prob = _table(tuple(pieces.value)), p.value
        for batch in slices(batches, "text"):
            n = batch.num_rows
            evidence = np.tile(prior, (n, 1))
            data, start, size, row = cut_words(Words(batch.column("text"), fold=True))
            if len(start):
                one, kind = distinct_runs(data, start, size)
                logs = np.zeros((len(one), len(langs)))
                for some in _blocks(size[one], len(langs) * (table[2] + 1)):
                    logs[some] = Runs(data, start[one[some]], size[one[some]], table).forward(prob)
                for l in range(len(langs)):
                    evidence[:, l] += np.bincount(row, logs[kind, l], minlength=n)
            best = evidence.argmax(axis=1)
            score = 1 / np.exp(evidence - evidence.max(axis=1, keepdims=True)).sum(axis=1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            names = [langs[b] if ok else UNDEFINED for b, ok in zip(best, letters, strict=True)]
            rest = batch.select([c for c in batch.schema.names if c != "letters" and (with_text or c != "text")])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0))], names=[*rest.schema.names, "lang_pred", "score"])

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


class Model:
    """Languages, pieces and their probabilities."""

    def __init__(self, langs: list[str], pieces: list[bytes], p: np.ndarray, prior: np.ndarray):
        self.langs, self.pieces, self.p, self.prior = langs, pieces, p, prior


def fit(train: DataFrame, vocabulary: str = VOCABULARY, rounds: int = 1) -> Model:
    """A model of ``train`` (``text``, ``lang``); rows with a null language or no text teach nothing.

    The languages found must be few enough for a model of languages times
    pieces in one machine's memory; more than 1,000 are refused.
    """
    spark = train.sparkSession
    train = train.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("text", "lang")
    sizes = sorted(train.groupBy("lang").count().limit(1001).collect(), key=lambda r: r.lang)
    if len(sizes) > 1000:
        raise ValueError("more than 1,000 languages")
    langs = [r.lang for r in sizes]
    pieces = read_pieces(vocabulary)
    if not langs:
        return Model([], pieces, np.zeros((len(pieces), 0)), np.zeros(0))
    p = np.full((len(pieces), len(langs)), 1 / len(pieces))
    sent = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(p)
        counts = train.mapInArrow(_count(langs, sent, model), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        total = np.full(p.shape, PRIOR)
        # languages times pieces at most
        for row in counts.toLocalIterator():
            total[row.piece, row.lang] += row.n
        p = total / total.sum(axis=0)
        model.unpersist()
    prior = np.log(np.array([r["count"] for r in sizes], float) / sum(r["count"] for r in sizes))
    return Model(langs, pieces, p, prior)


def predict(docs: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """``docs`` (``text`` and other columns) with ``lang_pred`` and ``score``, the posterior of the predicted language (0 for ``und``).

    The text itself comes back only if asked for.  Columns named
    ``lang_pred``, ``score`` or ``letters`` are replaced or dropped.
    """
    spark = docs.sparkSession
    asked = docs.drop("lang_pred", "score", "letters").withColumn("letters", has_letter(F.col("text")))
    rest = [f for f in asked.schema.fields if f.name != "letters" and (with_text or f.name != "text")]
    if not model.langs:
        return asked.select(*[f"`{f.name}`" for f in rest], F.lit(UNDEFINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["lang_pred string", "score double"])
    pieces, p = spark.sparkContext.broadcast(model.pieces), spark.sparkContext.broadcast(model.p)
    return asked.mapInArrow(_score(model.langs, pieces, p, model.prior, with_text), schema)


def held_out(id_col: str, parts: int, out: int) -> Column:
    """Whether the id's crc32 falls to the held-out part; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == out


def identify(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = 1) -> DataFrame:
    """``doc_id held_out lang_pred score`` for every row of ``docs`` (``doc_id text lang``).

    Learns from documents that are not held out; predictions see only the
    text.  A null text or one without a letter is ``und`` with score 0.
    Whole texts are scored: words are runs between ASCII white space, A-Z
    folded, of any length.
    Repeated rows are scored alike; null languages teach nothing; with no
    training text everything is ``und``.  An empty table gives an empty
    result.
    """
    held = docs.select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    model = fit(held.where("not held_out"), vocabulary, rounds)
    return predict(held.select("doc_id", "held_out", "text"), model)


by_value(__name__)
