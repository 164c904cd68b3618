"""Quality classifier: regularised quadratic discriminant over document statistics.

Counts of a text (symbols, capitals, repeated words, ...) become shares on
the arcsine-root scale, where their spread depends little on the text's
length.  Each class has a mean and a covariance, shrunk towards its own
diagonal and the pooled covariance.  A text's score is the logistic of the
difference of the two log densities, each a Mahalanobis distance through a
Cholesky factor computed once.

The moments are sums over all labelled training documents, added up by
Spark; the driver sees two classes times the square of the number of
statistics.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep
from shelfwise.llm.words import Words, rows_of, slices

NAMES = (
    "symbols", "punctuation", "capitals", "digits", "wide", "repeats", "distinct", "commonest",
    "bare", "shouted", "lines", "short_lines", "long_words", "ends", "word_bytes", "size",
)
#: Shrinkage of a class covariance to the pooled one, then of that to its diagonal.
TO_POOLED, TO_DIAGONAL = 0.2, 0.1
#: Added to every variance, and the largest distance from the pooled mean in pooled deviations.
FLOOR, REACH = 1e-4, 12.0

#: Kinds of bytes: 1 symbol, 2 punctuation of prose, 3 capital, 4 digit, 5 small letter, 6 outside ASCII.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 1
KIND[[ord(c) for c in ".,;:'\"()-?"]] = 2
KIND[65:91] = 3
KIND[48:58] = 4
KIND[97:123] = 5
KIND[128:] = 6


def _share(x, n):
    """A share of n as an angle: its variance is about 1 / 4n whatever the share."""
    return np.arcsin(np.sqrt(np.clip((x + 0.375) / (n + 0.75), 0, 1)))


def statistics(column: pa.Array) -> np.ndarray:
    """The statistics of each text, a row per text; a null is an empty text."""
    words = Words(column)
    rows = len(words.count)
    kind = KIND[words.data]
    sums = np.zeros((7, len(kind) + 1), np.int32)
    for k in range(1, 7):
        np.cumsum(kind == k, out=sums[k, 1:])
    offsets = words.offsets
    per = sums[:, offsets[1:]] - sums[:, offsets[:-1]]
    letters = per[3] + per[5] + per[6]
    marks = per[1:].sum(axis=0)
    n = words.count.astype(float)
    row = rows_of(words.count)

    def count(flags):
        return np.bincount(row, flags, minlength=rows)

    hashes = words.hashes()
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(fresh)
    often = np.diff(np.append(first, len(h)))
    top = np.zeros(rows)
    np.maximum.at(top, r[first], often)

    def inside(k):
        return sums[k, words.end] - sums[k, words.start]

    size = words.end - words.start
    w_letters, w_caps = inside(3) + inside(5) + inside(6), inside(3)
    breaks = np.concatenate([[0], np.cumsum(words.data == 0x0A)])
    lines = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1.0
    ends = np.zeros(len(size))
    if len(size):
        ends = np.isin(words.data[words.end - 1], np.frombuffer(b".?!:", np.uint8)).astype(float)
    out = [
        _share(per[1], marks), _share(per[2], marks), _share(per[3], letters), _share(per[4], marks), _share(per[6], marks),
        _share(count(same), n), _share(np.bincount(r[first], minlength=rows), n), _share(top, n),
        _share(count(w_letters == 0), n), _share(count((w_caps > 1) & (w_caps == w_letters)), n), _share(lines - 1, n),
        _share(np.minimum(lines, np.maximum(lines * 8 - n, 0) / 8), lines), _share(count(size > 18), n), _share(count(ends), n),
        np.log((marks + 4) / (n + 1)), np.log(n + 1) / 4,
    ]
    return np.stack(out, axis=1)


def _featured(batches):
    for batch in slices(batches, "text"):
        x = statistics(batch.column("text"))
        flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], flat], names=[*rest, "x"])


def _matrix(batch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _moments(batches):
    """Per class: number, sums and sums of products of this task's rows."""
    p = len(NAMES)
    total = np.zeros((2, 1 + p + p * p))
    for batch in batches:
        x, y = _matrix(batch), batch.column("y").to_numpy()
        for c in (0, 1):
            own = x[y == c]
            total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(total))], names=["y", "m"])


class Model:
    """Per class: log prior, mean, inverse Cholesky factor and log determinant; clipping bounds."""

    def __init__(self, moments: np.ndarray):
        p = len(NAMES)
        self.n = moments[:, 0]
        self.parts = None
        if self.n.min() < 2:
            return
        mean = moments[:, 1 : p + 1] / self.n[:, None]
        cov = moments[:, p + 1 :].reshape(2, p, p) / self.n[:, None, None] - mean[:, :, None] * mean[:, None, :]
        pooled = np.einsum("c,cij->ij", self.n / self.n.sum(), cov)
        centre = (mean * self.n[:, None]).sum(axis=0) / self.n.sum()
        spread = np.sqrt(np.diag(pooled) + FLOOR)
        self.low, self.high = centre - REACH * spread, centre + REACH * spread
        self.parts = []
        for c in (0, 1):
            s = (1 - TO_POOLED) * cov[c] + TO_POOLED * pooled
            s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.diag(s)) + FLOOR * np.eye(p)
            factor = np.linalg.cholesky(s)
            self.parts.append((np.log(self.n[c] / self.n.sum()), mean[c], np.linalg.inv(factor).T, 2 * np.log(np.diag(factor)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; without rows of both labels, the share of label 1 (a half with none)."""
        if self.parts is None:
            return np.full(len(x), float(self.n[1] / self.n.sum()) if self.n.sum() else 0.5)
        x = np.clip(x, self.low, self.high)
        logs = [prior - 0.5 * (logdet + (((x - mean) @ whiten) ** 2).sum(axis=1)) for prior, mean, whiten, logdet in self.parts]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(examples: DataFrame) -> Model:
    """``examples``: ``x``, ``y`` (0 or 1)."""
    p = len(NAMES)
    sums = examples.select("x", "y").mapInArrow(_moments, "y int, m array<double>")
    sums = sums.select("y", F.posexplode("m").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v"))
    moments = np.zeros((2, 1 + p + p * p))
    for row in sums.collect():
        moments[row.y, row.i] = row.v
    return Model(moments)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id held_out score predicted`` for every row of ``docs`` (``doc_id text``).

    Learns from the rows of ``labels`` (``doc_id quality``) with quality 0
    or 1 whose document is not held out (crc32 of the id as text, modulo 3,
    is 1); a score is made from the whole text alone.

    A null text scores as an empty one; null ids have no label; repeated
    labels are observations of their own; repeated documents score alike.
    With labels of one class only, or none, the score is the share of
    label 1, or a half.  An empty table gives an empty result.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(_featured, f"doc_id {id_type}, held_out boolean, x array<double>")
    rows = keep(rows, "statistics")
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("y in (0, 1)")
    model = fit(rows.where("not held_out").join(marked, "doc_id"))

    def scored(batches):
        for batch in batches:
            score = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(scored, f"doc_id {id_type}, held_out boolean, score double, predicted int")


by_value(__name__)
