"""Periodic run detection: a suffix automaton of each text's words, its link tree accessed word after word.

A run is a stretch of words with smallest period q that is at least some
exponent times q long and that no neighbouring word extends.

The automaton's suffix links form a tree; the node of a prefix has all its
suffixes on the way to the root.  Every node is coloured with the place
where its strings ended last.  Appending word i accesses the way up from the
node of prefix i and recolours it: each piece of one old colour e, whose
deepest node is l long, says that the l words up to e are the l words up to
i.  If l is at least i - e they form a square of period i - e, and the
square reaches back to e - l + 1.  Squares of one run have the same start
and period, so the last of them is the run.  The ways are held as link-cut
paths: a path of one colour is a splay tree, and an access moves O(log n)
pieces, amortised.

A long run repeats all its short shingles within itself.  So only stretches
of a text whose shingles of ``screen`` words all occur again in the text go
through the automaton; no run lies elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value
from shelfwise.llm.words import SPACE, Words, mix, rows_of, slices

RUNS = "array<struct<start:long,length:long,period:long>>"


# --- suffix automaton -------------------------------------------------------------


def link_tree(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of the words: link and length of every state, and the state of every prefix.  State 0 is the empty string."""
    link, length, steps, prefixes = [-1], [0], [{}], []
    last = 0
    for i, word in enumerate(words, 1):
        state = len(link)
        length.append(i)
        steps.append({})
        prefixes.append(state)
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = state
            at = link[at]
        if at < 0:
            link.append(0)
        else:
            old = steps[at][word]
            if length[old] == length[at] + 1:
                link.append(old)
            else:
                link.append(state + 1)
                link.append(link[old])
                length.append(length[at] + 1)
                steps.append(dict(steps[old]))
                link[old] = state + 1
                while at >= 0 and steps[at].get(word) == old:
                    steps[at][word] = state + 1
                    at = link[at]
        last = state
    return link, length, prefixes


# --- link-cut access --------------------------------------------------------------


class Paths:
    """The link tree without its root, as paths of one colour; a path is a splay tree ordered by depth, its colour at the top."""

    def __init__(self, link: list[int]):
        self.up = [max(x, 0) for x in link]  # parent in the splay tree, or the path's parent; 0 for none
        self.left = [0] * len(link)
        self.right = [0] * len(link)
        self.colour = [0] * len(link)  # 1 + the word where the path's strings ended last, 0 for never

    def _rotate(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(self, x: int) -> None:
        """Brings ``x`` to the top of its path."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        while p and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self.colour[x] = self.colour[g]
                straight = (left[p] == x) == (left[g] == p)
                self._rotate(p if straight else x, g if straight else p)
                self._rotate(x, up[x])
            else:
                self.colour[x] = self.colour[p]
                self._rotate(x, p)
            p = up[x]

    def access(self, node: int, end: int):
        """Recolours the way from ``node`` up with ``end``; yields (old colour, deepest node) of each piece that had one."""
        up, right, colour = self.up, self.right, self.colour
        below, at = 0, node
        while at:
            if up[at]:
                self.splay(at)
            old = colour[at]
            if old:
                yield old, at
            if right[at]:
                colour[right[at]] = old
            right[at] = below
            below, at = at, up[at]
        self.splay(node)
        colour[node] = end


def find_runs(words: list, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``min_length`` words and ``min_exponent`` (2 or more) periods, by start and period."""
    codes: dict = {}
    link, length, prefixes = link_tree([codes.setdefault(w, len(codes)) for w in words])
    paths = Paths(link)
    found: dict = {}
    for end, state in enumerate(prefixes, 1):
        for old, node in paths.access(state, end):
            period, same = end - old, length[node]
            # a square; the stretch back to its start is same + period words long
            if same >= period and same + period >= min_length and same + period >= min_exponent * period:
                found[old - same, period] = same + period
    return sorted((start, size, period) for (start, period), size in found.items())


# --- screening --------------------------------------------------------------------


def screen(min_length: int, min_exponent: int) -> int:
    """The widest shingle that every run repeats within itself at every place.

    A run of L words and period q has L - width + 1 shingles; each has its
    like q places on or back inside the run if they are at least 2 q.  L is
    at least ``min_length`` and ``min_exponent`` q; what that leaves beyond
    2 q is least where the two meet.
    """
    meet = min_length // min_exponent
    return 1 + max(0, min(max(min_length, min_exponent * q) - 2 * q for q in (max(1, meet), meet + 1)))


def stretches(words: Words, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last word of the stretches in which all shingles occur again in their row and that are long enough for a run."""
    width = screen(min_length, min_exponent)
    grams, count = words.shingles(words.hashes(), width)
    row = rows_of(count)
    grams = mix(grams + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # equal neighbours in sorted order occur more than once
    values = np.sort(grams)
    twice = np.unique(values[1:][values[1:] == values[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    again = np.isin(grams, twice, kind="sort")
    place = np.flatnonzero(again)
    cut = np.flatnonzero((np.diff(place) > 1) | (np.diff(row[place]) != 0)) + 1
    low = place[np.concatenate([[0], cut])]
    high = place[np.concatenate([cut, [len(place)]]) - 1]
    ends = np.cumsum(count)
    offset = words.first[:-1] - (ends - count)  # from a shingle's number to its first word
    first, past = low + offset[row[low]], high + offset[row[high]] + width
    long = past - first >= min_length
    return first[long], past[long]


# --- texts ------------------------------------------------------------------------


def joined(words: Words, stay: np.ndarray) -> pa.Array:
    """Each row's words marked in ``stay``, joined by one space."""
    data = words.data.copy()
    keep = ~SPACE[data]
    gone = np.zeros(len(data) + 1, np.int32)
    np.add.at(gone, words.start[~stay], 1)
    np.add.at(gone, words.end[~stay], -1)
    keep &= np.cumsum(gone[:-1]) == 0
    # a space after every word that stays, but for the last of its row
    kept = np.flatnonzero(stay)
    inner = kept[:-1][np.diff(np.searchsorted(words.first, kept, "right")) == 0]
    data[words.end[inner]] = 0x20
    keep[words.end[inner]] = True
    size = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size) - 1, [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(data[keep])])
    return out.cast(pa.large_string()).cast(pa.string())


def _collapse(min_length: int, min_exponent: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            runs: list = [[] for _ in range(batch.num_rows)]
            steps = np.zeros(len(words.start) + 1, np.int64)
            data = words.data
            for low, past in zip(*(x.tolist() for x in stretches(words, min_length, min_exponent)), strict=True):
                row = int(np.searchsorted(words.first, low, "right")) - 1
                own = [data[a:b].tobytes() for a, b in zip(words.start[low:past].tolist(), words.end[low:past].tolist(), strict=True)]
                for start, length, period in find_runs(own, min_length, min_exponent):
                    runs[row].append({"start": low + start - int(words.first[row]), "length": length, "period": period})
                    steps[low + start + period] += 1
                    steps[low + start + length] -= 1
            gone = np.cumsum(steps)[:-1] > 0
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(words.count.astype(np.int64)), pa.array(runs, kind), joined(words, ~gone)],
                names=[*rest, "n_words", "runs", "collapsed"],
            )

    return run


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """``doc_id n_words runs collapsed`` for every row of ``docs``.

    ``runs`` lists each text's maximal stretches with smallest period q that
    are at least ``min_length`` words and ``min_exponent`` (2 or more) times
    q long, by start and period; words are numbered from 0.  ``collapsed``
    is the words joined by one space, without those that a run holds after
    its first q words.

    Words are runs of bytes other than space and 0x09-0x0D, unchanged.  A
    null, empty or blank text has no words, no runs and an empty
    ``collapsed``.  Rows are judged each for itself, so repeated rows and
    null ids come back as they are.  An empty table gives an empty result;
    other columns are not read.

    Nothing is shuffled.  A task holds a slice of texts, and the automaton
    of one periodic stretch of one text at a time.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_collapse(min_length, min_exponent), f"doc_id {id_type}, n_words long, runs {RUNS}, collapsed string")


by_value(__name__)
