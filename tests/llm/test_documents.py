"""The operators on documents against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import math
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing, quality, substring_dedup

from .conftest import documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def test_line_dedup(spark, odd):
    got = sorted((r.doc_id is not None, r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(documents(spark, odd)).select("doc_id", "text", "n_lines", "n_dropped").collect() if r.doc_id is not None)
    keys = defaultdict(set)
    for i, text, *_ in odd:
        for line in (text or "").split("\n"):
            key = lower(line.strip(" \t\n\v\f\r"))
            if len(key) >= 40:
                keys[key].add(-1 if i is None else i)
    want = []
    for i, text, *_ in odd:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            found = keys.get(lower(line.strip(" \t\n\v\f\r")), set())
            if len(found) < 5 or i == max(found):
                stay.append(line)
        if i is not None:
            want.append((True, i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    assert got == sorted(want)
    assert any(w[4] for w in want)


def mixed(rows, weights=(5, 2, 1), share=1.5, most=2):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, target, free = sum(sizes.values()) * share, {}, set(order)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level >= most * sizes[s]]
        if not full:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: float(most * sizes[s]) for s in full})
        free -= set(full)
    return sizes, target, budget


def test_mixing(spark, odd):
    rows = mixing.plan(documents(spark, odd)).collect()
    again = mixing.plan(documents(spark, odd)).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    sizes, target, budget = mixed(odd)
    assert len(rows) == len(odd)
    assert sum(r.taken for r in rows) == math.floor(budget)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    slack = max(largest.values())
    assert all(abs(taken[s] - target[s]) <= slack for s in sizes)


def test_mixing_empty(spark):
    assert mixing.plan(documents(spark, [])).collect() == []
    rows = mixing.plan(documents(spark, [(1, None, None, None), (2, "", None, "a")])).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def covered(rows, length):
    first = {}
    for i, text, *_ in rows:
        w, i = words(text), -1 if i is None else i
        for k in range(len(w) - length + 1):
            run = tuple(w[k : k + length])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, text, *_ in rows:
        w, n = words(text), -1 if i is None else i
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < n:
                gone.update(range(k, k + length))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("crowd", [64, 1])
def test_substring_dedup(spark, odd, crowd, monkeypatch):
    """With a crowd of 1 every shared minimizer takes the way of crowded ones."""
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    got = substring_dedup.dedup_substrings(documents(spark, odd)).collect()
    want = covered(odd, 50)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == want
    assert sum(w[2] > 0 for w in want) > 5


def test_substring_dedup_dense(spark):
    """Short vocabulary and windows: many partial overlaps, so that the indexes decide."""
    rng = np.random.default_rng(3)
    pool = [" ".join(rng.choice(["a", "b", "c", "d", "e"], 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(3):
            x = pool[rng.integers(6)].split()
            a = rng.integers(0, 30)
            parts += x[a : a + rng.integers(8, 30)] + [f"u{rng.integers(40)}"]
        rows.append((i, " ".join(parts), None, None))
    got = substring_dedup.dedup_substrings(documents(spark, rows), length=12).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == covered(rows, 12)


def linked(rows, width, percent):
    """Component of every id by comparing all pairs."""
    sets = []
    for i, text, *_ in rows:
        w = words(lower(text or ""))
        sets.append((i, frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (ia, x) in enumerate(sets):
        for b, (ib, y) in enumerate(sets[:a]):
            if x and y and (100 * len(x & y) >= percent * len(x | y) or ia == ib):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        j = find(k)
        least[j] = min(least.get(j, i), i, key=lambda v: -1 if v is None else v)
    return Counter((str(i), len(s), str(least[find(k)] if s else i)) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize("width,percent", [(4, 85), (2, 50)])
def test_jaccard_join(spark, odd, width, percent):
    got = jaccard_join.similarity_components(documents(spark, odd), width=width, percent=percent).collect()
    assert Counter((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == linked(odd, width, percent)


def test_jaccard_join_chain(spark):
    """A drifting chain and a crowd of near copies: links that only single pairs carry."""
    rng = np.random.default_rng(5)
    text = [f"t{k}" for k in range(80)]
    rows = []
    for i in range(40):
        text[rng.integers(80)] = f"c{i}"
        rows.append((i, " ".join(text), None, None))
    for i in range(40, 90):
        copy = [f"p{k}" for k in range(60)]
        for k in rng.integers(0, 60, rng.integers(1, 4)):
            copy[k] = f"q{rng.integers(9)}"
        rows.append((i, " ".join(copy), None, None))
    got = jaccard_join.similarity_components(documents(spark, rows)).collect()
    assert Counter((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == linked(rows, 4, 85)


def test_signatures_rule_out_no_link():
    rng = np.random.default_rng(3)
    for n in (1, 20, 300, 4000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        sets = [base, base[: n - n // 10], np.concatenate([base[n // 9 :], rng.integers(0, 2**63, n // 9, dtype=np.uint64)]), rng.integers(0, 2**63, n, dtype=np.uint64)]
        signs = jaccard_join.signatures(np.concatenate(sets), np.array([len(x) for x in sets])).view(np.uint64)
        for x, a in zip(sets, signs, strict=True):
            for y, b in zip(sets, signs, strict=True):
                assert int(np.bitwise_count(a ^ b).sum()) <= len(np.setxor1d(x, y))


def test_jaccard_join_makes_no_rows_of_near_copies_that_do_not_link(spark, monkeypatch):
    rng = random.Random(5)
    base, rows = [f"b{i}" for i in range(300)], []
    for d in range(120):
        text = list(base)
        for i in rng.sample(range(300), 5):
            text[i] = f"x{d}y{i}"
        rows.append((d, " ".join(text), "en", "a"))
    made, met = [], jaccard_join._met

    def counted(*a):
        made.append(met(*a).count())
        with monkeypatch.context() as without:
            without.setattr(jaccard_join, "_near", lambda t: F.lit(True))
            made.append(met(*a).count())
        return met(*a)

    monkeypatch.setattr(jaccard_join, "_met", counted)
    got = jaccard_join.similarity_components(documents(spark, rows)).collect()
    assert Counter((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == linked(rows, 4, 85)
    assert made[0] * 5 < made[1]


def test_jaccard_join_lists_all_links(spark, odd, monkeypatch):
    """Every link between different texts is listed, within connected groups too, and each row has its number of links."""
    monkeypatch.setattr(jaccard_join, "TILE", 7)
    rng = np.random.default_rng(6)
    rows = [r for r in odd if r[0] is None or r[0] < 30]
    for i in range(100, 150):
        copy = [f"p{k}" for k in range(160)]
        for k in rng.integers(0, 160, rng.integers(0, 3)):
            copy[k] = f"q{rng.integers(9)}"
        rows.append((i, " ".join(copy), "en", "a"))
    docs = documents(spark, rows)
    sets = {}
    for i, text, *_ in rows:
        words = (text or "").lower().split()
        grams = frozenset(" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, 1))) if words else frozenset()
        sets.setdefault(grams, set()).add(i)
    alike = {(x, y) for x in sets for y in sets if x and y and x != y and 100 * len(x & y) >= 85 * len(x | y)}
    _, links, _ = jaccard_join.similar_classes(docs)
    assert links.count() == links.distinct().count() == len(alike) // 2 > 200
    count = {x: len(ids) - 1 + sum(len(sets[y]) for y in sets if (x, y) in alike) if x else 0 for x, ids in sets.items()}
    want = Counter((str(i), count[x]) for i, t, *_ in rows for x, ids in sets.items() if i in ids)
    assert Counter((str(r.doc_id), r.n_links) for r in jaccard_join.similarity_components(docs).collect()) == want


def test_decontamination(spark, odd):
    texts = {i: t for i, t, *_ in odd}
    items = [(1, " ".join(texts[5].split()[20:50])), (2, "never seen anywhere at all in here"), (3, None), (4, "too short"), (5, " ".join(texts[16].upper().split()[500:640])), (5, None), (6, "same same same same same same")]
    near = texts[3].split()[:40]
    near[7] = "changed"
    items.append((7, " ".join(near)))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.contaminated(documents(spark, odd), table).collect()}

    def grams(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want = set()
    for item in {i for i, _ in items}:
        own = set().union(*[grams(t) for i, t in items if i == item])
        for i, text, *_ in odd:
            n = len(own & grams(text))
            if own and n * 100 >= len(own) * 80:
                want.add((i, item, n, len(own)))
    assert got == want and len(want) >= 8
    # rows are kept by their own texts, not by their ids
    held = [set().union(*[grams(t) for i, t in items if i == item]) for item in {i for i, _ in items}]
    clean = [(i, t) for i, t, *_ in odd if not any(own and 100 * len(own & grams(t)) >= 80 * len(own) for own in held)]
    kept = decontaminate.decontaminate(documents(spark, odd), table).select("doc_id", "text").collect()
    assert Counter(map(str, kept)) == Counter(str(r) for r in documents(spark, [(*r, None, None) for r in clean]).select("doc_id", "text").collect())


def test_rows_of_one_id(spark):
    """An id's rows are judged by their own texts: near copies go and clean rows stay, with and without an id."""
    a, b = ([f"{x}{k}" for k in range(60)] for x in "ab")
    near = [" ".join([*x[:-1], "z"]) for x in (a, b)]
    a, b = " ".join(a), " ".join(b)
    rows = [(1, a), (2, near[0]), (2, b), (None, near[1]), (None, b), (3, ""), (3, ""), (3, None), (4, a)]
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    kept = [(r.doc_id, r.text) for r in jaccard_join.drop_similar(docs).collect()]
    assert len(kept) == 4 and {(1, a), (3, ""), (3, None)} < set(kept)
    assert [t in (near[1], b) for i, t in kept if i is None] == [True]
    items = spark.createDataFrame([(1, b)], "item_id long, text string")
    left = [(r.doc_id, r.text) for r in decontaminate.decontaminate(docs, items).collect()]
    assert Counter(left) == Counter([(1, a), (2, near[0]), (3, ""), (3, ""), (3, None), (4, a)])


def test_language_id_sums_segmentations():
    """The forward pass equals the sum over all ways to cut a word."""
    pieces = language_id.read_pieces()
    number = {p: k for k, p in enumerate(pieces)}
    p = np.random.default_rng(1).random((len(pieces), 2))
    p /= p.sum(axis=0)
    data = np.frombuffer(b" the anches", np.uint8)

    def total(part):
        if not part:
            return np.ones(2)
        return sum((p[number[part[:k]]] * total(part[k:]) for k in range(1, len(part) + 1) if part[:k] in number), np.zeros(2))

    runs = language_id.Runs(data, np.array([0, 4]), np.array([4, 7]), language_id.hashed(pieces))
    logs = runs.forward(p)
    assert np.allclose(logs, np.log([total(b" the"), total(b" anches")]))
    # expected counts: each word's pieces cover its bytes once
    counts = runs.expected(p, np.array([0, 1]), np.array([1.0, 2.0]))
    size = np.array([len(x) for x in pieces])
    assert np.allclose(size @ counts, [4.0, 14.0])


def segmentation_sums(word, number, p):
    """Log-probability and expected piece counts of a word, exactly, by fractions."""
    n = len(word)
    cuts = [(i, j, number[word[i:j]]) for i in range(n) for j in range(i + 1, n + 1) if word[i:j] in number]
    head, tail = [Fraction(0)] * (n + 1), [Fraction(0)] * (n + 1)
    head[0] = tail[n] = Fraction(1)
    for i, j, k in cuts:
        head[j] += head[i] * Fraction(p[k])
    for i, j, k in reversed(cuts):
        tail[i] += Fraction(p[k]) * tail[j]
    counts = Counter()
    for i, j, k in cuts:
        counts[k] += float(head[i] * Fraction(p[k]) * tail[j] / head[n])
    return math.log(head[n].numerator) - math.log(head[n].denominator), counts


def test_language_id_long_words():
    """Long words, and words of a script without blanks, are summed whole; a model of very many pieces loses no evidence."""
    pieces = language_id.read_pieces()
    number = {p: k for k, p in enumerate(pieces)}
    assert max(map(len, pieces)) > 12
    table = language_id.hashed(pieces)
    rng = np.random.default_rng(7)
    p = rng.random((len(pieces), 2)) ** 8
    p /= p.sum(axis=0)
    words = [b" " + b"internationalisation" * 6, " \u4e2d\u6587\u6ca1\u6709\u7a7a\u683c\u7684\u957f\u53e5\u5b50".encode() * 3, b" the", b" " + rng.bytes(90).hex().encode()]
    size = np.array([len(w) for w in words])
    data, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
    runs = language_id.Runs(data, start, size, table)
    logs, lang = runs.forward(p), np.array([0, 1, 1, 0])
    want = [[segmentation_sums(w, number, p[:, l]) for l in (0, 1)] for w in words]
    assert np.allclose(logs, [[x[0] for x in row] for row in want])
    assert logs.min() < math.log(1e-300)
    counts = runs.expected(p, lang, np.ones(4))
    total = np.zeros(p.shape)
    for row, l in zip(want, lang, strict=True):
        for k, n in row[l][1].items():
            total[k, l] += n
    assert np.allclose(counts, total)
    # 1e12 pieces seen, none of them in this word but single bytes of one language
    p = np.full((len(pieces), 2), language_id.PRIOR / 1e12)
    p[[number[bytes([b])] for b in range(256)], 1] = 2 * language_id.PRIOR / 1e12
    one = b" " + b"0123456789abcdef" * 4
    logs = language_id.Runs(np.frombuffer(one, np.uint8), np.array([0]), np.array([len(one)]), table).forward(p)[0]
    want = [segmentation_sums(one, number, p[:, l])[0] for l in (0, 1)]
    assert np.allclose(logs, want) and logs[1] > logs[0] + 1


def test_language_id(spark, odd):
    rng = np.random.default_rng(2)
    kinds = {"xx": ["tha", "ing", "wo", "ke"], "yy": ["sch", "ung", "ü", "ein"]}
    rows = [(100 + i, " ".join("".join(rng.choice(kinds[l], 3)) for _ in range(30)), l, "s") for i in range(60) for l in (["xx", "yy"][i % 2],)]
    rows += [(300, None, "xx", "s"), (301, "", "xx", "s"), (302, "12 34 -", "yy", "s"), (303, "tha" * 40_000, None, "s"), (None, "schung einein", "yy", "s"), (101, rows[1][1], "yy", "s")]
    got = language_id.identify(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        by[r.doc_id].add(r.lang_pred)
    assert by[300] == by[301] == by[302] == {"und"}
    assert by[303] == {"xx"} and by[None] == {"yy"}
    assert all(by[i] == {l} for i, t, l, _ in rows if 100 <= (i or 0) < 160)
    assert language_id.identify(documents(spark, [])).collect() == []
    assert {r.lang_pred for r in language_id.identify(documents(spark, [(1, "abc", None, None)])).collect()} == {"und"}


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98


def test_quality(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    marks = spark.createDataFrame([(i, k) for i, k in [(1, 1), (1, 0), (3, 1), (5, 0), (5, None), (None, 1), (10, 0), (18, 0), (6, 1), (13, 1), (16, 1)]], "doc_id long, quality int")
    rows = quality.score_quality(documents(spark, odd), marks).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in quality.score_quality(documents(spark, odd), marks.where("false")).collect()} == {0.5}
    assert quality.score_quality(documents(spark, []), marks).collect() == []


def test_quality_density():
    """Scores are the densities' ratio, computed plainly."""
    rng = np.random.default_rng(4)
    p = len(quality.NAMES)
    x, y = rng.normal(size=(400, p)), rng.integers(0, 2, 400)
    x[y == 1] = x[y == 1] * 0.5 + 1
    moments = np.array([np.concatenate([[len(o)], o.sum(axis=0), (o.T @ o).ravel()]) for o in (x[y == 0], x[y == 1])])
    model = quality.Model(moments)
    pooled = sum((y == c).mean() * np.cov(x[y == c].T, bias=True) for c in (0, 1))
    logs = []
    for c in (0, 1):
        s = (1 - quality.TO_POOLED) * np.cov(x[y == c].T, bias=True) + quality.TO_POOLED * pooled
        s = (1 - quality.TO_DIAGONAL) * s + quality.TO_DIAGONAL * np.diag(np.diag(s)) + quality.FLOOR * np.eye(p)
        d = x - x[y == c].mean(axis=0)
        logs.append(np.log((y == c).mean()) - 0.5 * (np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d) + np.linalg.slogdet(s)[1]))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_empty_tables(spark):
    none = documents(spark, [])
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert line_dedup.dedup_lines(none).count() == 0
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert jaccard_join.similarity_components(none).count() == 0
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(documents(spark, odd_rows()), items.where("false")).count() == 0


