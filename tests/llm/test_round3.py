"""Periodic runs, BPE and source divergence against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import bpe_lexicon, divergence, periodic, queries

from .conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs ----------------------------------------------------------------


def all_runs(w, least, times):
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and not any(w[i : i + size - r] == w[i + r : i + size] for r in range(1, q)):
                out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def test_find_runs_equals_all_comparisons():
    rng = random.Random(11)
    for _ in range(800):
        n = rng.randint(0, 70)
        w = [rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for least, times in ((2, 2), (6, 2), (9, 3), (24, 3), (10, 4)):
            assert periodic.find_runs(w, least, times) == all_runs(w, least, times)


def test_every_run_repeats_its_shingles():
    for least, times in ((2, 2), (10, 2), (9, 3), (24, 3), (25, 3), (26, 3), (30, 4), (7, 5)):
        width = periodic.screen(least, times)
        for q in range(1, 60):
            size = max(least, times * q)
            places = size - width + 1
            assert places >= 1
            assert width == 1 or all(j >= q or j + q < places for j in range(places))


def test_collapse_runs(spark, odd):
    phrase = " ".join(f"p{i}" for i in range(9))
    rows = odd + [
        (60, f"a b {' '.join([phrase] * 3)} c", "en", "a"), (61, f"{phrase} {phrase} p0 p1", "en", "a"), (62, "x " * 23, "en", "a"), (63, "x\t" * 24, "en", "a"),
        (64, f"{'u v ' * 20}w {'u v ' * 20}w {'u v ' * 20}w z", "en", "a"), (64, "é ü " * 30, "en", "a"), (None, "tick tock " * 50 + "end", "en", "a"),
        (65, f"{' '.join([phrase] * 4)} p0 p1 p2 {'p3 p4 ' * 12}", "en", "a"),
    ]
    for least, times in ((24, 3), (12, 2)):
        got = periodic.collapse_runs(documents(spark, rows), min_length=least, min_exponent=times).collect()
        assert len(got) == len(rows)
        want = Counter()
        for i, text, *_ in rows:
            w = WORD.findall(text or "")
            runs = all_runs(w, least, times) if len(w) < 5000 else [(0, 40_000, 977 * 13)]  # the long texts of the fixture
            gone = {j for start, size, q in runs for j in range(start + q, start + size)}
            want[i, len(w), tuple(runs), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
        assert Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in got) == want
        assert sum(len(k[2]) for k in want) > 10
    assert periodic.collapse_runs(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse_runs(documents(spark, rows), min_exponent=1)


def test_op11_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 160))), "en", "a") for i in range(300)] + [(301, None, "en", "a"), (302, "", "en", "a")]
    path = str(tmp_path)
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, path).collect()}
    assert len(got) == len(rows)
    found = 0
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        runs = all_runs(w, 24, 3)
        found += len(runs)
        gone = {j for start, size, q in runs for j in range(start + q, start + size)}
        r = got[i]
        assert r.n_runs == len(runs)
        top = None
        for run in runs:
            if top is None or run[1] * top[2] > top[1] * run[2]:
                top = run
        assert (r.start, r.length, r.period) == (top or (None, None, None))
        assert r.exponent_milli == (top and 1000 * top[1] // top[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{z},{q}\n" for s, z, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()
    assert found > 5


# --- BPE --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    return bpe_lexicon.Coder.from_file()


def strange_texts():
    rng = random.Random(3)
    marks = (0x3A3, 0x3C3, 0x130, 0x1C89, 0x1E9E, 0x3000, 0x1680, 0x20AC, 0x4E00, 0x1F600, 0x10D50, 0x16EA0, 0x301, 0x308, 0xA7CB, 0x2160, 0x2075, 0x88F, 0x558, 0x1D7CE)
    letters = [*map(chr, (*range(1, 0x250), *marks))]
    return [
        "<|endoftext|>hello<|startoftext|> x<|endoftext|", "'s 'S DON'T it'LL we'Re", "a" * 5000 + " " + "ab" * 4000, "ΑΣ ΑΣΑ", "é É<|endoftext|>́",
        "x" * 64, "y" * 65, "\x1c\x1d a\x1fb", " a b　c", "12 3a4", "…!?--", *["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)],
    ]


def test_bpe_equals_the_tokenizers_library(spark, odd, coder):
    library = Tokenizer.from_file(bpe_lexicon.VOCABULARY)
    rows = odd + [(100 + i, t, "en", "a") for i, t in enumerate(strange_texts())]
    want = Counter()
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    for size in (0, 40, bpe_lexicon.LEXICON):  # all words merged, few of them, none
        got = bpe_lexicon.decode(bpe_lexicon.encode(documents(spark, rows), coder, lexicon_words=size), coder).collect()
        assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got) == want
    assert bpe_lexicon.encode(documents(spark, []), coder).collect() == []


def test_letters_and_cases_equal_the_tokenizers_library(coder):
    library = Tokenizer.from_file(bpe_lexicon.VOCABULARY)
    pieces = coder.pieces()
    for low in range(0, 0x20000, 64):
        text = " ".join(f"1{chr(c)}a" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000)
        assert coder.code(text.encode().split(), pieces)[0].tolist() == library.encode(text, add_special_tokens=False).ids, hex(low)


def test_lexicon_is_minimal_and_knows_its_words(tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() for _ in range(900)})
    path = str(tmp_path / "lexicon.bin")
    with open(path, "wb") as f:
        f.write(bpe_lexicon.compile_lexicon([(w, list(w)) for w in words]))
    lexicon = bpe_lexicon.Lexicon(path)
    asked = words + [b"", b"d", b"abcabcabc", b"a" * 65]
    number = lexicon.find(asked).tolist()
    assert number == [*range(len(words)), *[words.index(w) if w in words else -1 for w in asked[len(words) :]]]
    for w, n in zip(words, number, strict=False):
        assert lexicon.ids[lexicon.at[n] : lexicon.at[n + 1]].tolist() == list(w)
    # as many states as there are different sets of endings
    endings = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(lexicon.ends) == len({frozenset(x) for x in endings.values()})
    with open(path, "wb") as f:
        f.write(bpe_lexicon.compile_lexicon([]))
    assert bpe_lexicon.Lexicon(path).find([b"a", b""]).tolist() == [-1, -1]


def test_decode_leaves_out_unknown_ids(spark, coder):
    rows = spark.createDataFrame([(1, bytearray(np.array([0, 4_000_000, 49407], "<u4").tobytes())), (2, None), (3, bytearray())], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe_lexicon.decode(rows, coder).collect()} == {1: "! <|endoftext|>", 2: "", 3: ""}


# --- divergence -------------------------------------------------------------------


def audited(rows, min_docs, top):
    grams, df, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)
        grams.update((lang, source, t) for t in terms)
        df.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= min_docs:
            kept[lang].append(t)
    p = {}
    for lang, source in groups:
        n = sum(grams[lang, source, t] for t in kept[lang])
        p[lang, source] = {t: 1 + 10**9 * (grams[lang, source, t] + 1) // (n + len(kept[lang])) for t in kept[lang]}
    out = []
    for lang, source in groups:
        mine = p[lang, source]
        value = {o: sum((mine[t] - q) ** 2 // q for t, q in p[lang, o].items()) for x, o in groups if x == lang and o != source}
        part = sorted(value.items(), key=lambda x: (-x[1], x[0].encode()))
        out += [(lang, source, "pair", o, v, r) for r, (o, v) in enumerate(part, 1)]
        total = {t: sum(grams[lang, s, t] for x, s in groups if x == lang) for t in kept[lang]}
        size = sum(total.values())
        value = {}
        for t in kept[lang]:
            q = 1 + 10**9 * (total[t] + 1) // (size + len(kept[lang]))
            if grams[lang, source, t] and mine[t] > q:
                value[t] = (mine[t] - q) ** 2 // q
        part = sorted(value.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
        out += [(lang, source, "term", t, v, r) for r, (t, v) in enumerate(part, 1)]
    return Counter(out)


def test_divergence(spark, odd):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "ÄÖ", "äö", "x1y", "é", "zeta", "Ω"]
    rows = odd + [(200 + i, " ".join(rng.choices(vocabulary, range(1, 10), k=rng.randint(0, 40))), rng.choice(("en", "de", None)), f"s{rng.randrange(4)}") for i in range(60)]
    rows += [(300, "alone here", "xx", "s1"), (301, None, "xx", "s2"), (302, "1 2 3", "xx", None), (302, "1 2 3", "xx", None)]
    for min_docs, top in ((3, 200), (1, 5), (2, 1)):
        got = divergence.audit(documents(spark, rows), min_docs=min_docs, top=top).collect()
        assert Counter(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got) == audited(rows, min_docs, top)
    assert divergence.audit(documents(spark, [])).collect() == []


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(1)
    for size, k in ((0, 3), (1, 1), (700, 1), (700, 4), (900, 30)):
        n, total = rng.integers(0, 12, size), rng.integers(0, 12, size)
        place = rng.permutation(size)
        worse = (n[None, :] >= n[:, None]) & (total[None, :] <= total[:, None]) & (place[None, :] < place[:, None])
        assert sorted(divergence.skyband(n, total, place, k).tolist()) == np.flatnonzero(worse.sum(axis=1) < k).tolist()
