"""Chat, neighbours, pages and the pipeline against brute force and exact round trips."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from shelfwise.llm import ann, chat, fm_index, html_text
from shelfwise.llm.components import components

from .conftest import documents
from .test_documents import linked


def test_escape_round_trip(spark):
    rng = random.Random(3)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "[", " [/INST] ", "ok", "\n", "é", ""]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(200)]
    rows = spark.createDataFrame([(i, 1, None, 1.0, t, t[::-1]) for i, t in enumerate(texts)], "tree long, node long, parent long, score double, role string, text string")
    for r in chat.format_trees(rows).collect():
        assert chat.read_back(r.formatted) == [(texts[r.tree], texts[r.tree][::-1])]


def test_paths_of_reply_trees(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for t in range(20):
        n = rng.randint(1, 30)
        parent = {i: None if i == 0 or rng.random() < 0.05 else rng.randrange(max(0, i - 4), i) for i in range(n)}
        score = {i: rng.choice([None, 0.5, 1.0, -1.0]) for i in range(n)}
        rows += [(t, i, parent[i], score[i], "assistant" if i % 2 else "user", f"x{i}") for i in range(n)]

        def path(i, parent=parent):
            out = []
            while i is not None:
                out.append(i)
                i = parent[i]
            return out[::-1]

        leaves = [i for i in range(n) if i not in parent.values()]
        best = sorted(leaves, key=lambda l: (-sum(score[i] or 0 for i in path(l)), l))[:2]
        want.update({(t, k + 1): path(l) for k, l in enumerate(best)})
    turns = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    for r in chat.format_trees(turns, best=2).collect():
        nodes = want.pop((r.tree, r["rank"]))
        assert [t for _, t in chat.read_back(r.formatted)] == [f"x{i}" for i in nodes]
        assert [r.formatted[m.start : m.end] for m in r.mask] == [f"x{i}" for i in nodes if i % 2]
    assert not want


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (None, 3, None, "b"), (2, 5, "assistant", "x" * 200_000), (2, 4, "tool", "")]
    table = spark.createDataFrame([(*r, "k", "n") for r in rows], "conv_id long, turn long, role string, text string, key string, rank string")
    got = {r.conv_id: r for r in chat.digests(chat.format_trees(chat.chains(table))).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 2}
    told = "user\na\nuser\na\nassistant\n\n"
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest() and got[1].loss_chars == 0
    assert got[2].loss_sha256 == hashlib.sha256(b"x" * 200_000).hexdigest()
    assert chat.digests(chat.format_trees(chat.chains(table.where("false")))).collect() == []


def test_fm_index_counts():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 4, 600)
    index = fm_index.FMIndex(text, 4, 12)
    for size in (1, 2, 5, 12):
        for _ in range(40):
            at = rng.integers(0, 600 - size)
            pattern = text[at : at + size] if rng.random() < 0.7 else rng.integers(1, 4, size)
            if 0 in pattern:
                continue
            low, high = np.array([0]), np.array([index.size])
            for s in pattern[::-1]:
                low, high = index.extend(np.array([s]), low, high)
            plain = sum(np.array_equal(text[k : k + size], pattern) for k in range(600 - size + 1))
            assert max(0, high[0] - low[0]) == plain


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 500 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in touched}


def brute(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            scored = [(-(x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)), i) for i, y in ok if i != q and len(y) == len(x)]
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).round(3).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[50][1]) for i in range(300)]  # copies of one vector
    rows += [(3000, None), (3050, [0.0] * 16), (3100, [float("nan")] + [1.0] * 15), (3150, [None] + [1.0] * 15), (3200, []), (None, rows[0][1]), (3250, [1.0, 2.0]), (3300, [2.0, 1.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cell string")
    got = {}
    for r in ann.neighbours(table).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    want = brute(rows, 5, 50)
    assert set(got) == {q for q, w in want.items() if w}
    hit = sum(len(set(got[q].values()) & set(want[q])) for q in got)
    assert hit >= 0.9 * sum(len(want[q]) for q in got)
    assert [got[50][k] for k in range(1, 6)] == [2000, 2001, 2002, 2003, 2004]
    assert got[3250] == {1: 3300}
    assert ann.neighbours(table.where("false")).collect() == []


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()]
    want = brute(rows, 5, 50)
    got = {}
    for r in ann.neighbours(table).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_chi_square():
    # the median of two degrees of freedom is 2 ln 2
    assert ann.chi_square(0.5, 2) == pytest.approx(2 * np.log(2))
    assert ann.chi_square(0.95, 8) == pytest.approx(15.507, abs=1e-3)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{{}}</style><script>x="<p>no</p>";</script></head><body class="banner-page">
<header><p>Site</p></header><nav><ul><li><a href="/a">A</a></li><li>B</li></ul></nav><div class="cookie-notice">cookies</div>{0}
<aside>side</aside><section id="comments"><p>nice!</p></section><form><p>mail</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text():
    inner = "<article><header><h1>Big &lt;title&gt;</h1></header><p>One\n  two&nbsp;<b>th</b>ree<br>four<p>Five<div class='ad'>buy</div><ul><li>x<li>y</ul><!-- c --><aside>no</aside><section class=comments>no</section></article>"
    want = "Big <title>\n\nOne two three four\n\nFive\n\nx\n\ny"
    assert html_text.main_text(PAGE.format(inner), set()) == want
    assert html_text.main_text(PAGE.format("<div><p>Plain &eacute;</p>tail</div>"), set()) == "Plain é\n\ntail"
    for odd in ("", "   ", "<", "<p", "a < b", "<script>", "<!-- open", "</p></div>", "<p>x", "<div " + "a" * 10_000):
        html_text.main_text(odd, set())
    assert html_text.main_text("a < b & c", set()) == "a < b & c"
    assert len(html_text.main_text("<p>" + "word " * 100_000, set())) == 499_999


def test_wrappers_find_the_template(spark):
    """Text that all pages of a host repeat outside an article is template, and goes."""
    pages = [(i, f"http://h{i % 2}.example/{i}", f"<body><div><p>Welcome to host {i % 2}</p></div><div>{''.join(f'<p>text {i} {k}</p>' for k in range(1 + i % 3))}</div></body>") for i in range(12)]
    pages += [(100, "http://h0.example/x", None), (101, None, "<p>alone</p>"), (102, "no host", ""), (0, pages[0][1], pages[0][2])]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string").repartition(5)
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(table).collect())
    want = sorted([(i, "\n\n".join(f"text {i} {k}" for k in range(1 + i % 3))) for i in [*range(12), 0]] + [(100, ""), (101, "alone"), (102, "")])
    assert got == [(i, t, len(t)) for i, t in want]
    known = {r.host: r.wrapper for r in html_text.wrappers(table).collect()}
    assert "Welcome to host 1" in known["h1.example"] and "+" in html_text.expression(__import__("json").loads(known["h1.example"]))
    assert html_text.extract(table.where("false")).collect() == []


def test_pipeline_stages(spark, odd):
    docs = documents(spark, [(i, t, l, s) for i, t, l, s in odd if i is not None])
    sf = "/root/testdata/sf0.001"
    columns = list(corpus_pipeline.DOCUMENT)
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = corpus_pipeline.keep(stage(spark, before, sf), name)
        if name != "mixing":
            assert kept.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()} >= {10, 11, 12, 15}
        if name == "jaccard_join":
            rows = [(r.doc_id, r.text, None, None) for r in before.collect()]
            want = sorted(int(i) for i, _, c in linked(rows, 5, 80) if i == c)
            assert sorted(r.doc_id for r in kept.collect()) == want
        if name == "mixing":
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_empty(spark):
    kept = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, "/root/testdata/sf0.001")
    assert kept.collect() == []


def test_marked_boxes_and_attributes():
    """Boxes are marked by their own attributes, and hide neither an article nor most of a page."""
    body = "<p>The whole text of this page, which is longer than what stands beside it.</p>"
    text = "The whole text of this page, which is longer than what stands beside it."
    for box in ("div class='elementor-widget-container'", "div class=has-sidebar", "section id='related-work'", "div style='overflow: hidden'", "div title=\"hidden gems\"", "div data-state='hidden'", "div class='widget'", "form"):
        name = box.split()[0]
        assert html_text.main_text(f"<article><h1>T</h1><{box}>{body}</{name}></article>", set()) == f"T\n\n{text}", box
        assert html_text.main_text(f"<{box}><nav>n</nav><article>{body}</article></{name}>", set()) == text, box
        assert html_text.main_text(f"<{box}>{body}</{name}>", set()) == text, box
    assert html_text.main_text(f"<div class='widget'><article>{body}</article></div><div>{body * 3}</div>", set()).startswith(text)
    for box in ("div hidden", "div class='big ad'", "div class='cookie-notice'", "div id=socialShare", "form", "div role=form"):
        assert html_text.main_text(f"<article>{body}<{box}>beside</{box.split()[0]}></article>", set()) == text, box
    assert html_text.main_text(f"<article>{body}</article><div id=comments>{'<article>long</article>' * 90}</div>", set()) == text
    formula = "<article><p>As <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"
    assert html_text.main_text(formula, set()) == "As a=2 holds."


def test_compound_boxes():
    """The first or last word of a compound class marks a box, inside an article and on plain pages; other names do not."""
    body = "<p>The whole text of this page, which is longer than what stands beside it.</p>"
    text = "The whole text of this page, which is longer than what stands beside it."
    names = "comments comment-list comments-area user-comments comment-body related-posts share-buttons site-footer ad-slot cookie-bar sidebar-left newsletter-box nav-links"
    for name in names.split():
        for kind in ("class", "id"):
            box = f"<div {kind}='{name}'><p>beside the text</p></div>"
            assert html_text.main_text(f"<article><h1>T</h1>{body}{box}</article>", set()) == f"T\n\n{text}", name
            assert html_text.main_text(f"<h1>T</h1>{box}{body}", set()) == f"T\n\n{text}", name
            assert html_text.main_text(f"<div {kind}='{name}'>{body}</div><p>short</p>", set()).startswith(text), name
    for name in ("has-sidebar", "no-comments", "hero-banner", "title-banner", "related-work", "elementor-widget", "content", "entry-body", "advance", "headline"):
        assert html_text.main_text(f"<article>{body}<div class='{name}'><p>of the text</p></div></article>", set()) == f"{text}\n\nof the text", name
    for name in ("comments-on-the-treaty", "history-of-advertising", "cookie-recipes"):
        assert html_text.main_text(f"<article>{body}<section id='{name}'><p>of the text</p></section></article>", set()) == f"{text}\n\nof the text", name


def test_title_before_the_article():
    body = "<article><p>The whole text of this page.</p></article>"
    assert html_text.main_text(f"<h1>Other</h1><div><h1>Title</h1><p>by A</p></div>{body}<h1>after</h1>", set()) == "Title\n\nThe whole text of this page."
    assert html_text.main_text("<h1>Site</h1>" + body.replace("<p>", "<h1>Own</h1><p>"), set()) == "Own\n\nThe whole text of this page."


def test_repeats_of_any_length():
    """A group of any length is found as repeated; runs are the ones that a comparison of all places finds."""
    row = [["<tr>", None, 1, 0, 0], *[x for k in range(40) for x in ([f"<td.c{k}>", None, 1, 0, 0], [f"#td.c{k}", str(k), 1, 0, 0], [f"</td.c{k}>", None, 1, 0, 0])], ["</tr>", None, 1, 0, 0]]
    folded = html_text.fold_repeats([list(x) for _ in range(5) for x in row])
    assert [x[0] for x in folded] == [x[0] for x in row] and all(x[4] for x in folded)
    rng = np.random.default_rng(3)
    for _ in range(200):
        kinds = rng.integers(0, 2, rng.integers(2, 30))
        for size in range(1, len(kinds) // 2 + 1):
            want = [i for i in range(len(kinds) - 2 * size + 1) if (kinds[i : i + size] == kinds[i + size : i + 2 * size]).all()]
            assert html_text._squares(kinds, size).tolist() == want


def test_template_counts_distinct_pages(spark):
    """Copies of a page are one page, and template is what most pages of the host repeat, be they two."""
    pages = [(i, f"http://big.example/{i}", f"<div><p>Big host</p></div><section><p>text {i}</p></section>") for i in range(12)]
    quoted = "<div><p>Big host</p></div><section><p>quoting</p></section><blockquote>quoted words</blockquote><h3>part</h3>"
    pages += [(100 + k, f"http://big.example/copy{k}", quoted) for k in range(4)]
    pages += [(200 + k, f"http://same.example/{k}", "<div><p>one page</p></div><section><p>many times</p></section>") for k in range(5)]
    pages += [(300 + k, f"http://two.example/{k}", f"<div><p>Two pages</p></div><section><p>text {k}</p></section>") for k in range(2)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.extract(table).collect()}
    want = {i: f"text {i}" for i in range(12)} | {100 + k: "quoting\n\nquoted words\n\npart" for k in range(4)}
    want |= {200 + k: "one page\n\nmany times" for k in range(5)} | {300: "text 0", 301: "text 1"}
    assert got == want


def test_template_decides_with_articles(spark):
    """Template goes from articles too, and articles that are cards do not displace the text."""
    notice = "<p>All rights to this text are with the host.</p>"
    pages = [(i, f"http://n.example/{i}", f"<article>{''.join(f'<p>text {i} {k}</p>' for k in range(1 + i % 4))}{notice}</article>") for i in range(9)]
    pages += [(20 + i, f"http://d.example/{i}", f"<article><div>Note</div><h1>title {i}</h1></article>") for i in range(5)]
    long = "Long main text of the page, in an element that says nothing of itself."
    pages += [(40 + i, f"http://c.example/{i}", f"<div><p>{long} {i}</p></div><div>{''.join(f'<article><h3>card {i} {k}</h3></article>' for k in range(3))}</div>") for i in range(4)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.extract(table).collect()}
    want = {i: "\n\n".join(f"text {i} {k}" for k in range(1 + i % 4)) for i in range(9)} | {20 + i: f"title {i}" for i in range(5)}
    assert got == want | {40 + i: f"{long} {i}" for i in range(4)}
