"""HTML extraction with union-free wrappers inferred per host.

A page becomes a stream of block tags and texts.  Pages of one host are
aligned one after the other: equal tags match, different texts at one place
become a slot, a run that follows itself becomes a repeated group, and what
only one side has becomes optional.  The result, a regular expression
without unions, tells the host's template (texts that every page repeats)
from its slots.  Wrappers of parts of a host are aligned with each other in
the same way, so a host's pages never meet in one task.

A page's main text is the text of slots, less menus, headers, footers and the
like.  Articles are a hint only: they are the main region if they hold at
least as much of that text as the rest of the page.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import by_value, keep

#: HTML's element kinds.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br",
    "math", "semantics", "annotation", "annotation-xml", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom",
    "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mlabeledtr", "mtd", "maction",
}
ARTICLE = {"article", "main"}
#: Elements and roles of what is not main text.
ASIDE = {"nav", "footer", "aside", "button", "select", "option", "svg", "canvas", "audio", "video", "object", "head", "dialog", "menu"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "dialog", "alert", "menu", "menubar"}
#: Elements and roles that are not main text unless they hold most of the page; they never hide an article.
FORMS, FORM_ROLES = {"form", "fieldset"}, {"form", "search"}
#: Words of classes or ids that name a box beside the main text, unless it holds most of the page.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation",
    "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "topbar", "cookie", "cookies", "consent", "notice", "notices", "gdpr",
    "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended",
    "comment", "comments", "respond", "replies", "disqus", "pagination", "pager", "toolbar", "widget", "copyright", "disclaimer",
}
#: Class or id words that say so only outside an article, and those of boxes that may well be longer than the article.
OUTSIDE_MARKS = {"header"}
THREADS = {"comment", "comments", "respond", "replies", "disqus", "related", "recommended"}
#: What a new block element closes when it is still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that an implied end does not cross.
HOLDS = {"article", "main", "section", "div", "ul", "ol", "dl", "table", "td", "th", "blockquote", "body", "nav", "aside", "header", "footer", "form", "figure"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
PIECE = re.compile(r"[A-Za-z]+")
#: Of those words, the ones that qualify as often as they name: as a first word they need a part behind them, as a last word they name nothing.
VAGUE = {"related", "recommended", "social", "notice", "notices", "alert", "promotion", "subscription", "login", "disclaimer", "widget"}
#: Words for parts of a box, and for what a box belongs to.
PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "group", "icons", "inner", "item", "items", "left", "link", "links",
    "list", "main", "panel", "right", "row", "section", "slot", "stories", "text", "top", "unit", "wrap", "wrapper", "articles", "post", "posts", "news", "products", "topics", "pages",
}
OWNERS = {"site", "page", "main", "global", "left", "right", "top", "bottom", "primary", "secondary", "user", "reader", "post", "article", "entry", "mobile", "sticky"}
#: Words that say how something else looks (``has-sidebar``) or that a box holds the title.
STATES = {"has", "have", "no", "not", "with", "without", "is", "hide", "show", "hero", "title", "heading", "headline"}


def _marked(value: str, inside: bool, key: bool = False) -> set[str]:
    """Words that mark the class tokens, or the id (``key``), as a box beside the main text.

    A token marks when it is made of such words alone, or when its first or
    last word is one (``comment-list``, ``site-footer``; not ``has-sidebar``).
    Ids are often made from headings, so the other words of an id must name a
    part or an owner of the box.
    """
    found = set()
    for token in value.split():
        words = [p.lower() for p in PIECE.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token))]
        if not words:
            continue
        if set(words) <= (MARKS if inside else MARKS | OUTSIDE_MARKS):
            found |= set(words)
        elif not STATES & set(words):
            first, last = words[0], words[-1]
            if first in MARKS and (set(words[1:]) <= PARTS | MARKS or not key and first not in VAGUE):
                found.add(first)
            if last in MARKS - VAGUE and (not key or set(words[:-1]) <= OWNERS | MARKS) or last in OUTSIDE_MARKS and not inside and words[0] == "site":
                found.add(last)
    return found


def _labels(attributes: str, inside: bool) -> tuple[str, bool, bool, set[str]]:
    """First class or id; whether hidden or of a role beside the main text; whether of a form's role; words that mark class or id."""
    name, hidden, form, marks, met = "", False, False, set(), set()
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = (m.group(1) or "").lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if kind not in ("class", "id", "role", "hidden") or kind in met:
            continue
        met.add(kind)
        if kind == "hidden":
            hidden = True
        elif kind == "role":
            hidden |= value.strip().lower() in ROLES
            form |= value.strip().lower() in FORM_ROLES
        else:
            name = name or value.strip().split(" ")[0].lower()
            marks |= _marked(html.unescape(value), inside, kind == "id")
    return name, hidden, form, marks


class Block(NamedTuple):
    """A text and its path; the outermost article or main it lies in (0: none), whether it is beside the main text, the marked boxes around it."""

    path: str
    text: str
    article: int
    aside: bool
    boxes: tuple[int, ...]


class Page:
    """Blocks of a page and its token stream."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.items: list[tuple[str, str | None]] = []
        #: of each marked box, whether it may be longer than the article; of each article, its name and the boxes around it
        self.threads: list[bool] = []
        self.articles: list[tuple[str, tuple[int, ...]]] = [("", ())]
        stack: list[tuple[str, str, int, bool, tuple[int, ...]]] = []
        self.text: list[str] = []
        at = 0
        while True:
            m = TOKEN.search(source, at)
            self.text.append(source[at : m.start() if m else len(source)])
            if not m:
                break
            at = m.end()
            if m.group(2) is None:
                continue
            name = m.group(2).lower()
            if m.group(1):
                if name in INLINE:
                    continue
                self._flush(stack)
                if any(e[0] == name for e in stack):
                    while self._pop(stack) != name:
                        pass
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else len(source)
                if name not in INLINE:
                    self._flush(stack)
                continue
            if name in INLINE:
                if name == "br":
                    self.text.append(" ")
                continue
            self._flush(stack)
            if name in VOID:
                continue
            ends = CLOSES.get(name, set()) | {"p"} | ({"h1", "h2", "h3", "h4", "h5", "h6"} if name in {"p", "h1", "h2", "h3", "h4", "h5", "h6"} else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    while len(stack) > k:
                        self._pop(stack)
                elif stack[k][0] in HOLDS:
                    break
            if name == "body" or name == "html":
                # head and the like end where the body begins
                while stack and stack[-1][0] == "head":
                    self._pop(stack)
            article, aside, boxes = stack[-1][2:] if stack else (0, False, ())
            label, hidden, form, marks = _labels(m.group(3), article > 0)
            # a page's header is not main text, an article's own header is
            aside |= name in ASIDE or name == "header" and not article
            if name not in {"html", "body"} | ARTICLE:
                aside |= hidden
                if marks or form or name in FORMS:
                    boxes += (len(self.threads),)
                    self.threads.append(bool(marks & THREADS))
            elif name in ARTICLE and not article:
                article = len(self.articles)
                self.articles.append((name, boxes))
            step = f"{name}.{label}" if label else name
            stack.append((name, step, article, aside, boxes))
            self.items.append((f"<{step}>", None))
        self._flush(stack)

    def _pop(self, stack) -> str:
        name, step, *_ = stack.pop()
        self.items.append((f"</{step}>", None))
        return name

    def _flush(self, stack) -> None:
        text = " ".join(html.unescape("".join(self.text)).split())
        self.text = []
        if text:
            path = "/".join(e[1] for e in stack if e[0] not in ("html", "body"))
            self.blocks.append(Block(path, text, *(stack[-1][2:] if stack else (0, False, ()))))
            self.items.append((f"#{path}", text))


def _squares(kinds: np.ndarray, size: int) -> np.ndarray:
    """Where a run of ``size`` follows itself.  Such a place has a multiple of ``size`` within its run, so those are looked at first."""
    if not (kinds[:-size:size] == kinds[size::size]).any():
        return np.zeros(0, np.int64)
    same = np.concatenate([[0], np.cumsum(kinds[:-size] == kinds[size:])])
    return np.flatnonzero(same[size:] - same[:-size] == size)


def fold_repeats(items: list[list]) -> list[list]:
    """Runs of any length that follow themselves become one repeated group; its texts are slots unless all are alike."""
    size, kinds = 1, _numbered(items)
    while size <= len(items) // 2:
        places = _squares(kinds, size).tolist()
        again = set(places)
        out, i = [], 0
        for at in places:
            if at < i:
                continue
            j = at + size
            while j - size in again:
                j += size
            # a group is whole elements that open what they close; two alike that hold others may
            # as well be the template's box beside the content's, so those must come three times
            depth = _depth([x[0] for x in items[at : at + size]])
            if depth >= 0 and j >= at + size * (2 if depth < 2 else 3):
                group = [list(x) for x in items[at : at + size]]
                for a in range(at + size, j, size):
                    for k in range(size):
                        _merge(group[k], items[a + k], same_page=True)
                for x in group:
                    x[4] = 1
                out += items[i:at] + group
                i = j
        if i:
            items, size = out + items[i:], 1
            kinds = _numbered(items)
        else:
            size += 1
    return items


def _numbered(items: list[list]) -> np.ndarray:
    """A number for each item's sign."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(x[0], len(known)) for x in items], np.int64)


def _depth(signs: list[str]) -> int:
    """How deep elements stand in each other; -1 if the run does not close what it opens."""
    depth = most = 0
    for s in signs:
        depth += s.startswith("<") and not s.startswith("</")
        depth -= s.startswith("</")
        if depth < 0:
            return -1
        most = max(most, depth)
    return most if depth == 0 else -1


def _merge(a: list, b: list, same_page: bool = False) -> None:
    """Items are [sign, template text or None for a slot, pages, optional, repeated]."""
    if a[1] != b[1]:
        a[1] = None
    a[2] = max(a[2], b[2]) if same_page else a[2] + b[2]
    a[3] |= b[3]
    a[4] |= b[4]


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper that covers both: matches merged, the rest optional, repeats folded."""
    if [x[0] for x in a] == [x[0] for x in b]:
        for x, y in zip(a, b, strict=True):
            _merge(x, y)
        return a
    out = []
    for tag, i, j, k, l in SequenceMatcher(None, [x[0] for x in a], [x[0] for x in b], autojunk=False).get_opcodes():
        if tag == "equal":
            for x, y in zip(a[i:j], b[k:l], strict=True):
                _merge(x, y)
            out += a[i:j]
        else:
            for x in a[i:j] + b[k:l]:
                x[3] = 1
                out.append(x)
    return fold_repeats(out)


def expression(wrapper: list[list]) -> str:
    """The wrapper as a regular expression in words: # a slot, (..)? optional, (..)+ repeated."""
    out = []
    for sign, text, _, optional, repeated in wrapper:
        part = sign if sign[0] == "<" else (f"#{sign}" if text is None else repr(text))
        out.append(f"({part}){'*' if optional and repeated else '?' if optional else '+'}" if optional or repeated else part)
    return " ".join(out)


def agreed(n: int, pages: int) -> bool:
    """Whether n of a host's distinct pages are most of them; one page alone tells nothing."""
    return n >= 2 and 2 * n > pages


def place(path: str, text: str) -> int:
    """A 64-bit number for a text at a path."""
    return int.from_bytes(blake2b(f"{path}\n{text}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def template(wrapper: list[list], pages: int) -> set[int]:
    """Places and texts that most of the host's distinct pages have, where all that have them agree."""
    return {place(sign[1:], text) for sign, text, n, _, _ in wrapper if text is not None and agreed(n, pages) and sign[0] == "#"}


def repeated(wrapper: list[list]) -> set[str]:
    """Paths of repeated groups whose texts differ; a template text may stand among them."""
    return {sign[1:] for sign, text, _, _, many in wrapper if many and text is None and sign[0] == "#"}


def shown(page: Page, blocks: list[Block]) -> list[Block]:
    """Of a page's varying blocks, those that no marked box hides.

    A box that holds most of the varying text hides nothing, unless it is a
    thread beside an article; and no box hides a page's only article.
    """
    held, total = Counter(), sum(len(b.text) for b in blocks)
    for b in blocks:
        for x in b.boxes:
            held[x] += len(b.text)
    plain = any(b.article and not b.boxes for b in blocks)
    open_ = {x for x, n in held.items() if 2 * n > total and not (plain and page.threads[x])}
    return [b for b in blocks if all(x in open_ or not plain and x in page.articles[b.article][1] for x in b.boxes)]


def main_text(source: str, fixed: set[int], lists: dict[str, set[int]] | None = None) -> str:
    """The page's main text, blocks joined by an empty line.

    ``fixed``: the host's template.  ``lists``: of paths that repeat, the
    texts that most pages of the host hold there.
    """
    page = Page(source)
    lists = lists or {}
    blocks = []
    for b in page.blocks:
        if not b.aside:
            at = place(b.path, b.text) if fixed or b.path in lists else None
            if at is None or at not in fixed and at not in lists.get(b.path, ()):
                blocks.append(b)
    return "\n\n".join(b.text for b in region(page, shown(page, blocks)))


def _title(block: Block) -> bool:
    return re.split(r"[./]", block.path.rsplit("/", 1)[-1])[0] == "h1"


def region(page: Page, blocks: list[Block]) -> list[Block]:
    """Of the blocks shown, those of the main region.

    Articles are the region if they hold at least as much as the rest, with
    the title before them if they have none of their own.  If not, the rest is
    it, with the article if there is only one; several are cards beside the
    text.
    """
    inside = [b for b in blocks if b.article]
    rest = [b for b in blocks if not b.article]
    if sum(len(b.text) for b in inside) >= sum(len(b.text) for b in rest):
        before = blocks[: blocks.index(inside[0])] if inside else []
        titles = [] if any(_title(b) for b in inside) else [b for b in before if _title(b)]
        return titles[-1:] + inside
    cards = {b.article for b in inside if page.articles[b.article][0] == "article"}
    return [b for b in blocks if len(cards) < 2 or b.article not in cards]


def _per_task(batches):
    """A wrapper for each host among this task's pages, and how many pages it covers; on how many of them each text stands at its path."""
    hosts: dict[str, list] = {}
    texts: Counter = Counter()

    def out():
        n, m = len(hosts), len(texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*hosts, *(host for host, _ in texts)], pa.string()),
                pa.concat_arrays([pa.array([json.dumps(w) for w, _ in hosts.values()], pa.string()), pa.nulls(m, pa.string())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([at for _, at in texts], pa.int64())]),
                pa.array([*(k for _, k in hosts.values()), *texts.values()], pa.int64()),
            ],
            names=["host", "wrapper", "at", "pages"],
        )

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            page = Page(source.as_py())
            if not page.items:
                continue
            w = fold_repeats([[sign, text, 1, 0, 0] for sign, text in page.items])
            known, n = hosts.get(host, (None, 0))
            hosts[host] = (w if known is None else align(known, w), n + 1)
            texts.update({(host, place(b.path, b.text)) for b in page.blocks if not b.aside})
            if len(hosts) >= 2000 or len(texts) >= 200_000:
                yield from out()
                hosts, texts = {}, Counter()
    yield from out()


def _join(table):
    """One wrapper of a group's wrappers."""
    whole, pages = None, 0
    for row in table.sort_by("wrapper").to_pylist():
        w = json.loads(row["wrapper"])
        whole = w if whole is None else align(whole, w)
        pages += row["pages"]
    return pa.table({"host": table.column("host").slice(0, 1), "wrapper": pa.array([json.dumps(whole)]), "pages": pa.array([pages], pa.int64())})


def host_of(url: Column) -> Column:
    """The url's host in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def distinct_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host html``: every page of a host once.  Only pages that have copies are shuffled, after partial aggregation."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("html is not null")
    rows = rows.withColumn("digest", F.sha2("html", 256))
    copies = keep(rows.groupBy("host", "digest").count().where("count > 1").select("host", "digest"), "copies")
    once = rows.join(copies, ["host", "digest"], "left_semi").groupBy("host", "digest").agg(F.min("html").alias("html"))
    return rows.join(copies, ["host", "digest"], "left_anti").select("host", "html").union(once.select("host", "html"))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", fan: int = 32) -> DataFrame:
    """``host wrapper pages common`` for each host.

    ``wrapper``: inferred from all distinct pages, as JSON; ``pages``: their
    number, without those that hold no element or text; ``common``: texts
    that most of them hold at one path, see ``place``.
    """
    kinds = "host string, wrapper string, pages long"
    parts = keep(distinct_pages(pages, url_col, html_col).mapInArrow(_per_task, "host string, wrapper string, at long, pages long"), "wrappers")
    now = parts.where("wrapper is not null").select("host", "wrapper", "pages")
    total = now.groupBy(F.col("host").alias("of")).agg(F.sum("pages").alias("total"))
    common = parts.where("wrapper is null").groupBy("host", "at").agg(F.sum("pages").alias("n")).where("n >= 2")
    common = common.join(total, F.col("host") == F.col("of")).where(F.col("n") * 2 > F.col("total"))
    common = keep(common.groupBy(F.col("host").alias("of")).agg(F.sort_array(F.collect_list("at")).alias("common")), "common")
    # a host's wrappers meet in groups of about fan, until one is left
    while True:
        most = now.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most > 1:
            salt = F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // fan))).alias("salt")
            now = keep(now.select("host", "wrapper", "pages", salt).groupBy("host", "salt").applyInArrow(_join, kinds), "wrappers")
        if most <= fan:
            return now.join(common, F.col("host") == F.col("of"), "left").select("host", "wrapper", "pages", "common")


def _extracted(batches):
    hosts: dict[str, tuple[set, dict]] = {}
    for batch in batches:
        texts = []
        for source, host, wrapper, pages, common in zip(*(batch.column(c) for c in ("html", "host", "wrapper", "pages", "common")), strict=True):
            host = host.as_py()
            if host not in hosts:
                if len(hosts) > 200:
                    hosts.clear()
                w = json.loads(wrapper.as_py() or "[]")
                at = set(common.as_py() or ())
                hosts[host] = template(w, pages.as_py() or 0), dict.fromkeys(repeated(w), at) if at else {}
            texts.append(main_text(source.as_py() or "", *hosts[host]))
        rest = ["page_id", "url"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id url text n_chars`` for every row of ``pages``.

    Character references are decoded, white space within a block becomes one
    space, blocks follow in page order, joined by two newlines; nothing else is
    dropped or capped.

    A null or empty page has an empty text; a null url, or one without a
    host, belongs to the host named "".  Repeated rows are pages of their
    own.  An empty table gives an empty result; other columns are not read.
    """
    known = wrappers(pages, url_col, html_col)
    known = known.select(F.col("host").alias("of"), "wrapper", "pages", "common")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    met = rows.join(known, F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "host", "wrapper", "pages", "common")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return met.mapInArrow(_extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


by_value(__name__)
