"""Main text of web pages by consensus among the pages of a host.

First pass: each page is cut into text blocks with their container path (tags
with classes, digits generalised); menus, footers, adverts, forms, scripts,
comments and the like are left out by tag, role or a word of class or id;
inside article and main elements by tag, role or a whole class name only, and
headings and paragraphs not by class at all.  A block's score is
its text outside links.  The page's vote is the deepest container that holds
all blocks inside its article or main elements, or, where these have less than
half of the score, all blocks that are text rather than links.  Spark counts
the votes for each host.
Second pass: where a page has no article, the path that most of its host's
pages vote for overrules the page's own, if more than half of the page's score
stands there; what lies beside it is a box that this page alone has.  Otherwise
a page's text is what stands under that of the host's winning paths which holds most of the page's score, the most voted first of equals; a
page of which none holds more than half, or the whole article if it has one,
falls back on its own vote.

The vote table has at most ``1 / min_share`` paths for each host and is
written, so the planner broadcasts it only where it is small; otherwise the
join shuffles by host and adaptive execution splits a host with many pages.

Defined cases: null or empty html gives an empty text; pages without a host
vote among themselves; unclosed and stray tags are tolerated as browsers do;
very long pages are read whole, in time linear in their length; repeated rows are kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_chunks, written
from tessera.llm.url_templates import host_path

# Element kinds and the class words of what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes svg object canvas audio "
          "video select annotation annotation-xml".split())
SKIP = set("nav footer aside form head dialog menu button fieldset".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var math semantics maction menclose merror mfenced mfrac mi "
             "mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
             "mtable mtd mtext mtr munder munderover".split())
HEADINGS = set("p h1 h2 h3 h4 h5 h6".split())
LEAF = set("p h1 h2 h3 h4 h5 h6 li dd dt pre blockquote tr td th thead tbody tfoot br hr ul ol dl table".split())
ARTICLE = set("article main post content entry story body text".split())
NOISE = set("ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent gdpr notice "
            "popup modal overlay newsletter subscribe signup login sidebar widget related recommended menu nav navbar "
            "navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies share "
            "sharing social toolbar pagination pager copyright legal skip hidden".split())
INNER_NOISE = NOISE - {"header", "masthead"}  # the header of an article holds its title
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_P_CLOSERS = LEAF | set("div article section main header footer nav aside form address figure".split())
_SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
          "td": {"tr", "table"}, "th": {"tr", "table"}}
_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT = re.compile(r">|->|.*?(?:-->|--!>|\Z)", re.S)
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


def _noise(tag: str, attrs: dict[str, str], inside_article: bool) -> bool:
    if tag in SKIP or (tag == "header" and not inside_article) or tag in RAW:
        return True
    if attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if inside_article:  # whole class tokens only; a heading's or a section's words are not the page's furniture
        names = set(attrs.get("class", "").lower().split())
        return tag not in HEADINGS and bool(names & INNER_NOISE) and not names & {"article", "main", "content"}
    # The id of a heading or paragraph is an anchor made of its words.
    words = {w.lower() for k in ("class", "id") if k == "class" or tag not in HEADINGS
             for w in _WORDS.findall(attrs.get(k, ""))}
    return bool(words & NOISE) and not words & {"article", "main", "content"}


def _attrs(raw: str) -> dict[str, str]:
    if "=" not in raw and "hidden" not in raw:
        return {}
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(raw)}


class Page:
    """Text blocks of a page and the tree of their container paths.

    ``parent[v]`` and ``step[v]`` give a path's last step and the path before
    it (0 is the empty path); ``blocks`` holds (path, text, score).
    """

    def __init__(self) -> None:
        self.parent, self.step, self.article = [0], [""], [False]
        self.kids: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, float]] = []

    def child(self, at: int, step: str) -> int:
        v = self.kids.setdefault((at, step), len(self.parent))
        if v == len(self.parent):
            self.parent.append(at)
            self.step.append(step)
            self.article.append(self.article[at] or step.split(".")[0] in ("article", "main"))
        return v

    def path(self, v: int) -> str:
        steps = []
        while v:
            steps.append(self.step[v])
            v = self.parent[v]
        return "/".join(reversed(steps))

    def find(self, path: str) -> int | None:
        v: int | None = 0
        for step in path.split("/") if path else ():
            v = self.kids.get((v, step))
            if v is None:
                return None
        return v

    def under(self, v: int | None, some: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
        """Those of the blocks whose path is or continues path ``v``."""
        if v is None:
            return []
        held = [False] * len(self.parent)
        for u in range(v, len(held)):  # a path comes after the one before it
            held[u] = u == v or (u > 0 and held[self.parent[u]])
        return [x for x in some if held[x[0]]]


def _tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" of a closing tag, name, attributes) of tags; comments and
    declarations have an empty name.  Send a position to go on from there.

    A ``>`` inside quotes does not end a tag, unless none outside would.  The
    quotes met on the way to the end of the page in vain are kept in
    ``endless``, so no part of a page is read again for each of its tags.
    """
    at, last = 0, html.rfind(">")
    endless: set[int] = set()
    while m := _OPEN.search(html, at):
        start, at, name = m.start(), m.end(), ""
        raw = ""
        if m[1]:
            at = _COMMENT.match(html, at).end()
        elif m[2]:
            end = html.find("]]>", at)
            at = end + 3 if end >= 0 else len(html)
        elif m[3]:
            end = html.find(">", at)
            at = end + 1 if end >= 0 else len(html)
        else:
            if at > last:
                return
            name, i, opened = m[5].lower(), at, []
            while True:
                i = _UNQUOTED.match(html, i).end()
                if i < len(html) and html[i] == ">":
                    break
                close = html.find(html[i], i + 1) if i < len(html) and i not in endless else -1
                opened.append(i)
                if close < 0:
                    endless.update(opened)
                    i = html.find(">", at)
                    break
                i = close + 1
            raw, at = html[at:i], i + 1
        onward = yield start, at, m[4] or "", name, raw
        if onward is not None:
            at = onward


def blocks(html: str | None) -> Page:
    """The page's blocks outside of noise, in time linear in its length."""
    page = Page()
    stack: list[tuple[str, int, bool, bool]] = []  # tag, path, noise begins here, article begins here
    places: dict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    solid: list[int] = []  # places of the tags that are not inline
    noisy = article = links = 0
    buf: list[str] = []
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if buf:
            text = _SPACE.sub(" ", unescape("".join(buf))).strip()
            if text:
                page.blocks.append((stack[-1][1] if stack else 0, text, float(max(1, len(text) - link_chars))))
            buf.clear()
        link_chars = 0

    def pop(to: int) -> None:
        nonlocal noisy, article, links
        while len(stack) > to:
            tag, _, noise, begins = stack.pop()
            places[tag].pop()
            if tag not in INLINE:
                solid.pop()
            noisy -= noise
            article -= begins
            links -= tag == "a"

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def near(tags, scope=()) -> int:
        """Place of the innermost open element among tags, not beyond scope; -1 if none."""
        i = last(tags)
        return i if i > max(last(scope), last(("body", "html"))) else -1

    if not html:
        return page
    at, n = 0, len(html)
    tags = _tags(html)
    onward = None
    while True:
        try:
            start, end, closing, tag, raw = tags.send(onward)
        except StopIteration:
            start, end, closing, tag, raw = n, n, "", "", ""
        onward = None
        if start > at and not noisy:
            text = html[at:start]
            buf.append(text)
            if links:
                link_chars += len(text)
        at = end
        if start == n:
            break
        if not tag:
            continue
        if closing:
            if tag in INLINE:
                i = last((tag,))
                if i > (solid[-1] if solid else -1):
                    pop(i)
                continue
            i = last((tag,))
            flush()
            if i >= 0:
                pop(i)
            continue
        if tag not in INLINE and tag not in RAW:
            flush()
            if tag in _P_CLOSERS and tag not in ("br", "hr"):
                i = near(("p",), ("table", "td", "article", "section", "div", "button"))
                if i >= 0:
                    pop(i)
            if tag in _SAME:
                i = near(_SAME[tag], _SCOPE.get(tag, ()))
                if i >= 0:
                    pop(i)
        if tag in VOID:
            continue
        if tag in RAW:
            if not raw.endswith("/") or tag in ("script", "style", "title", "textarea"):
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = onward = close.end() if close else n
            continue
        if tag in ("head", "html", "body") and places.get(tag):
            continue
        if tag == "body" or (tag not in ("html", "head") and stack and stack[-1][0] == "head" and
                             tag not in ("base", "link", "meta")):
            i = near(("head",))
            if i >= 0:
                pop(i)
        if raw.endswith("/") and tag in INLINE:
            continue
        attrs = _attrs(raw)
        noise = _noise(tag, attrs, article > 0)
        path = stack[-1][1] if stack else 0
        if tag not in INLINE and tag not in LEAF:
            names = sorted({_DIGITS.sub("#", c) for c in attrs.get("class", "").split()})
            path = page.child(path, ".".join([tag, *names]).replace("/", "|"))
        if tag not in INLINE:
            solid.append(len(stack))
        places[tag].append(len(stack))
        stack.append((tag, path, noise, tag in ("article", "main")))
        noisy += noise
        article += tag in ("article", "main")
        links += tag == "a"
    flush()
    return page


def wanted(page: Page) -> tuple[list[tuple[int, str, float]], bool]:
    """The blocks that the page's container must hold, and whether they are
    those of its article or main elements: these if they hold at least half of
    the score, else all blocks that are text rather than links."""
    inside = [x for x in page.blocks if page.article[x[0]]]
    if inside and 2 * sum(s for _, _, s in inside) >= sum(s for _, _, s in page.blocks):
        return inside, True
    return [x for x in page.blocks if 2 * x[2] >= len(x[1])] or page.blocks, False


def _own(page: Page, need: list[tuple[int, str, float]]) -> int:
    """The deepest path that holds all the blocks."""
    held = [0] * len(page.parent)
    for v, _, _ in need:
        held[v] += 1
    for v in range(len(held) - 1, 0, -1):
        held[page.parent[v]] += held[v]
    return max((v for v, k in enumerate(held) if k == len(need)), default=0) if need else 0


def best_path(page: Page) -> str:
    """The deepest container path that holds all the wanted blocks."""
    return page.path(_own(page, wanted(page)[0]))


def choose(page: Page, winners: list[str] | None, major: str | None = None) -> int:
    """The path ``major`` that most of the host's pages vote for, if the page has
    no article and more than half of its wanted score stands there.  Else the
    winning path that holds most of the score of the page's wanted
    blocks, the most voted one of equals; the page's own vote if none holds
    more than half.  Of an article every block must be held, and the path must
    lie in it unless the page's own vote lies above it too."""
    need, article = wanted(page)
    own = _own(page, need)
    total = sum(s for _, _, s in need)
    best, most = own, 0.5 * total
    if major is not None and not article:
        v = page.find(major)
        if sum(s for _, _, s in page.under(v, need)) > most:
            return v
    for v in map(page.find, winners or []):
        held = sum(s for _, _, s in page.under(v, need))
        if held > most and not (article and (held < total or page.article[v] != page.article[own])):
            best, most = v, held
    return best


def extract(html: str | None, winners: list[str] | None, major: str | None = None) -> str:
    page = blocks(html)
    return " ".join(text for _, text, _ in page.under(choose(page, winners, major), page.blocks)) if page.blocks else ""


def extract_main_text(pages: DataFrame, min_share: float = 0.05, min_votes: int = 4, id_col: str = "page_id",
                      url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, host, text, n_chars) for every page.

    A path with more than half of a host's votes, and at least ``min_votes`` of
    them, overrules the own vote of the host's pages without an article.
    """
    host, _ = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"),
                        F.col(html_col).alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [None if not (page := blocks(h.as_py())).blocks else best_path(page) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, type=pa.string())],
                                             names=["host", "path"])

    votes = (rows.select("host", "html").mapInArrow(vote, "host string, path string")
             .where("path is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    total = votes.groupBy("host").agg(F.sum("n").alias("total"))
    winners = (votes.join(total, "host").where(F.col("n") >= min_share * F.col("total")).groupBy("host")
               .agg(F.sort_array(F.collect_list(F.struct("n", "path")), asc=False)["path"].alias("winners"),
                    F.max(F.when((2 * F.col("n") > F.col("total")) & (F.col("n") >= min_votes), F.col("path")))
                    .alias("major")))
    winners = written(winners, "html-winners")

    id_type = rows.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, known, major = (batch.column(i) for i in (3, 4, 5))
            for a, b in text_chunks([h.as_py() for h in html]) if len(html) else ():
                texts = [extract(html[i].as_py(), known[i].as_py(), major[i].as_py()) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(3)], pa.array(texts, type=pa.string())],
                    names=["page_id", "url", "host", "text"])

    joined = rows.join(winners, "host", "left").select("page_id", "url", "host", "html", "winners", "major")
    return (joined.mapInArrow(read, f"page_id {id_type}, url string, host string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
