"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks with their place in the element tree.  A
linear classifier gives each block a cost for the label it does not look like
(element and class cues, link density, length, punctuation); these costs are
the capacities of the edges to the terminals.  Neighbouring blocks and
neighbouring blocks of one parent element are joined by smoothness edges.  The
minimum cut, found by maximum flow, separates content from boilerplate, so that
a short heading between paragraphs follows them and a lone sentence between
menu links does not.

Blocks outside an article lose only if the page's largest article holds at
least as much text as the blocks outside that look like content by themselves;
otherwise (a teaser card beside the text) nothing is taken from them.  Blocks
below a content class gain.  Short blocks between two content blocks, those that
follow one in the same element and short items of lists and tables without links
lose nothing for being short, so a run of them stays with the text around it,
however long.

Class and id names are judged one by one.  A name that consists of boilerplate
words, content words and frame words only (``post-comments``, ``sidebar-content``,
``ad``) or holds a word with no other use (``newsletter``) marks its element as
boilerplate, inside articles too, whatever content words stand beside it.  A name
that joins an ambiguous word with any other (``share-price``, ``related-work``) is
weak evidence, which takes no block of an article by itself.  Names that only tell
of a state or a category (``has-sidebar``, ``tag-social``) say nothing.

Pages are only mapped; a page's graph has as many nodes as blocks and at most
two edges a block.  Scripts, styles, comments, forms' controls and hidden parts
never become blocks.

Defined cases: null or empty html gives empty text; an empty table gives no row;
unclosed and stray tags, unfinished comments and bare ``<`` follow HTML's rules; a
block whose cut ties (cost 0 on either side) goes with the content it is joined to,
else it goes; very long pages are one graph, cut whole; repeated rows are each
reported; extra columns are ignored, also those named like an output column.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import map_batches, table

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"))
VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
)
INLINE = frozenset(
    (
        "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
        "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
        "tt", "u", "var", "br", "img", "wbr", "ruby", "rt", "rp", "math", "mi", "mn", "mo", "ms", "mtext", "mrow",
        "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mstyle", "mpadded",
        "mspace", "mtable", "mtr", "mtd", "mmultiscripts", "menclose", "merror", "semantics", "annotation",
        "annotation-xml", "object",
    )
)
# annotations say the formula again
DROPPED = frozenset(
    ("head", "svg", "canvas", "audio", "video", "select", "button", "datalist", "annotation", "annotation-xml")
)
ENDS_ITSELF = {"li": "li", "dt": "dt", "dd": "dd", "option": "option", "tr": "tr", "td": "td", "th": "th"}
ITEMS = frozenset(("li", "dt", "dd", "td", "th", "caption"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

BOILER_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog"))
CONTENT_TAGS = frozenset(("article", "main"))
# of these, any name with one is boilerplate
PLAIN_WORDS = frozenset(
    (
        "advert", "advertisement", "breadcrumb", "breadcrumbs", "complementary", "contentinfo", "cookie", "cookies",
        "disqus", "masthead", "navbar", "navigation", "newsletter", "pagination", "popup", "sidebar", "signup",
        "sponsor", "sponsored", "subscribe", "toolbar",
    )
)
BOILER_WORDS = PLAIN_WORDS | frozenset(
    (
        "ad", "ads", "aside", "banner", "comment", "comments", "consent", "copyright", "disclaimer", "footer", "menu",
        "modal", "nav", "notice", "promo", "promotion", "related", "replies", "reply", "respond", "share", "sharing",
        "social", "widget",
    )
)
FRAME_WORDS = frozenset(
    (
        "area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "group", "icons", "inner",
        "item", "items", "left", "link", "links", "list", "outer", "page", "panel", "posts", "primary", "right",
        "row", "secondary", "section", "site", "slot", "stories", "thread", "top", "unit", "user", "wrap", "wrapper",
    )
)
# a name that begins with one tells of a state or a category
STATE_WORDS = frozenset(("category", "format", "has", "is", "no", "status", "tag", "type", "with", "without"))
CONTENT_WORDS = frozenset(("article", "body", "content", "entry", "main", "post", "story", "text"))
_NOTICE = re.compile(r"©|\(c\) \d{4}|all rights reserved|cookies?\b|subscribe\b", re.I)

# weights of the classifier: positive for content
CUE, IN_ARTICLE, OUTSIDE, LINKS, LONG, SHORT, SENTENCE, HEADING, NOTICE = 8.0, 4.0, 3.0, 3.0, 1.5, 0.5, 0.5, 0.3, 1.5
WEAK_INSIDE, WEAK_OUTSIDE, CONTAINER = 3.0, 1.5, 1.0
ADJACENT, SAME_PARENT, INTO_LIST = 0.6, 0.6, 1.2


class _Element:
    """``number``: of the nearest block element; ``parent``: of the one above;
    ``article``: number of the outermost article around, or 0; ``content``: a
    content class is around; ``item``: a list item or table cell is; ``weak``: a
    name with an ambiguous word is."""

    __slots__ = ("tag", "block", "boiler", "weak", "article", "content", "item", "hidden", "number", "parent")

    def __init__(self, tag, block, boiler, weak, article, content, item, hidden, number, parent):
        self.tag, self.block, self.boiler, self.content, self.item = tag, block, boiler, content, item
        self.weak, self.article, self.hidden, self.number, self.parent = weak, article, hidden, number, parent


class Block:
    __slots__ = ("parts", "linked", "size", "tag", "boiler", "weak", "article", "content", "item", "parent", "text")

    def __init__(self, at: _Element, tag: str):
        self.parts, self.linked, self.size = [], 0, 0
        self.tag, self.boiler, self.article, self.parent = tag, at.boiler, at.article, at.parent
        self.weak, self.content, self.item = at.weak, at.content, at.item
        self.text = ""


def name_cue(words: list[str]) -> int:
    """Of the words of one class or id name: 2 boilerplate, 1 weak evidence, 0 none."""
    if BOILER_WORDS.isdisjoint(words) or words[0] in STATE_WORDS:
        return 0
    if words[0] in CONTENT_WORDS and words[-1] in ("wrap", "wrapper", "layout", "container"):
        return 0  # around the text and what stands beside it
    if not PLAIN_WORDS.isdisjoint(words):
        return 2
    return 2 if BOILER_WORDS | CONTENT_WORDS | FRAME_WORDS >= set(words) else 1


def _open(tag: str, attributes: str, up: _Element, number: int) -> _Element:
    """The element below ``up``; cues of its tag and class words added."""
    boiler, article, hidden = up.boiler, up.article, up.hidden or tag in DROPPED
    content, item, weak = up.content, up.item or tag in ITEMS, up.weak
    words: set[str] = set()
    cue = 0
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                for single in value.split():
                    of = _WORDS.findall(_CAMEL.sub("-", single).lower())
                    words.update(of)
                    cue = max(cue, name_cue(of) if of else 0)
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none", value.lower()):
                hidden = True
    if tag not in ("html", "body"):
        good = not CONTENT_WORDS.isdisjoint(words)
        weak = weak or cue == 1 and tag not in CONTENT_TAGS
        if tag in BOILER_TAGS or cue == 2:
            boiler = True
        elif tag == "header" or "header" in words and not good:
            boiler = boiler or not article  # an article's own header stays
        elif (tag in CONTENT_TAGS or {"articlebody", "main", "article"} & words) and not boiler:
            article = article or number
        elif good and not cue and tag not in INLINE:
            content = True
    if tag in INLINE:
        return _Element(tag, False, boiler, weak, article, content, item, hidden, up.number, up.parent)
    return _Element(tag, True, boiler, weak, article, content, item, hidden, number, up.number)


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order, white space collapsed, none empty."""
    stack = [_Element("", True, False, False, 0, False, False, False, 0, 0)]
    open_: dict[str, int] = {}
    out: list[Block] = []
    block: Block | None = None
    number, at, size, links = 0, 0, len(html), 0

    def close(tag: str) -> None:
        nonlocal links
        while True:
            top = stack.pop()
            open_[top.tag] -= 1
            links -= top.tag == "a"
            if top.tag == tag:
                return

    def add(text: str) -> None:
        nonlocal block
        if not text or stack[-1].hidden:
            return
        if block is None:
            if text.isspace():
                return
            tag = next((e.tag for e in reversed(stack) if e.block), "")
            block = Block(stack[-1], tag)
            out.append(block)
        block.parts.append(text)
        if links:
            block.linked += len(text)
        block.size += len(text)

    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            add(unescape(html[at:]))
            break
        if m.start() > at:
            add(unescape(html[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            block = None
        if m[1]:
            if open_.get(tag):
                close(tag)
            continue
        if tag == "br":
            add(" ")
        if tag not in INLINE:
            if open_.get("p"):
                close("p")
            same = ENDS_ITSELF.get(tag)
            if same and open_.get(same):
                scope = {"li": ("ul", "ol")}.get(same, ("table", "dl"))
                for e in reversed(stack):
                    if e.tag in scope:
                        break
                    if e.tag == same:
                        close(same)
                        break
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag in VOID or m[3].endswith("/") and tag in ("path", "use"):
            continue
        number += 1
        stack.append(_open(tag, m[3], stack[-1], number))
        open_[tag] = open_.get(tag, 0) + 1
        links += tag == "a"
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in out if b.text]


def content_score(b: Block) -> float:
    """Above zero: looks like content, whatever article it is in."""
    if b.boiler:
        return -CUE
    score = CONTAINER if b.content and not b.article else 0.0
    if b.weak:
        score -= WEAK_INSIDE if b.article else WEAK_OUTSIDE
    words = b.text.count(" ") + 1
    linked = b.linked > 0.5 * b.size
    if linked:
        score -= LINKS
    if words >= 12:
        score += LONG
    elif b.tag in HEADINGS:
        score += HEADING
    elif words < 4 and (linked or not b.item):
        score -= SHORT
    if b.text[-1] in ".!?…\"”":
        score += SENTENCE
    if (b.weak or not b.article) and _NOTICE.search(b.text):
        score -= NOTICE
    return score


def scores_of(blocks: list[Block]) -> list[float]:
    scores = [content_score(b) for b in blocks]
    held: dict[int, int] = {}
    outside = 0
    for b, s in zip(blocks, scores, strict=True):
        if b.article and not b.boiler:
            held[b.article] = held.get(b.article, 0) + b.size
        elif s > 0:
            outside += b.size
    lead = bool(held) and max(held.values()) >= outside
    for i, b in enumerate(blocks):
        if not b.boiler:
            scores[i] += IN_ARTICLE if b.article else -OUTSIDE if lead else 0.0
    # short blocks between content blocks, or after one in the same element
    run: list[int] = []
    last = -1  # content block before the run

    def release(all_of_them: bool) -> None:
        for k in run:
            if last >= 0 and (all_of_them or blocks[k].parent == blocks[last].parent):
                scores[k] = 0.0
        run.clear()

    for i, s in enumerate(scores):
        if -SHORT <= s <= 0:
            run.append(i)
            continue
        release(s > 0)
        last = i if s > 0 else -1
    release(False)
    return scores


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of the minimum cut.  A positive
    score is the capacity from the source, a negative one that to the sink;
    edges hold both ways.  Dinic's maximum flow."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    left: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((there, back))

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque((source,))
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if left[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if left[e] <= 1e-9)
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[at] < len(out[at]):
                e = out[at][nxt[at]]
                if left[e] > 1e-9 and level[to[e]] == level[at] + 1:
                    break
                nxt[at] += 1
            if nxt[at] < len(out[at]):
                path.append(out[at][nxt[at]])
                at = to[path[-1]]
            elif path:
                at = to[path.pop() ^ 1]
                nxt[at] += 1
            else:
                break


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    scores = scores_of(blocks)
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i and blocks[i - 1].boiler == b.boiler:
            first = b.item and not blocks[i - 1].item and scores[i] >= 0
            edges.append((i - 1, i, INTO_LIST if first else ADJACENT))
        if b.parent in last:
            edges.append((last[b.parent], i, SAME_PARENT))
        last[b.parent] = i
    return "\n\n".join(b.text for b, keep in zip(blocks, min_cut(scores, edges), strict=True) if keep)


def extract(pages: DataFrame, *, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text`` of every page."""
    schema = StructType([*(pages.schema[c] for c in keep), StructField("text", StringType())])

    def make():
        def step(batch):
            yield {c: batch.column(c) for c in keep} | {
                "text": [main_text(h.as_py()) for h in batch.column("html")]
            }

        return step

    return map_batches(pages.select(*keep, "html"), make, schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op6_html_extraction": op6}
