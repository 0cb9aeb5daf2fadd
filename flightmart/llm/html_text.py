"""Main text of web pages by tree scoring.

The page is parsed into a tree (unclosed paragraphs and list items end where
HTML ends them).  Every paragraph-like block passes points to its parent and,
halved, to its grandparent: one for being there, one per comma, one per
hundred characters up to three.  A container's points are then discounted by
its link density; names of classes and ids that tell of articles or of
furniture add or take away points.  The best container is kept with those
siblings that score near it or read like text of their own, whatever their
element or length: all between the first and the last of them (link lists
apart), and blocks of text that follow on directly.  Cells of a layout table
are siblings across its rows.

Boilerplate elements (navigation, headers and footers of the page, sidebars,
notices, adverts, forms, scripts, styles, comments of readers) go before the
scoring, by element, role, or words in class and id.  Words that say what an
element has or lacks ("has-sidebar", "no-comments") and elements with a class
or id that is an article's word by itself don't count.  If nothing is left of a
page, it is read again: first names that hold an article's word beside one of
furniture ("promo-story") don't count, then no name does, and text is taken
if two of its blocks at least are sentences.

Edge cases: a null or empty page, or one without a scoring block, gives an
empty text; broken markup is read as far as it goes; deep nesting is no
recursion; character references are decoded; equal pages give equal texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import quoted

# Element names and naming habits of web pages.
DROPPED = set("script style noscript template svg math iframe object embed canvas form button select textarea input nav aside footer dialog menu head title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SCORED = set("p pre td blockquote dd li h2 h3 figcaption".split())
ENDS_P = BLOCKS - {"html", "body"}
FURNITURE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
#: Tells of a state of the element, not what the element is.
STATE = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|not|is|hide|show)[-_]\S+", re.I)
WHOLE = re.compile(r"(?:^|\s)(?:article|body|content|entry|main|post|story)(?:$|\s)", re.I)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:$|[\s_-])", re.I)
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
IN_HEAD = set("base basefont bgsound head link meta noscript script style template title".split())
#: Elements out of which an end tag reaches no element around them.
SCOPE = set("button caption iframe math object select svg table td template th".split())
#: Elements that carry text beside a container.
BESIDE = set("p blockquote pre ul ol dl figure table".split())
#: Those that do so ahead of one, where lists are menus.
LEADING = {"p", "blockquote", "pre"}
CELLS = {"td", "th"}
ROWS = {"tr", "tbody", "thead", "tfoot"}
#: Which names tell of furniture: all, those without an article's word, none.
EVERY_NAME, PLAIN_NAMES, NO_NAME = range(3)
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<shut>/?)(?P<broken>[a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>",
    re.S,
)
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "text", "links")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.score = 0.0
        self.text = self.links = 0

    def furniture(self, by_name: int = EVERY_NAME) -> bool:
        if self.tag in DROPPED or "hidden" in self.attrs or self.attrs.get("role", "").lower() in BAD_ROLES:
            return True
        if self.tag == "header":
            return not any(a.tag in ("article", "main") for a in ancestors(self))
        if self.tag in ("html", "body", "article", "main"):
            return False
        if re.search(r"display\s*:\s*none", self.attrs.get("style", "")):
            return True
        names = [STATE.sub("", self.attrs.get(k, "")) for k in ("class", "id")]
        if by_name == NO_NAME or not any(map(FURNITURE.search, names)) or any(map(WHOLE.search, names)):
            return False
        return by_name == EVERY_NAME or not any(map(LIKELY.search, names))


def ancestors(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


class TreeBuilder:
    """A tree of kept elements; what is dropped is skipped while reading."""

    def __init__(self, by_name: int = EVERY_NAME) -> None:
        self.by_name = by_name
        self.root = self.at = Node("#root", {}, None)
        self.skipped: list[str] = []  # open elements from the dropped one on

    def feed(self, page: str) -> None:
        i = 0
        for m in TOKEN.finditer(page):
            if m.start() < i:  # inside raw text
                continue
            if m.start() > i and not self.skipped:
                self.at.children.append(unescape(page[i : m.start()]))
            i = m.end()
            tag = (m["tag"] or m["broken"] or "").lower()
            if not tag:
                continue
            if m["close"] or m["shut"]:
                self.handle_endtag(tag)
                continue
            self.handle_starttag(tag, m["attrs"] or "")
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, i)
                i = end.start() if end else len(page)
        if i < len(page) and not self.skipped:
            self.at.children.append(unescape(page[i:]))

    def handle_starttag(self, tag: str, attrs: str) -> None:
        if self.skipped and self.skipped[0] == "head" and tag not in IN_HEAD:
            self.skipped = []
        if tag == "body" and not self.skipped and any(n.tag == "body" for n in (self.at, *ancestors(self.at))):
            return
        if tag in ENDS_P:
            self.end("p", ENDS_P - {"p"})
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            for t in ("dd", "dt") if tag in ("dd", "dt") else ("td", "th") if tag in ("td", "th") else (tag,):
                self.end(t, {"ul", "ol", "dl", "table"} | ({"tr"} if tag in ("td", "th") else set()))
        if self.skipped:
            if tag not in VOID:
                self.skipped.append(tag)
            return
        found = {}
        if attrs:
            for name, a, b, c in ATTR.findall(attrs):
                found.setdefault(name.lower(), unescape(a or b or c))
        node = Node(tag, found, self.at)
        if node.furniture(self.by_name):
            if tag not in VOID:
                self.skipped = [tag]
            else:
                self.at.children.append(" ")
            return
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def end(self, tag: str, fence: set[str]) -> None:
        """Close the nearest open ``tag``, unless an element of the fence is nearer."""
        for i in range(len(self.skipped) - 1, -1, -1):
            if self.skipped[i] == tag:
                del self.skipped[i:]
                return
            if self.skipped[i] in fence:
                return
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in fence:
                return
            node = node.parent
        if node.tag == tag:
            self.at, self.skipped = node.parent, []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html"):
            self.skipped = []
            return
        if tag in VOID:
            return
        if tag in self.skipped:
            self.end(tag, set())
            return
        fence = set() if tag in BLOCKS else BLOCKS
        self.end(tag, fence | SCOPE | ({"ul", "ol"} if tag == "li" else set()) if self.skipped else fence)


def in_order(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def measure(nodes: list[Node]) -> None:
    """Characters and linked characters below each node."""
    for n in reversed(nodes):
        own = sum(len(c.strip()) for c in n.children if isinstance(c, str))
        n.text = own + sum(c.text for c in n.children if isinstance(c, Node))
        n.links = n.text if n.tag == "a" else sum(c.links for c in n.children if isinstance(c, Node))


def own_text(node: Node) -> str:
    """Text of a block without the blocks inside it."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag not in BLOCKS:
            stack += reversed(c.children)
    return " ".join("".join(out).split())


def density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def best_container(nodes: list[Node]) -> tuple[Node | None, float]:
    for n in nodes:
        text = own_text(n) if n.tag in SCORED or n.tag in ("div", "section", "article", "main", "body") else ""
        if not text:
            continue
        if n.tag not in SCORED and len(text) < 25:
            continue
        points = 1 + text.count(",") + text.count("，") + min(len(text) // 100, 3)
        targets = [a for a in ancestors(n) if a.tag != "#root"] if n.tag in SCORED else [n, *[a for a in ancestors(n) if a.tag != "#root"]]
        for k, a in enumerate(targets[:3]):
            a.score += points / (1, 2, 6)[k]
    best, top = None, 0.0
    for n in nodes:
        if n.score <= 0:
            continue
        name = f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}"
        extra = 25 if n.tag in ("article", "main") or n.attrs.get("role") in ("main", "article") else 10 if LIKELY.search(name) else 0
        value = (n.score + extra) * (1 - density(n))
        n.score = value
        if value > top:
            best, top = n, value
    return best, top


def beside(best: Node) -> list[Node | str]:
    """The container's siblings and itself; of a cell all cells of its table."""
    if best.tag not in CELLS:
        return best.parent.children
    top = best
    while top.parent is not None and top.tag in CELLS | ROWS:
        top = top.parent
    out, stack = [], list(reversed(top.children))
    while stack:
        c = stack.pop()
        if isinstance(c, Node) and c.tag in ROWS:
            stack += reversed(c.children)
        else:
            out.append(c)
    return out


def with_siblings(best: Node, top: float) -> list[Node | str]:
    """The container and those siblings that belong to its text."""
    if best.parent is None or best.tag in ("body", "main", "html"):
        return [best]
    every = beside(best)

    def own(s: Node | str) -> bool:
        if s is best:
            return True
        if isinstance(s, str) or density(s) >= 0.3:
            return False
        return s.tag == best.tag and s.score >= max(10, 0.2 * top) or s.tag in BESIDE and s.text > 80

    at = [i for i, s in enumerate(every) if own(s)]
    first, last = at[0], at[-1]

    def joins(s: Node | str, tags: set[str]) -> bool:
        return isinstance(s, str) and not s.strip() or isinstance(s, Node) and s.tag in tags and density(s) < 0.3

    while first > 0 and joins(every[first - 1], LEADING):
        first -= 1
    while last + 1 < len(every) and joins(every[last + 1], BESIDE):
        last += 1
    gap = Node("div", {}, None)  # what is left out still parts the blocks around it
    return [s if isinstance(s, str) or density(s) < 0.5 or s is best else gap for s in every[first : last + 1]]


def blocks(roots: list[Node | str]) -> list[str]:
    """Texts of blocks in page order, white space as one space."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = []
    for r in reversed(roots):
        stack += [r] if isinstance(r, str) or r.tag not in BLOCKS and r.tag != "#root" else [None, r, None]
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            run.append(c)
        elif c.tag == "br":
            run.append(" ")
        elif c.tag in BLOCKS:
            stack += [None, *reversed(c.children), None]
        else:
            stack += reversed(c.children)
    flush()
    return out


def sentences(nodes: list[Node]) -> int:
    """Blocks that read like sentences."""
    found = (own_text(n) for n in nodes if n.tag in SCORED and density(n) < 0.3)
    return sum(len(t.split()) >= 8 and t[-1] in ".?!…\"'”’)" for t in found)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    for by_name in (EVERY_NAME, PLAIN_NAMES, NO_NAME):
        builder = TreeBuilder(by_name)
        builder.feed(html)
        nodes = in_order(builder.root)
        measure(nodes)
        best, top = best_container(nodes)
        if best is None and by_name == EVERY_NAME:
            left = "\n".join(blocks([builder.root]))
            if left:
                return left
        elif best is not None and (by_name != NO_NAME or sentences(nodes) > 1):
            return "\n".join(blocks(with_siblings(best, top)))
    return ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (replaced if present)."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(main_text)

    return pages.withColumn("text", texts.asNondeterministic()(F.coalesce(F.col(quoted(html)), F.lit(""))))
