"""Main text of a web page by composite text density.

Every DOM node gets a link-adjusted density of characters per tag; a run of text of its own counts as a child. The
container with the greatest sum of its children's densities is the core of the page, and the least density on the
path from the body to it is the threshold. Going up that path, what stands beside it stays when its density
reaches the threshold; where something does, linkless text blocks of the same parent stay too, however
short. Inside the core everything stays but links-only lists below the threshold.

Density can't tell an advert or a reader's comment from a paragraph. Furniture by its element (nav, aside, footer, a
form that isn't the page) or by a class or id made of nothing but furniture words never takes part. A page
header is furniture outside articles; in a core smaller than the body it belongs to the text.

Defined results: null and empty pages, and pages without any density, give an empty text. Unclosed, misnested and
cut-off markup is read as far as it goes, in linear time. White space inside a block becomes one space (a line break
is white space), blocks are joined by one newline. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import deque
from html import unescape

from pyspark.sql import DataFrame

from placeforge.llm.common import map_columns

_START = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/><]*)"
#: Quoted values may hold '>'. Where that leads to no end of the tag, the rest of the page is read without quotes.
_TOKEN = re.compile(_START + r"(?:((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>)|([^<>]*>?))", re.S)
_PLAIN = re.compile(_START + r"([^<>]*>?)", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template iframe object svg math canvas head title audio video map select option datalist textarea button".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that hold words rather than other blocks.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption figcaption summary blockquote pre address".split())
CONTAINERS = BLOCK - TEXT_BLOCKS - {"html", "hr"} | {"blockquote"}
FURNITURE = frozenset("nav footer aside form menu dialog".split())
_CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption li dd dt body html".split())
_IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
#: Words that mark page furniture, and words that a class or id may have beside them.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related respond "
    "replies share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split()
)
BESIDE = frozenset(
    "area article articles bar block bottom box button buttons container content form global icons inner item items js left link links "
    "list main media outer page panel post posts primary right row secondary section signup site slot stories top unit wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form".split())
_SPLIT = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none")
_SPACE = re.compile(r"\s+")
HARD, HEADER = 1, 2


class Node:
    __slots__ = ("tag", "parent", "items", "chars", "link_chars", "tags", "link_tags", "mark", "junk", "head", "silent", "density", "total")

    def __init__(self, tag: str, parent: Node | None, mark: int = 0):
        self.tag, self.parent, self.mark = tag, parent, mark
        self.items: list = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.silent = tag in SILENT
        self.junk = self.head = False
        self.density = self.total = 0.0


def mark_of(tag: str, attrs: str, inside_article: bool) -> int:
    """HARD for furniture, HEADER for a header outside articles, else 0."""
    if tag in FURNITURE:
        return HARD
    header = HEADER if tag == "header" and not inside_article else 0
    if len(attrs) < 3 or tag in ("body", "html", "main"):
        return header
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)) or (name == "role" and value in ROLES):
            return HARD
        if name in ("class", "id"):
            for token in value.split():
                words = {w for w in _SPLIT.split(token) if w}
                found = words & MARKS
                if found and words <= MARKS | BESIDE:
                    if found != {"header"}:
                        return HARD
                    header = 0 if inside_article else HEADER
    return header


def parse(html: str) -> Node:
    """The tree of a page; end tags may be missing or misplaced. Open elements are found by their places in the stack."""
    root = Node("#root", None)
    stack, places = [root], {}
    pattern, at = _TOKEN, 0

    def last(tag: str) -> int:
        own = places.get(tag)
        return own[-1] if own else -1

    def close(k: int) -> None:
        while len(stack) > k:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in BLOCK:
                places["#block"].pop()

    while True:
        m = pattern.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        here = stack[-1]
        if text and not here.silent:
            here.items.append(unescape(text) if "&" in text else text)
        if not m:
            return root
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA[") and not here.silent:
                here.items.append(m[0][9:].removesuffix("]]>"))
            continue
        attrs = m[3]
        if attrs is None:
            pattern, attrs = _PLAIN, m[4]
        tag = m[2].lower()
        if m[1]:
            k = last(tag)
            # An inline end tag doesn't reach out of a table or cell.
            if k > 0 and (tag in BLOCK or k > max(last("table"), last("td"))):
                close(k)
            continue
        if tag in _CLOSES_P and last("p") > 0 and last("p") == last("#block"):
            close(last("p"))
        if tag in _IMPLIED:
            scope = max(map(last, _SCOPE[tag]))
            first = len(stack)
            for t in _IMPLIED[tag]:
                own = places.get(t) or ()
                k = bisect_right(own, scope)
                if k < len(own):
                    first = min(first, own[k])
            close(first)
        here = stack[-1]
        node = Node(tag, here, mark_of(tag, attrs, last("article") > 0 or last("main") > 0))
        node.silent |= here.silent
        here.items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and not (attrs.endswith("/>") and tag in ("svg", "math", "path")):
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                places.setdefault("#block", []).append(len(stack))
            stack.append(node)


def walk(root: Node) -> list[Node]:
    """All nodes, parents before children, without recursion."""
    out, todo = [], [root]
    while todo:
        out.append(n := todo.pop())
        todo += [x for x in reversed(n.items) if isinstance(x, Node)]
    return out


def letters(text: str) -> int:
    """Characters that aren't white space."""
    return sum(map(len, text.split()))


def density(chars: int, link_chars: int, tags: int, link_tags: int, ratio: float) -> float:
    """Characters per tag, adjusted by the share of linked ones; ratio is that share in the whole body."""
    if not chars:
        return 0.0
    base = math.log(ratio * chars + chars * link_chars / max(chars - link_chars, 1) + math.e)
    links = (chars / max(link_chars, 1)) * (max(tags, 1) / max(link_tags, 1))
    return chars / max(tags, 1) * math.log(max(links, 1.0)) / max(math.log(base), 0.1)


def body_of(nodes: list[Node]) -> Node:
    return next((n for n in nodes if n.tag == "body"), nodes[0])


def measure(nodes: list[Node]) -> None:
    """Characters, tags and their linked shares from the leaves up; then furniture, densities and child sums."""
    for n in reversed(nodes):
        if n.silent:
            continue
        n.chars += sum(letters(x) for x in n.items if isinstance(x, str))
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
        if n.parent:
            p = n.parent
            p.chars += n.chars
            p.link_chars += n.link_chars
            p.tags += n.tags + (n.tag not in VOID)
            p.link_tags += n.link_tags
    body = body_of(nodes)
    ratio = body.link_chars / max(body.chars, 1)
    for n in nodes:
        if n.silent:
            continue
        up = n.parent
        # A form that holds most of the page is its frame.
        n.junk = bool(up and up.junk) or (n.mark == HARD and not (n.tag == "form" and 2 * n.chars > body.chars))
        n.head = bool(up and up.head) or n.mark == HEADER
        n.density = density(n.chars, n.link_chars, n.tags, n.link_tags, ratio)
        if up and not (n.junk or n.head):
            up.total += n.density
        linked = n.tag == "a"
        for x in n.items:
            if isinstance(x, str):
                c = letters(x)
                n.total += density(c, c if linked else 0, 1, int(linked), ratio)


def core(nodes: list[Node]) -> tuple[Node | None, float]:
    """The container with the greatest density sum (the first of equals), and the least density up to the body."""
    body = body_of(nodes)
    best, most = None, 0.0
    for n in nodes:
        if n.total > most and not (n.junk or n.head or n.silent) and (n.tag in CONTAINERS or n.parent is None):
            best, most = n, n.total
    threshold, x = math.inf, best
    while x is not None:
        threshold = min(threshold, x.density)
        x = None if x is body else x.parent
    return best, threshold


def beside(best: Node, body: Node, threshold: float) -> list:
    """The core and what stays beside it on the way up to the body, in page order."""
    parts: deque = deque([best])
    x = best
    while x is not body and x.parent is not None:
        p = x.parent

        def stays(s) -> bool:
            if isinstance(s, str):
                return letters(s) > 0 and letters(s) >= threshold
            return not (s.junk or s.head or s.silent) and s.chars > 0 and s.density >= threshold

        def plain(s) -> bool:
            if isinstance(s, str):
                return letters(s) > 0
            return not (s.junk or s.head or s.silent) and s.link_chars == 0 and (s.tag in TEXT_BLOCKS or s.tag not in BLOCK)

        if any(s is not x and stays(s) for s in p.items):
            kept = [s for s in p.items if s is x or stays(s) or plain(s)]
        else:
            kept = [x]
        at = next(k for k, s in enumerate(kept) if s is x)
        parts.extendleft(reversed(kept[:at]))
        parts.extend(kept[at + 1 :])
        x = p
    return list(parts)


def blocks(parts: list, best: Node, threshold: float) -> list[str]:
    """Texts of the blocks of all parts in page order, furniture left out."""
    out: list[str] = []
    run: list[str] = []
    whole = best.tag in ("body", "#root")  # then a header in it is the page's own

    def close() -> None:
        if run:
            t = _SPACE.sub(" ", "".join(run)).strip(" ")
            run.clear()
            if t:
                out.append(t)

    def links_only(n: Node) -> bool:
        return n.density < threshold and n.link_tags > 2 and n.link_chars == n.chars and n.tag in CONTAINERS

    todo: list = list(reversed(parts))
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif x.silent or x.junk or (x.mark == HEADER and whole) or (x is not best and links_only(x)):
            if x.tag in BLOCK:
                close()
        elif x.tag == "br":
            run.append(" ")
        else:
            if x.tag in BLOCK:
                close()
                todo.append(None)
            todo += reversed(x.items)
    close()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    nodes = walk(parse(html))
    measure(nodes)
    best, threshold = core(nodes)
    if best is None:
        return ""
    return "\n".join(blocks(beside(best, body_of(nodes), threshold), best, threshold))


def extract(df: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of df (page_id, url, html). No shuffle."""

    def make():
        def run(ids, urls, pages):
            texts = [main_text(p) for p in pages]
            return ids, urls, texts, [len(t) for t in texts]

        return run

    return map_columns(df, ("page_id", "url", "html"), "page_id long, url string, text string, n_chars long", make)
