"""Main text of web pages by composite text density.

Each node of the document tree gets its characters per tag, adjusted for link characters and link tags; a
node's score is the sum of its children's densities. The subtree with the largest sum is the article. The
least density on the path from there up to the body is a threshold: blocks beside the path that reach it
belong to the article too.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without an end tag, with raw text, and those that break a text block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends open elements of these names, unless one of the second group stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
# Elements and words of class, id and role that name what is not article text.
NOT_TEXT = set("head script style noscript template nav header footer aside button select textarea iframe svg object canvas dialog menu".split())
NOT_TEXT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies "
    "consent dialog disclaimer discussion disqus footer header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification pagination popup promo promoted promotion related replies reply search share sharing sidebar sidenav signup skip social "
    "sponsor sponsored subscribe toolbar topbar widget widgets alert".split()
)
BESIDE = set("has is no show with without".split())
#: Words that keep their meaning whatever stands below; other named elements, and forms, may be wrappers of the page.
ALWAYS = set("ad ads advert adverts advertisement advertising comment comments disqus cookie cookies consent popup sponsor sponsored newsletter breadcrumb breadcrumbs".split())
#: Share of the page's unlinked text that makes a named element a wrapper.
WRAPPER = 0.85
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/a-zA-Z][^>]*\Z|[^<]+|<", re.S
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)
_SPLIT = re.compile(r"[^a-z]+")


class Node:
    __slots__ = ("tag", "inside", "parent", "out", "named", "chars", "tags", "link_chars", "link_tags", "density", "score")

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out, self.named = tag, parent, out, False
        #: Nodes and texts in page order.
        self.inside: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0


def _other_words(attributes: str) -> set[str]:
    """Words of class, id and role that name something that is not the article."""
    words: set[str] = set()
    for found in _NAMES.findall(attributes):
        for token in (found[0] or found[1] or found[2]).split():
            parts = [p for p in _SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if p]
            for i, part in enumerate(parts):
                # "has-sidebar" and "layout-with-sidebar" say what stands beside the article, "ad-free" what does not.
                if part in NOT_TEXT_WORDS and BESIDE.isdisjoint(parts[:i]) and parts[i + 1 : i + 2] not in (["free"], ["less"]):
                    words.add(part)
    return words


def names_other(attributes: str, tag: str) -> str:
    """Whether the element is hidden or named as something that is not the article: "always", or "maybe" a wrapper, or ""."""
    if tag == "form":
        return "always" if attributes and _HIDDEN.search(attributes) else "maybe"
    if not attributes or tag in ("html", "body", "article", "main"):
        return ""
    words = _other_words(attributes)
    if _HIDDEN.search(attributes) or not ALWAYS.isdisjoint(words):
        return "always"
    return "maybe" if words else ""


def cut_named(nodes: list[Node]) -> None:
    """Takes out named elements and forms, but for those that hold nearly all of the page's unlinked text: these are wrappers."""
    free: dict[int, int] = {}
    for node in reversed(nodes):
        if node.out or node.tag == "a":
            continue
        free[id(node)] = sum(_size(x) if isinstance(x, str) else free.get(id(x), 0) for x in node.inside)
    whole = free.get(id(nodes[0]), 0)
    for node in nodes:
        wrapper = node.named and free.get(id(node), 0) > WRAPPER * whole
        node.out = node.out or (node.parent is not None and node.parent.out) or (node.named and not wrapper)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The root, and all nodes in page order (children after parents); lenient, in one pass without recursion."""
    root = Node("html", None, False)
    nodes, open_, at, end = [root], [root], 0, len(page)
    while at < end:
        found = _TOKEN.match(page, at)
        at = found.end()
        name = found[2]
        if name is None:
            token = found[0]
            if token[0] != "<" or len(token) == 1:
                open_[-1].inside.append(token)
            continue
        name = name.lower()
        if found[1]:
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == name:
                    del open_[depth:]
                    break
                if name not in BLOCK and open_[depth].tag in BLOCK:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if name in ("html", "body") and any(n.tag == name for n in open_):
            continue
        if name in BLOCK:
            ends, stops = ENDS.get(name, (set(), set()))
            for depth in range(len(open_) - 1, 0, -1):
                tag = open_[depth].tag
                if tag == "p" or tag in ends:
                    del open_[depth:]
                    if tag != "p":
                        break
                elif tag in stops or tag in ("td", "th", "table", "div", "section", "article", "body"):
                    if not ends or tag in stops or tag == "body":
                        break
        elif name == "option":
            if open_[-1].tag == "option":
                open_.pop()
        parent = open_[-1]
        other = names_other(found[3], name)
        node = Node(name, parent, parent.out or name in NOT_TEXT or other == "always")
        node.named = other == "maybe"
        parent.inside.append(node)
        nodes.append(node)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            if name == "textarea" or not close:
                at = close.start() if close else end
            else:
                at = close.start()
            node.out = True
        elif name not in VOID and not found[3].rstrip().endswith("/"):
            open_.append(node)
        elif name not in VOID and name in BLOCK:
            open_.append(node)  # a slash at the end of an ordinary start tag means nothing
    cut_named(nodes)
    return root, nodes


def _size(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n")


def measure(nodes: list[Node]) -> Node:
    """Fills in counts, densities and scores; returns the body, or what stands for it."""
    for node in reversed(nodes):
        if node.out:
            continue
        for x in node.inside:
            if isinstance(x, str):
                node.chars += _size(x)
            elif not x.out:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    ratio = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.out or not node.chars:
            continue
        tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(node.chars - node.link_chars, 1)
        base = math.log(node.chars / plain * node.link_chars + ratio * node.chars + math.e)
        adjust = math.log(max(node.chars / links * tags / link_tags, 1.0)) / base
        node.density = node.chars / tags * adjust
    for node in nodes[1:]:
        # Inline marks are part of their block's text, so they lend no density to it.
        if not node.out and node.tag in BLOCK:
            node.parent.score += node.density
    return body


def _is_links(node: Node) -> bool:
    """A block that is little but links, such as a menu without a name."""
    return node.tag in BLOCK and node.link_tags >= 3 and node.link_chars > 0.7 * node.chars


def article(nodes: list[Node], body: Node) -> list[Node]:
    """The subtrees of the article, in page order."""
    inside = [n for n in nodes if not n.out and n.chars and n.score]
    if not inside:
        return [body] if body.chars and not body.out else []
    best = max(inside, key=lambda n: (n.score, n.density))
    path, node = [best], best
    while node is not body and node.parent is not None:
        node = node.parent
        path.append(node)
    threshold = min(n.density for n in path if n.chars)
    chosen = [best]
    for child, parent in zip(path[:-1], path[1:], strict=True):
        before, after, passed = [], [], False
        for x in parent.inside:
            if x is child:
                passed = True
            elif isinstance(x, str) or x.out or not x.chars or _is_links(x) or x.link_chars > x.chars / 2:
                continue
            elif x.density >= threshold or (x.tag in ("h1", "h2") and not passed):
                (after if passed else before).append(x)
        chosen = before + chosen + after
    return chosen


def blocks(chosen: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space runs as one blank."""
    out: list[str] = []
    now: list[str] = []

    def end() -> None:
        if now:
            text = " ".join(html.unescape("".join(now)).split())
            if text:
                out.append(text)
            now.clear()

    for top in chosen:
        end()
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                now.append(x)
            elif not x.out and not (x is not top and _is_links(x)):
                if x.tag == "br":
                    now.append(" ")
                block = x.tag in BLOCK
                if block:
                    end()
                    stack.append(None)
                stack.extend(reversed(x.inside))
        end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    _, nodes = parse(page)
    return "\n\n".join(blocks(article(nodes, measure(nodes))))


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` of the article (empty if none) and ``n_chars``, its code points.

    Null html is empty; repeated rows and null ids stay rows of their own; whole pages are read. Pages don't
    depend on each other, so rows are batched in Arrow and nothing is shuffled.
    """

    @F.pandas_udf("string")
    def text_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series([main_text(x) for x in s], dtype="object")

    return pages.select(F.col(id), F.col(url), text_of(F.col(page)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
