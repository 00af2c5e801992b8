"""Main text of web pages by composite text density.

A page's tags make a tree. What is never article is taken out first: elements for menus, headers, footers, sidebars, forms, scripts and the like,
and elements whose role, class or id says notice, advert or comments, unless they are wrappers of the article (see ``_wraps``). Every node then has a composite density: its characters per tag,
weighed by how much of them stands outside links. The node whose children's densities have the largest sum is the article's. The least density on its
path to the body is the threshold: wherever a node reaches it, the subtree with the largest sum below that node is text as well.
A text inside an ``article`` element is widened to that element, so headings beside the densest part stay.

Character references are decoded, white space in a block becomes one space, blocks (and line breaks) are joined by one space. Nothing is cut.
Null, empty and tagless pages work: null and empty give the empty string, a page without tags is its own text. Unclosed and misnested tags are
closed as browsers do for paragraphs, list items and table cells, others when an outer element ends. Rows repeat as they are; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Fixed values of HTML: elements without content, with raw content, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "body", "html", "head", "title"}
# A start tag ends an open element of these, unless one of the walls stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# Elements, roles and names that are no article.
NO_TEXT = frozenset("head script style noscript template iframe object svg canvas audio video nav footer aside button select textarea menu dialog map xmp noembed noframes title".split())
NO_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NO_NAME = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments respond disqus "
    "replies related recommended pagination pager toolbar widget".split()
)
KEPT = frozenset(["html", "body", "article", "main"])


class Tree:
    """Nodes in page order: parent, tag, whether taken out and whether by role or name, and the text pieces with the node they stand in."""

    def __init__(self) -> None:
        self.parent, self.tag, self.out, self.named = [-1], ["html"], [False], [False]
        self.pieces: list[tuple[int, str | None]] = []  # a null piece is the edge of a block

    def add(self, parent: int, tag: str, out: bool, named: bool) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.out.append(out)
        self.named.append(named)
        return len(self.tag) - 1


def _is_out(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is never article, and whether its role or name says so."""
    if tag in NO_TEXT or (tag == "header" and not in_article):
        return True, False
    if tag in KEPT or not attrs.strip("/ "):
        return False, False
    named = False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "role":
            named |= value in NO_ROLE
        elif name in ("class", "id"):
            named |= not NO_NAME.isdisjoint(re.split(r"[^a-z0-9]+", value))
    return False, named


def parse(page: str) -> Tree:
    tree, stack, at = Tree(), [0], 0
    tags = ["html"]
    opened: Counter = Counter()  # how many of each tag are open
    lower = None

    def close(depth: int) -> None:
        while len(stack) > depth:
            node, name = stack.pop(), tags.pop()
            opened[name] -= 1
            if name in BLOCK:
                tree.pieces.append((tree.parent[node], None))

    def find(wanted, walls=()) -> int:
        if not any(opened[w] for w in wanted):
            return 0
        for k in range(len(tags) - 1, 0, -1):
            if tags[k] in wanted:
                return k
            if tags[k] in walls:
                break
        return 0

    while True:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            tree.pieces.append((stack[-1], text))
        if not m:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            depth = find((tag,), ("table",) if tag not in ("table", "body", "html", "article", "main") else ())
            if depth:
                close(depth)
            elif tag == "br" or tag == "p":
                tree.pieces.append((stack[-1], None))
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P and (depth := find(("p",), ("table", "button", "article"))):
            close(depth)
        if tag in ENDS and (depth := find(*ENDS[tag])):
            close(depth)
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        node = tree.add(stack[-1], tag, *_is_out(tag, attrs, opened["article"] + opened["main"] > 0))
        if tag in BLOCK:
            tree.pieces.append((node, None))
        if tag in VOID or attrs.endswith("/") and tag in ("path", "use", "rect", "circle"):
            continue
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else re.sub("[A-Z]", lambda c: c[0].lower(), page)
            end = lower.find(f"</{tag}", at)
            body = page[at : end if end >= 0 else len(page)]
            tree.pieces.append((node, body))
            stop = page.find(">", end) if end >= 0 else -1
            at = stop + 1 if stop >= 0 else len(page)
            continue
        stack.append(node)
        tags.append(tag)
        opened[tag] += 1
    return tree


def _wraps(tree: Tree, out: list[bool], sizes: list[int]) -> list[bool]:
    """Which elements that are named like menus, notices or comments stand around the article instead.

    One does if no ``article`` or ``main`` can be seen outside it, and it holds one, or the only ``h1``, or most of the page's text. Within an ``article`` or
    ``main`` it has to hold most of that element's text. ``sizes`` are characters of each node itself.
    """
    n, parent, tag, named = len(tree.tag), tree.parent, tree.tag, tree.named
    strong = [t in ("article", "main") and not o for t, o in zip(tag, out)]
    title = [t == "h1" and not o for t, o in zip(tag, out)]
    size, strongs, titles = sizes[:], [*map(int, strong)], [*map(int, title)]
    for k in range(n - 1, 0, -1):
        for x in (size, strongs, titles):
            x[parent[k]] += x[k]
    around, within = [0] * n, [0] * n  # nearest named element and nearest article or main above
    own_strong, own_title, above = [0] * n, [0] * n, [0] * n  # below a named element but no further one; strong ones above
    for k in range(1, n):
        p = parent[k]
        around[k] = p if named[p] else around[p]
        within[k] = p if strong[p] else within[p]
        above[k] = above[p] + strong[p]
        own_strong[around[k]] += strong[k]
        own_title[around[k]] += title[k]
    wraps, seen_strong, seen_title = [False] * n, own_strong[:], own_title[:]
    for k in range(1, n):
        if not named[k] or out[k]:
            continue
        strong_out, title_out = seen_strong[around[k]], seen_title[around[k]]
        seen_strong[k], seen_title[k] = strong_out + own_strong[k], title_out + own_title[k]
        if strong_out > above[k]:
            continue
        most = 2 * size[k] > size[within[k]]
        wraps[k] = most or (not within[k] and (strongs[k] > 0 or (titles[k] > 0 and not title_out)))
    return wraps


def main_text(page: str | None) -> str:
    """The article of a page."""
    if not page:
        return ""
    tree = parse(page)
    n, parent, tag, out, named = len(tree.tag), tree.parent, tree.tag, tree.out, tree.named
    # A form around the article is no form of the article.
    holds = [t in ("article", "main", "h1") for t in tag]
    for k in range(n - 1, 0, -1):  # children come after their parents
        holds[parent[k]] = holds[parent[k]] or holds[k]
    link, article = [False] * n, [0] * n
    for k in range(1, n):
        out[k] = out[k] or out[parent[k]] or (tag[k] == "form" and not holds[k])
        link[k] = link[parent[k]] or tag[k] == "a"
        article[k] = article[parent[k]] or (k if tag[k] == "article" else 0)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    pieces = [(k, None if t is None else html.unescape(t)) for k, t in tree.pieces if not out[k] or t is None]
    for k, text in pieces:
        if text is not None:
            chars[k] += len("".join(text.split()))
    if any(named):
        wraps = _wraps(tree, out, chars)
        for k in range(1, n):
            out[k] = out[k] or out[parent[k]] or (named[k] and not wraps[k])
        pieces = [(k, t) for k, t in pieces if not out[k] or t is None]
    for k in range(n):
        chars[k] *= not out[k]
        link_chars[k] = chars[k] * link[k]
    for k in range(n - 1, 0, -1):
        if not out[k]:
            p = parent[k]
            chars[p] += chars[k]
            link_chars[p] += link_chars[k]
            tags[p] += tags[k] + 1
            link_tags[p] += link_tags[k] + (tag[k] == "a")
    share = link_chars[0] / max(1, chars[0])
    density, sums = [0.0] * n, [0.0] * n
    for k in range(n):
        c, lc, t, lt = chars[k], link_chars[k], max(1, tags[k]), max(1, link_tags[k])
        if c and not out[k]:
            base = log(c / max(1, c - lc) * lc + share * c + e)
            density[k] = max(0.0, c / t * log(c / max(1, lc) * t / lt) / log(max(base, 1.01)))
            if k:
                sums[parent[k]] += density[k]
    best_in = list(range(n))  # the node of the largest sum in each subtree, the outermost of equals
    for k in range(n - 1, 0, -1):
        p = parent[k]
        if not out[k] and sums[best_in[k]] > sums[best_in[p]]:
            best_in[p] = best_in[k]
    path, least = best_in[0], density[best_in[0]]
    while path > 0:
        least = min(least, density[path])
        path = parent[path]
    chosen = {best_in[0]}
    for k in range(n):
        if not out[k] and density[k] >= least and tag[k] not in ("html", "body"):
            chosen.add(best_in[k])
    chosen |= {article[k] for k in chosen if article[k]}
    inside = [False] * n
    for k in range(n):
        inside[k] = k in chosen or (k > 0 and inside[parent[k]])
    return " ".join("".join(" " if t is None else t for k, t in pieces if t is None or inside[k]).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["page_id", "url"]].copy()
            out["text"] = [main_text(h if isinstance(h, str) else None) for h in batch["html"]]
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
