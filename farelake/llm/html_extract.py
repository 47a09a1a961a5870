"""Main text of web pages by tag-path ratios.

Each text node has a root-to-leaf path of block elements, and a path's ratio
tells how much text and punctuation its nodes hold on average; text in links
counts a quarter. The steps per page:

1. aggregate text length, punctuation and nodes by path;
2. smooth the nodes' ratios along the page with a Gaussian window;
3. fuse: a path's own ratio and the mean of its nodes' smoothed ones combine
   (geometric mean), and each container (a prefix of paths) sums its prose;
4. find the container: the article or main elements with their share of the
   prose, or else the deepest one that holds most of it;
5. in there, keep the paths above the threshold, a multiple of the ratios'
   deviation, and the headings, paragraphs and list items beside them; of the
   latter, those that are mostly links must pass the threshold themselves.

Elements that are no content by their tag, role, or class name (menus,
footers, notices, adverts, comments, ...) have a ratio of 0 throughout; a
class name does not mark an element that holds an article or main element. A
page's work and memory are in proportion to its length, whatever its depth:
paths are numbers, each with its parent's.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# The HTML standard's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: An opening tag ends an open element of these, up to the nearest of the scope.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
#: Elements that hold no main text, and the words that mark others as such in class, id and role.
BOILERPLATE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe object svg button select option textarea input label dialog menu canvas audio video map title".split())
BOILERPLATE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promoted promotion
    nav navbar navigation navigational menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar
    header masthead footer foot bottom copyright legal disclaimer sidebar aside rail widget widgets
    comment comments commentlist respond reply replies discussion disqus reviews
    cookie cookies consent gdpr notice notices notification alert popup modal overlay subscribe subscription newsletter signup login
    share sharing social follow related recommended recommendations trending popular tags tagcloud search searchbox form
    complementary contentinfo hidden""".split())
#: These words mark nothing beside a word of the second list (``content-header`` holds the title).
WEAK_WORDS = frozenset("header masthead".split())
CONTENT_WORDS = frozenset("article post entry story content main body text".split())
#: What follows one of these in a class name tells of the layout (``has-sidebar``).
LAYOUT_WORDS = frozenset("has with no without".split())
#: A header inside one of these belongs to the article.
CONTENT_TAGS = frozenset(("article", "main"))

#: Elements that hold a block of prose, and those that only group such blocks.
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th figcaption caption summary".split())
GROUPING_TAGS = frozenset("ul ol dl table thead tbody tfoot tr blockquote figure header hgroup details".split())

SIGMA = 1.0
#: The share of the page's prose that makes a container, or an article or main element, the article.
CONTAINER_SHARE, NAMED_SHARE = 0.5, 0.2
THRESHOLD = 0.8
#: What text in links counts, and the share of it from which a path is mostly links.
LINK_WEIGHT, MOSTLY_LINKS = 0.25, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？·–—\"'“”()]")


class _Page:
    """A page's elements, paths and text nodes, each by number; a parent's number is smaller."""

    def __init__(self):
        self.parent, self.flag, self.path_of = [0], [0], [0]  # by element; flag 1: boilerplate by tag, 2: by its name
        self.path_parent, self.path_tag, self.path_depth = [0], [""], [0]
        self._paths: dict[tuple[int, str], int] = {}
        self.nodes: list[tuple[int, int, str, bool]] = []  # element, block, text, whether in a link

    def element(self, parent: int, name: str, css: str, flag: int) -> int:
        path = self.path_of[parent]
        if name not in INLINE:  # inline elements share the path of their block
            key = (path, f"{name}.{css}" if css else name)
            if key not in self._paths:
                self._paths[key] = len(self.path_parent)
                self.path_parent.append(path)
                self.path_tag.append(name)
                self.path_depth.append(self.path_depth[path] + 1)
            path = self._paths[key]
        self.parent.append(parent)
        self.flag.append(flag)
        self.path_of.append(path)
        return len(self.parent) - 1

    def content_nodes(self) -> list[tuple[int, int, str, bool]]:
        """The nodes outside boilerplate, as (path, block, text, whether in a link)."""
        out = [False] * len(self.parent)
        for i in range(1, len(out)):
            out[i] = out[self.parent[i]] or self.flag[i] > 0
        return [(self.path_of[e], block, text, link) for e, block, text, link in self.nodes if not out[e]]


def _marked(attrs: str) -> tuple[str, bool]:
    """The class as part of the path, and whether the attributes mark boilerplate."""
    css, words, hidden = "", set(), False
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key == "class":
            css = ".".join(value.lower().split())
        if key in ("class", "id", "role"):
            for name in re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", value).lower().split():
                for word in _WORD.findall(name):
                    if word in LAYOUT_WORDS:
                        break
                    words.add(word)
        hidden |= key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "").lower())
    marks = words & BOILERPLATE_WORDS
    return css, hidden or bool(marks - WEAK_WORDS) or (bool(marks) and not words & CONTENT_WORDS)


def parse(page: str) -> _Page:
    """The page's text nodes in order, each with its element and the block it belongs to."""
    out = _Page()
    stack: list[tuple[str, int]] = [("", 0)]  # open elements: name, number
    opened: Counter = Counter()
    block = 0
    at, end = 0, len(page)

    def close(down_to: int) -> None:
        for name, _ in stack[down_to:]:
            opened[name] -= 1
        del stack[down_to:]

    def close_nearest(names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Ends the nearest open element of ``names``, with what is open inside it, unless a scope element comes first."""
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return close(k)
            if stack[k][0] in scope:
                return None

    while at < end:
        m = _TOKEN.match(page, at)
        if m is None:  # a lone tag opener with an unclosed quote
            out.nodes.append((stack[-1][1], block, page[at], opened["a"] > 0))
            at += 1
            continue
        at = m.end()
        if m["text"]:
            out.nodes.append((stack[-1][1], block, html.unescape(m["text"]), opened["a"] > 0))
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if name not in INLINE:
            block += 1
        if m["end"]:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            continue
        if name in CLOSES_P:
            close_nearest(("p",), ("button", "td", "th", "article", "section", "div", "blockquote", "li"))
        if name in ENDS:
            close_nearest(*ENDS[name])
        if name in VOID:
            continue
        css, marked = _marked(m["attrs"]) if m["attrs"] else ("", False)
        inside = opened["article"] + opened["main"] > 0
        if name in BOILERPLATE_TAGS or (name == "header" and not inside):
            flag = 1
        else:
            flag = 2 if marked and name not in ("html", "body", *CONTENT_TAGS) else 0
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = closing.end() if closing else end
            continue
        if not m["attrs"].rstrip().endswith("/") or name not in ("svg", "path", "math"):
            if name in CONTENT_TAGS:
                for held, number in reversed(stack):  # what holds an article is no boilerplate by its name
                    if held in CONTENT_TAGS:
                        break
                    if out.flag[number] == 2:
                        out.flag[number] = 0
            stack.append((name, out.element(stack[-1][1], name, css, flag)))
            opened[name] += 1
    return out


def _smoothed(values: np.ndarray) -> np.ndarray:
    reach = math.ceil(2 * SIGMA)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.concatenate([np.zeros(reach), values, np.zeros(reach)])
    norm = np.convolve(np.concatenate([np.zeros(reach), np.ones(len(values)), np.zeros(reach)]), weights, "valid")
    return np.convolve(padded, weights, "valid") / norm


def content_paths(page: _Page, nodes: list[tuple[int, int, str, bool]]) -> np.ndarray:
    """By path: whether it is content."""
    n = len(page.path_parent)
    full = [x for x in nodes if x[2].strip()]
    if not full:
        return np.zeros(n, bool)
    path = np.array([p for p, *_ in full])
    size = np.array([len(text.split()) + len(text) / 8 for _, _, text, _ in full])
    in_link = np.array([link for *_, link in full])
    length = np.where(in_link, LINK_WEIGHT * size, size)
    punctuation = np.array([len(_PUNCTUATION.findall(text)) for _, _, text, _ in full], float)
    count = np.bincount(path, minlength=n)
    used = count > 0
    per = np.maximum(count, 1)
    # the extended ratio: text per node of the path, raised by the path's punctuation per node
    ratio = np.bincount(path, length, n) / per * (1 + np.log1p(np.bincount(path, punctuation, n) / per))
    fused = np.sqrt(ratio * np.bincount(path, _smoothed(ratio[path]), n) / per)
    # what each container holds of the prose: children have greater numbers than their parents
    held = np.bincount(path, length * (1 + np.log1p(punctuation)), n)
    total = held.sum()
    for p in range(n - 1, 0, -1):
        held[page.path_parent[p]] += held[p]
    tags = page.path_tag
    tops = {p for p in range(1, n) if tags[p] in CONTENT_TAGS and held[p] >= NAMED_SHARE * total}
    if not tops:
        most = [p for p in range(1, n) if tags[p] not in PROSE_TAGS and held[p] >= CONTAINER_SHARE * total]
        tops = {max(most, key=lambda p: page.path_depth[p], default=0)}
    inside = np.zeros(n, bool)
    for p in range(n):  # an outer container holds the inner ones
        inside[p] = p in tops or (p > 0 and inside[page.path_parent[p]])
    level = THRESHOLD * fused[used].std()
    over = inside & used & (fused >= level)

    def around(p: int) -> int:
        """The path of the element whose blocks this path's are, past lists and tables."""
        p = page.path_parent[p]
        while p and tags[p] in GROUPING_TAGS:
            p = page.path_parent[p]
        return p

    beside = {around(int(p)) for p in np.flatnonzero(over) if tags[p] in PROSE_TAGS}
    links = np.bincount(path, size * in_link, n) > MOSTLY_LINKS * np.bincount(path, size, n)
    return np.array([over[p] or bool(used[p] and inside[p] and tags[p] in PROSE_TAGS and not links[p] and around(p) in beside) for p in range(n)])


def main_text(page: str) -> str:
    """The content nodes' text: one space for white space within a block, and between blocks."""
    parsed = parse(page)
    nodes = parsed.content_nodes()
    kept = content_paths(parsed, nodes)
    blocks: dict[int, list[str]] = {}
    for path, block, text, _ in nodes:
        if kept[path]:
            blocks.setdefault(block, []).append(text)
    return " ".join(filter(None, (" ".join("".join(parts).split()) for parts in blocks.values())))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """One row per page: the ``keep`` columns, ``text`` and ``n_chars`` (code points).

    Null and empty pages, and pages without content, give the empty text.
    Repeated rows are extracted each on its own; an empty table gives no rows;
    other columns are ignored.
    """
    rows = pages.select(*(F.col(c) for c in keep), text_or_empty(html_column).alias("_html"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
