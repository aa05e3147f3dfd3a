"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements; inline elements only carry text. Each node has
features of its tag, of the words in its attributes, of its depth and its siblings, and of the
density of text and links in its subtree. Boosted trees give the probability that a node belongs to
the article. Decoding chooses the most likely set of nodes of which every parent is chosen too, so
nothing inside a dropped menu is kept and nothing kept hangs below a dropped node.

The trees are fitted here, on pages made from patterns that say which of their parts is the
article (see :func:`training_pages`).
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

from tidegate.llm import common

# -- fixed values of HTML ---------------------------------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = set("script style title textarea iframe xmp noembed noframes noscript template svg math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label "
    "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr link meta".split()
)
#: An open element that ends where one of the others begins, up to an enclosing one.
ENDS_AT = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
GROUPS = (
    "html body",
    "article main",
    "section",
    "div center",
    "p",
    "h1",
    "h2 h3 h4 h5 h6 hgroup",
    "ul ol dl menu",
    "li dt dd",
    "table thead tbody tfoot tr td th caption",
    "nav",
    "header",
    "footer",
    "aside",
    "form fieldset legend button select option optgroup input textarea",
    "figure figcaption picture video audio",
    "blockquote pre",
    "address details summary dialog",
    "head",
)
TAG_GROUP = {tag: i for i, group in enumerate(GROUPS) for tag in group.split()}
#: Words of classes, ids and roles, by what they tell.
WORDS = (
    "article content post entry main story body text copy prose page",
    "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager skip",
    "header masthead topbar top brand logo site banner",
    "footer bottom copyright legal imprint colophon contentinfo",
    "sidebar aside widget related recommended trending popular more complementary rail",
    "ad ads advert advertisement adverts sponsor sponsored promo promotion dfp adsense",
    "comment comments commentlist discussion reply replies respond disqus thread",
    "cookie cookies consent notice alert popup modal newsletter subscribe gdpr overlay",
    "share social sharing follow buttons tags",
    "form search login signup register contact",
    "hidden none invisible sronly",
)
WORD_GROUP = {word: i for i, group in enumerate(WORDS) for word in group.split()}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z!?/][^>]*+\Z",
    re.S,
)
_told = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_parts = re.compile(r"[a-z]+")


@dataclass
class Page:
    """The block elements of a page in page order, and its blocks of text."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    words: list[frozenset] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    blocks: list[tuple[int, list[str]]] = field(default_factory=list)

    def add(self, tag: str, parent: int, attributes: str) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1 if parent >= 0 else 0)
        self.words.append(told(attributes) if attributes else frozenset())
        self.marks.append(attributes)
        self.links.append(0)
        return len(self.tags) - 1


def told(attributes: str) -> frozenset:
    """Groups of the words in the attributes that tell what an element is."""
    found = set()
    for name, value in _told.findall(attributes):
        name, value = name.lower(), value.lower()
        if name == "hidden" or name == "aria-hidden" and "true" in value:
            found.add(WORD_GROUP["hidden"])
        elif name == "style":
            if "display:none" in value.replace(" ", ""):
                found.add(WORD_GROUP["hidden"])
        else:
            found.update(WORD_GROUP[w] for w in _parts.findall(value) if w in WORD_GROUP)
    return frozenset(found)


def parse(source: str) -> Page:
    """The tree of a page, for any text: what is no markup is text, what is not closed ends late."""
    page = Page()
    stack = [page.add("html", -1, "")]
    opened: dict[str, list[int]] = {"html": [0]}  # places in the stack, ascending
    linked = False
    at, end = 0, len(source)

    def pop_to(place: int) -> None:
        while len(stack) > place:
            opened[page.tags[stack.pop()]].pop()

    page.blocks.append((0, []))

    def write(text: str) -> None:
        if text:
            page.blocks[-1][1].append(html.unescape(text) if "&" in text else text)
            if linked:
                page.links[stack[-1]] += len(text)

    while at < end:
        found = _token.search(source, at)
        if found is None:
            write(source[at:])
            break
        write(source[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            closing, tag, attributes = found.group(4), found.group(5), found.group(6)
            if tag is None:
                continue
        tag = tag.lower()
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
                at = close.start() if close else end
            continue
        if tag in INLINE:
            if tag == "a":
                linked = not closing
            elif tag == "br":
                write(" ")
            continue
        if closing:
            if opened.get(tag) and (place := opened[tag][-1]):
                pop_to(place)
            page.blocks.append((stack[-1], []))
            continue
        if tag == "html" or tag == "body" and opened.get("body"):
            continue
        if opened.get("p"):  # a block ends the paragraph that is open
            pop_to(opened["p"][-1])
        ends, within = ENDS_AT.get(tag, ((), ()))
        if any(opened.get(t) for t in ends):
            barrier = max((opened[t][-1] for t in within if opened.get(t)), default=0)
            inner = [opened[t] for t in ends if opened.get(t) and opened[t][-1] > barrier]
            if inner:
                pop_to(min(places[bisect_right(places, barrier)] for places in inner))
        node = page.add(tag, stack[-1], attributes)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened.setdefault(tag, []).append(len(stack) - 1)
        page.blocks.append((stack[-1], []))
    return page


def block_texts(page: Page) -> list[tuple[int, str]]:
    """Blocks that hold text: their node, and the text with single spaces."""
    out = []
    for node, parts in page.blocks:
        if parts and (text := " ".join("".join(parts).split())):
            out.append((node, text))
    return out


def node_features(page: Page, blocks: list[tuple[int, str]]) -> list[list[float]]:
    """A row for each node."""
    n = len(page.tags)
    own, stops, commas, texts, before = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in blocks:
        own[node] += len(text)
        stops[node] += text.count(". ") + text.count("? ") + text.count("! ") + (text[-1] in ".!?")
        commas[node] += text.count(",")
        texts[node] += 1
    chars, links, nodes = own[:], page.links[:], [1] * n
    paragraphs = [int(t == "p") for t in page.tags]
    children: list[int] = [0] * n
    place, same, last = [0] * n, [0] * n, {}
    for i in range(1, n):
        parent = page.parents[i]
        place[i] = children[parent]
        children[parent] += 1
        key = (parent, page.tags[i])
        same[i] = last.get(key, 0)
        last[key] = same[i] + 1
    for i in range(n - 1, 0, -1):
        parent = page.parents[i]
        for column in (chars, links, nodes, paragraphs, stops, commas, texts):
            column[parent] += column[i]
    seen = 0
    order = iter(blocks)
    nxt = next(order, None)
    for i in range(n):
        while nxt is not None and nxt[0] < i:
            seen += len(nxt[1])
            nxt = next(order, None)
        before[i] = seen
    total = max(1, chars[0])
    rows = []
    above: list[tuple[int, ...]] = []
    for i in range(n):
        parent = page.parents[i]
        group = TAG_GROUP.get(page.tags[i], len(GROUPS))
        row = [0.0] * WIDTH
        row[group] = 1.0
        for w in page.words[i]:
            row[len(GROUPS) + 1 + w] = 1.0
        if parent >= 0:
            row[PARENT + TAG_GROUP.get(page.tags[parent], len(GROUPS))] = 1.0
        inside = set() if parent < 0 else set(above[parent])
        if page.tags[i] in ("article", "main"):
            inside.add(0)
        if page.tags[i] in ("nav", "footer", "aside", "form", "header"):
            inside.add(1)
        if page.words[i] & BAD:
            inside.add(2)
        if 0 in page.words[i]:
            inside.add(3)
        above.append(tuple(inside))
        for k in () if parent < 0 else above[parent]:
            row[ABOVE + k] = 1.0
        row[REST:] = (
            chars[i],
            own[i],
            links[i] / max(1, chars[i]),
            nodes[i],
            chars[i] / nodes[i],
            chars[i] / total,
            paragraphs[i],
            100 * stops[i] / max(1, chars[i]),
            100 * commas[i] / max(1, chars[i]),
            page.depths[i],
            place[i],
            children[parent] if parent >= 0 else 1,
            last.get((parent, page.tags[i]), 1),
            before[i] / total,
            chars[i] / max(1, chars[parent]) if parent >= 0 else 1.0,
            texts[i],
        )
        rows.append(row)
    return rows


PARENT = len(GROUPS) + 1 + len(WORDS)
ABOVE = PARENT + len(GROUPS) + 1
REST = ABOVE + 4
WIDTH = REST + 16
BAD = frozenset(range(1, len(WORDS)))


# -- boosted trees ------------------------------------------------------------------------------

#: Trees, their levels, the step of each, bins of a feature, rows of a node, and damping.
TREES, LEVELS, RATE, BINS, LEAST, SHRINK = 80, 4, 0.2, 32, 8, 1.0


@dataclass
class Trees:
    """Complete binary trees: per tree and inner node a feature and a limit, per leaf a value."""

    features: np.ndarray
    limits: np.ndarray
    values: np.ndarray
    start: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.features, self.limits, self.values, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(LEVELS):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - (2**LEVELS - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Fit by the logistic loss, with second-order gains over binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner = 2**LEVELS - 1
    features = np.zeros((TREES, inner), dtype=np.int64)
    limits = np.full((TREES, inner), np.inf)
    values = np.zeros((TREES, inner + 1))
    share = np.average(y, weights=weight)
    start = float(np.log(share / (1 - share)))
    odds = np.full(len(y), start)
    columns = np.arange(x.shape[1])[None, :] * BINS
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        slope, bend = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            if len(rows) >= 2 * LEAST:
                keys = (binned[rows] + columns).ravel()
                g, h, n = (
                    np.bincount(keys, np.repeat(v, x.shape[1]), x.shape[1] * BINS).reshape(-1, BINS)
                    for v in (slope[rows], bend[rows], np.ones(len(rows)))
                )
                gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in (g, h, n))
                gt, ht = slope[rows].sum(), bend[rows].sum()
                gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK)
                gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -np.inf
                f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[f, b] > gt**2 / (ht + SHRINK) + 1e-6 and b < len(edges[f]):
                    features[tree, at], limits[tree, at] = f, edges[f][b]
            right = x[rows, features[tree, at]] > limits[tree, at]
            node[rows] = 2 * at + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        values[tree] = -RATE * g / (h + SHRINK)
        odds += values[tree][leaf]
    return Trees(features, limits, values, start)


# -- training pages -----------------------------------------------------------------------------

#: Pages that the trees are fitted on.
PAGES = 500


def training_pages(count: int = PAGES, seed: int = 11) -> Iterator[str]:
    """Pages from random patterns. An attribute ``data-main`` of 1 or 0 marks the article's
    elements, and with 0 the roots of all other parts; unmarked elements are as their parents."""
    random = np.random.default_rng(seed)
    syllables = "an be cor del e fi go ha in jo ka lu men no or pa que ra si tion un ve wo zu".split()

    def some(*choices):
        return choices[int(random.integers(len(choices)))]

    def chance(p: float) -> bool:
        return bool(random.random() < p)

    def word() -> str:
        return "".join(some(*syllables) for _ in range(int(random.integers(1, 4))))

    def words(low: int, high: int) -> str:
        found = [word() for _ in range(int(random.integers(low, high + 1)))]
        mark = some("", "", "", "###", "!!", "%%%") if chance(0.1) else ""
        return " ".join(w + mark for w in found)

    def prose() -> str:
        sentences = [
            words(1, 18).capitalize() + some(".", ".", ".", "!", "?")
            for _ in range(int(random.integers(1, some(2, 4, 12))))
        ]
        return " ".join(s.replace(" ", ", ", 1) if chance(0.5) else s for s in sentences)

    def named(*names: str) -> str:
        if chance(0.25):
            return ""
        name = some(*names)
        name = some(name, name, f"{word()} {name}", f"{name}-{word()}", f"site-{name}")
        return some(f' class="{name}"', f' id="{name}"', f' class="{name}" id="{word()}"')

    def links(low: int, high: int) -> str:
        count = int(random.integers(low, high + 1))
        items = [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(count)]
        shape = some("ul", "ul", "div", "plain")
        if shape == "ul":
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items) if shape == "plain" else "".join(f"<div>{i}</div>" for i in items)

    def part(tag: str, names: tuple[str, ...], body: str) -> str:
        """A part that is not the article: told by its tag, or by its names."""
        if tag == "div":
            name = some(*names)
            name = some(name, name, f"{name} {word()}", f"{word()} {name}")
            return f'<div {some("class", "class", "id")}="{name}" data-main=0>{body}</div>'
        return f"<{tag}{named(*names)} data-main=0>{body}</{tag}>"

    def menu() -> str:
        return part(some("nav", "nav", "div"), ("nav", "menu", "navbar", "breadcrumb"), links(2, 9))

    def advert() -> str:
        body = some(words(1, 14), f"<p>{words(2, 20)}</p>", prose(), f'<a href="/x">{words(1, 6)}</a>')
        return part("div", ("ad", "ads", "advert", "sponsored", "promo"), body)

    def notice() -> str:
        body = some(prose(), f"<p>{prose()}</p><button>{words(1, 2)}</button>")
        return part("div", ("cookie", "notice", "consent", "newsletter", "popup"), body)

    def form() -> str:
        fields = f"<label>{words(1, 2)}</label><input><button>{words(1, 2)}</button>"
        return part("form", ("search", "login", "signup"), some(fields, f"<p>{words(2, 9)}</p>" + fields))

    def top() -> str:
        body = some(words(1, 4), f"<h1>{words(1, 4)}</h1><p>{words(2, 8)}</p>", f"<div>{words(1, 3)}</div>")
        return part(some("header", "header", "div"), ("header", "masthead", "topbar"), body + (menu() if chance(0.3) else ""))

    def bottom() -> str:
        body = f"&copy; {words(1, 4)} &middot; " + some(words(1, 16), prose(), links(2, 6))
        body = some(body, body, f"<p>{body}</p>", f"<p>{prose()}</p><p>{words(2, 8)}</p>")
        return part(some("footer", "footer", "footer", "div"), ("footer", "bottom", "copyright", "legal"), body)

    def side() -> str:
        body = f"<h3>{words(1, 3)}</h3>" + some(links(3, 8), f"<p>{prose()}</p>", words(3, 20))
        return part(some("aside", "aside", "div"), ("sidebar", "widget", "related", "trending"), body)

    def share() -> str:
        return part("div", ("share", "social", "tags"), links(2, 5))

    def comments() -> str:
        one = [f"<div><b>{word()}</b><p>{prose()}</p></div>" for _ in range(int(random.integers(1, 6)))]
        listed = some("".join(one), "<ol>" + "".join(f"<li>{c}</li>" for c in one) + "</ol>")
        head = some("", f"<h3>{words(1, 3)}</h3>")
        tag, name = some("section", "div", "div"), some("comments", "comment-list", "discussion")
        return f'<{tag} {some("class", "id")}="{name}" data-main=0>{head}{listed}</{tag}>'

    def paragraph() -> str:
        kind = random.random()
        if kind < 0.72:
            return some(f"<p>{prose()}</p>", f"<p>{prose()}", f"<p><b>{prose()}<br>")
        if kind < 0.8:
            return f"<h2>{words(1, 8)}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{prose()}</li>" for _ in range(int(random.integers(1, 6)))) + "</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{prose()}</p></blockquote>"
        if kind < 0.93:
            rows = "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        if kind < 0.96:
            return f"<figure><img><figcaption>{words(3, 12)}</figcaption></figure>"
        return f"<div>{prose()}</div>" if kind < 0.98 else f"<pre>{words(3, 20)}</pre>"

    for _ in range(count):
        inner = [paragraph() for _ in range(int(random.integers(1, some(3, 8, 20))))]
        for extra, p in ((advert, 0.15), (share, 0.15), (side, 0.08), (comments, 0.08), (notice, 0.05)):
            if chance(p):
                inner.insert(int(random.integers(len(inner) + 1)), extra())
        title = f"<h1>{words(1, 12)}</h1>"
        if chance(0.15):
            title = f"<header>{title}</header>"
        body = (title if chance(0.85) else "") + "".join(inner)
        tag = some("article", "article", "article", "div", "main", "section")
        name = named("article", "post", "content", "entry", "story") if tag == "article" else (
            f' class="{some("article", "post", "content", "entry-content", "story-body", "text")}"'
        )
        body = f"<{tag}{name} data-main=1>{body}</{tag}>"
        outside = [f() for f, p in ((comments, 0.3), (side, 0.3), (advert, 0.2), (form, 0.15), (share, 0.1)) if chance(p)]
        if chance(0.5):
            wrap = some("div", "div", "main", "section")
            body = f'<{wrap}{named("page", "wrap", "container", "main")}>{body}{"".join(outside)}</{wrap}>'
        else:
            body += "".join(outside)
        head = [f() for f, p in ((menu, 0.7), (top, 0.4), (advert, 0.5), (notice, 0.25), (form, 0.1)) if chance(p)]
        head = [head[i] for i in random.permutation(len(head))]
        tail = [f() for f, p in ((side, 0.15), (comments, 0.05), (notice, 0.1), (bottom, 0.85)) if chance(p)]
        title = f"<head><title>{words(1, 9)}</title></head>"
        close = "</body></html>" if chance(0.8) else ""
        yield f"<!DOCTYPE html><html>{title}<body>{''.join(head)}{body}{''.join(tail)}{close}"


def labelled_nodes(source: str) -> tuple[list[list[float]], list[int]]:
    """Features of a training page's nodes, and which belong to the article or hold it."""
    page = parse(source)
    labels, marked = [], [("data-main=" in m) for m in page.marks]
    for i, mark in enumerate(page.marks):
        if marked[i]:
            labels.append(int("data-main=1" in mark))
        else:
            labels.append(labels[page.parents[i]] if i else 1)
    return node_features(page, block_texts(page)), labels


_trained: list[Trees] = []


def train() -> Trees:
    """Trees fitted on the training pages, the same each time."""
    if not _trained:
        x, y = [], []
        for source in training_pages():
            rows, labels = labelled_nodes(source)
            x += rows
            y += labels
        _trained.append(boost(np.array(x), np.array(y, dtype=np.float64), np.ones(len(y))))
    return _trained[0]


# -- decoding -----------------------------------------------------------------------------------


def decode(parents: list[int], odds: list[float]) -> list[bool]:
    """The most likely choice of nodes in which each chosen node's parent is chosen; the root is."""
    n = len(parents)
    keep = [0.0] * n  # log-odds of the best choice below a chosen node, against choosing nothing
    for i in range(n - 1, -1, -1):
        keep[i] += odds[i]
        if i and keep[i] > 0:
            keep[parents[i]] += keep[i]
    chosen = [True] * n
    for i in range(1, n):
        chosen[i] = chosen[parents[i]] and keep[i] > 0
    return chosen


def extract(sources: list[str | None], trees: Trees) -> list[str]:
    """Main text of each page; empty for null, empty or textless ones."""
    pages = [parse(s or "") for s in sources]
    texts = [block_texts(p) for p in pages]
    rows = [r for p, b in zip(pages, texts, strict=True) for r in node_features(p, b)]
    odds = trees.odds(np.array(rows)).tolist() if rows else []
    out, at = [], 0
    for page, blocks in zip(pages, texts, strict=True):
        chosen = decode(page.parents, odds[at : at + len(page.tags)])
        at += len(page.tags)
        out.append("\n".join(text for node, text in blocks if chosen[node]))
    return out


def with_main_text(df: DataFrame, source: str, text: str = "main_text", size: str = "n_chars") -> DataFrame:
    """Add the main text of each page and its number of characters; all rows stay.

    Null and empty pages have the empty text. Whole pages are read, however long; blocks are
    joined by line breaks, and white space in a block is one space. New columns that are there
    already are an error.
    """
    for name in (text, size):
        if name in df.columns:
            raise ValueError(f"the table has a column {name} already")
    spark = df.sparkSession
    common.prepare_workers(spark)
    shared, place = spark.sparkContext.broadcast(train()), df.columns.index(source)
    schema = StructType([*df.schema.fields]).add(text, StringType()).add(size, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            sources = batch.column(place).to_pylist()
            found = [t for i in range(0, len(sources), 64) for t in extract(sources[i : i + 64], trees)]
            columns = [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.fieldNames())

    return df.mapInArrow(run, schema)
