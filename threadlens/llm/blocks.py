"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at its block-level tags.  A block is described
by its words and link density, those of the two blocks before and after, the
kind of its element, whether it lies in a content or a side element, and
whether an open element is named as a side or a content part.  A CART tree,
grown here on the labelled blocks of a few invented pages of different make
(``training_pages``), says which blocks are main text.

Names count only for parts: a class or id names a side part if its last word
does (``share-bar``), or its first and no word of its own follows
(``ad-slot``); words that only tell about a layout or a topic (``has-sidebar``,
``category-social``, ``tags-news``) and headers of articles (``entry-header``)
don't.  An element that holds the page's content elements, or most of its words
where no content element lies outside, is a wrapper: its name, and its being a
form, say nothing about what is in it.  A heading such as "Comments" names its
section, or what follows it up to the next heading of its rank.

Defined cases: a null or empty page has the empty text; an unclosed tag, quote
or comment is read as far as it goes; tags and comments never reach the text;
hidden elements are side parts; character references are decoded once; a page
without blocks, or whose blocks are all side parts, has the empty text; repeated
rows are extracted alike; an empty table gives an empty result; input columns
that bear an output name are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.shared import ship

# HTML element names by their role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split())
RAW_TAGS = frozenset("script style noscript template textarea svg math iframe object canvas title select".split())
CONTENT_TAGS, SIDE_TAGS = frozenset({"article", "main"}), frozenset("nav footer header aside form menu dialog button fieldset label".split())
#: Side elements that some sites put around the whole page.
LOOSE_TAGS = frozenset("form fieldset label menu".split())
LEAVES = frozenset("p li hr dt dd td th tr option h1 h2 h3 h4 h5 h6".split())
# Words in class and id that name side parts, words without a meaning of their own beside them, words that speak of the page or topic, names of content.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright dialog disclaimer "
    "disqus footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget "
    "widgets".split())
PLAIN_WORDS = frozenset(
    "area author avatar bar block body bottom box btn button buttons card col column container content cta desktop fixed form group head heading icons "
    "inner item items left link links list main meta mobile outer overlay panel posts primary right row secondary section side slot space sticky "
    "stories text thread title top unit wrap wrapper".split())
ABOUT_WORDS = frozenset("has with without no not is are category cat tag tags topic status format type layout template theme page site show hide js open closed single".split())
CONTENT_WORDS = frozenset("article articlebody content entry main post story text".split())
_SIDE_HEADING = re.compile(
    r"(\d+\s+)?(reader\s+|user\s+|leave\s+a\s+|post\s+a\s+|add\s+a\s+)?(comments?|replies|reply|responses|kommentare?|comentarios?|commentaires?)(\s*\(?\d*\)?|\s+on\s.*|:)?"
    r"|(related|recommended|more|popular|recent)\s+(articles?|stories|posts?|reading|news)|share\s+this.*|advertisement|newsletter|you\s+may\s+also\s+like", re.I | re.S)

_SCAN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:"[^"]*+"|'[^']*+'|[^'">])*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Element:
    """An open element of a page, and what it turns out to hold."""

    tag: str
    parent: int
    name: int  # -1 named as a side part, 1 as content, 0 neither
    hidden: bool
    words: int = 0
    contents: int = 0  # content elements that are no side parts, itself included
    marked: int = 0  # those and elements named as content


@dataclass
class Block:
    """One run of text between block-level tags."""

    text: str
    words: int
    linked: int
    kind: int  # 2 heading, 1 paragraph, 0 other, -1 list item or cell
    element: int = 0
    muted: bool = False  # below a heading that names a side part
    region: int = 0  # 1 in a content element, -1 in a side element, 0 in neither
    name: int = 0  # -1 in a part named as a side part, 1 in one named as content


FEATURES = ("words", "density", "before_words", "before_density", "after_words", "after_density", "around_words", "around_density", "kind", "region", "name")


def _kind(tag: str) -> int:
    return 2 if re.fullmatch("h[1-6]", tag) else 1 if tag in ("p", "pre", "blockquote") else -1 if tag in ("li", "td", "th", "dt", "dd", "option") else 0


def token_name(token: str) -> int:
    """What one class, id or role says: -1 a side part, 1 content, 0 nothing."""
    parts = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())
    if not parts or (len(parts) > 1 and parts[0] in ABOUT_WORDS and not (parts[0] in ("page", "site") and parts[-1] in SIDE_WORDS)):
        return 0
    own = [p for p in parts if p in CONTENT_WORDS]
    if parts[-1] == "header" and own:
        return 0
    if parts[-1] in SIDE_WORDS or (parts[0] in SIDE_WORDS and all(p in SIDE_WORDS or p in PLAIN_WORDS for p in parts)):
        return -1
    return 1 if own and all(p in CONTENT_WORDS or p in PLAIN_WORDS for p in parts) else 0


def _named(attributes: str) -> int:
    names = [token_name(t) for m in _NAMES.finditer(attributes) for t in m[1].strip("\"'").split()]
    return -1 if -1 in names else max(names, default=0)


@dataclass
class _Page:
    """State of one pass over a page."""

    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, False)])
    stack: list[int] = field(default_factory=lambda: [0])
    out: list[Block] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    in_link: bool = False
    tag: str = ""
    at: int = 0  # the element of the current block
    muted: tuple[int, int] | None = None  # element, rank of the heading

    def add(self, raw: str) -> None:
        if raw:
            plain = html.unescape(raw)
            self.text.append(plain)
            if self.in_link:
                self.linked.append(plain)

    def close(self) -> None:
        """End the current block."""
        if not self.text:
            return
        flat = " ".join("".join(self.text).split())
        if flat:
            kind, block = _kind(self.tag), Block(flat, flat.count(" ") + 1, len("".join(self.linked).split()), 0, self.at)
            block.kind = kind
            if kind == 2:
                self.heading(flat)
            block.muted = self.muted is not None
            self.out.append(block)
        self.text, self.linked = [], []

    def heading(self, text: str) -> None:
        rank = int(self.tag[1])
        if self.muted and rank <= self.muted[1]:
            self.muted = None
        if len(text) < 80 and _SIDE_HEADING.fullmatch(text) and self.muted is None:
            self.muted = (self.stack[-1], rank)

    def open(self, tag: str, attributes: str, stays: bool) -> None:
        plain = not attributes or attributes.isspace()
        hidden = not plain and bool(_HIDDEN.search(attributes))
        name = 0 if plain or tag in ("html", "body") else _named(attributes)
        self.elements.append(Element(tag, self.stack[-1], name, hidden, contents=int(tag in CONTENT_TAGS and name >= 0), marked=int(name > 0 or (tag in CONTENT_TAGS and name >= 0))))
        self.at = len(self.elements) - 1
        if stays:
            self.stack.append(self.at)

    def end(self, tag: str) -> None:
        depth = next((d for d in range(len(self.stack) - 1, 0, -1) if self.elements[self.stack[d]].tag == tag), None)
        if depth is not None:
            del self.stack[depth:]
            if self.muted and self.muted[0] not in self.stack:
                self.muted = None
        self.at = self.stack[-1]


def _placed(page: _Page) -> list[Block]:
    """The blocks with region and name, once it is known what every element holds."""
    elements = page.elements
    for b in page.out:
        elements[b.element].words += b.words
    for e in reversed(elements[1:]):
        elements[e.parent].words += e.words
        elements[e.parent].contents += e.contents
        elements[e.parent].marked += e.marked
    total, marked = elements[0].words, elements[0].marked
    region, name = [0] * len(elements), [0] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        above = region[e.parent]
        inner = e.contents - (e.tag in CONTENT_TAGS and e.name >= 0)
        wrapper = (inner > 0 or (e.words > 0.6 * total and e.marked == marked)) and e.tag not in ("nav", "footer", "aside")
        if e.tag in CONTENT_TAGS:
            region[k] = above if above < 0 else 1
        elif e.tag in SIDE_TAGS and not (wrapper and e.tag in LOOSE_TAGS) and not (e.tag == "header" and (above > 0 or wrapper)):
            region[k] = -1
        else:
            region[k] = above
        own = e.name if not (e.name < 0 and wrapper) else 0
        if e.hidden:
            own = -1
        name[k] = own if name[e.parent] == 0 or own < 0 else name[e.parent]
    for b in page.out:
        b.region, b.name = region[b.element], -1 if b.muted else name[b.element]
    return page.out


def blocks(text: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    page, at = _Page(), 0
    while True:
        m = _SCAN.search(text, at)
        if m is None:
            page.add(text[at:])
            break
        page.add(text[at: m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                page.add(m[0][9:].removesuffix("]]>"))
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW_TAGS and not closing:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
                at = end.end() if end else len(text)
            if tag == "select":
                page.close()
            continue
        if tag == "a":
            page.in_link = not closing
        elif tag in ("br", "img", "input"):
            page.add(" ")
        if tag not in BLOCK_TAGS:
            continue
        page.close()
        page.in_link = page.in_link and tag in ("div", "h1", "h2", "h3", "h4", "h5", "h6", "p")
        if closing:
            page.tag = ""
            if tag in LEAVES:
                page.at = page.stack[-1]
            else:
                page.end(tag)
        elif tag not in ("html", "head") and not attributes.endswith("/"):
            page.open(tag, attributes, stays=tag not in LEAVES)
            page.tag = tag
    page.close()
    return _placed(page)


def features(page: list[Block]) -> np.ndarray:
    """FEATURES of every block of one page."""
    if not page:
        return np.zeros((0, len(FEATURES)))
    own = np.array([[b.words, b.linked / b.words] for b in page])
    linked = np.array([float(b.linked) for b in page])
    words = own[:, 0]
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own])[: len(own)], np.vstack([own, edge])[1:]

    def around(x: np.ndarray) -> np.ndarray:
        """Sums over the two blocks before and the two after."""
        wide = np.concatenate([[0, 0], x, [0, 0]])
        n = len(x)
        return wide[:n] + wide[1: n + 1] + wide[3: n + 3] + wide[4: n + 4]

    near = around(words)
    rest = np.array([[b.kind, b.region, b.name] for b in page])
    return np.column_stack([own, before, after, near, around(linked) / np.maximum(near, 1), rest])


@dataclass
class Tree:
    """A grown tree: per node feature, threshold, children, share of main text."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def main(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(x) and (open_ := self.feature[node] >= 0).any():
            low = x[np.arange(len(x)), np.maximum(self.feature[node], 0)] <= self.threshold[node]
            node = np.where(open_, np.where(low, self.left[node], self.right[node]), node)
        return self.share[node] >= 0.5


def grow(x: np.ndarray, y: np.ndarray, depth: int = 14) -> Tree:
    """CART with Gini impurity."""
    nodes: list[list] = []

    def split(rows: np.ndarray, left_depth: int) -> int:
        me, own = len(nodes), y[rows]
        nodes.append([-1, 0.0, 0, 0, float(own.mean())])
        if left_depth and 0 < own.sum() < len(own):
            best = None
            for f in range(x.shape[1]):
                order = np.argsort(x[rows, f], kind="stable")
                v, hits = x[rows[order], f], np.cumsum(own[order])
                cut = np.flatnonzero(v[1:] > v[:-1])
                if not len(cut):
                    continue
                n, p = cut + 1.0, hits[cut]
                m, q = len(own) - n, hits[-1] - p
                impurity = (2 * p * (n - p) / n + 2 * q * (m - q) / m) / len(own)
                i = int(np.argmin(impurity))
                if best is None or impurity[i] < best[0] - 1e-12:
                    best = (impurity[i], f, (v[cut[i]] + v[cut[i] + 1]) / 2)
            if best:
                _, f, t = best
                low = x[rows, f] <= t
                nodes[me][:4] = [f, t, split(rows[low], left_depth - 1), split(rows[~low], left_depth - 1)]
        return me

    split(np.arange(len(y)), depth)
    columns = list(zip(*nodes))
    return Tree(*[np.array(c, k) for c, k in zip(columns, (np.int64, float, np.int64, np.int64, float))])


# Pages that the tree is grown on: blocks that begin with a plus sign are main text (the sign is no part of them).
_LONG = "the council met on tuesday evening to hear the plans for the bridge and its cost which had risen since the spring and several members spoke against it"
_MID = "the vote was closer than anyone in the room had expected before the debate"
_SHORT = "it passed by two votes"


def training_pages() -> list[str]:
    """Invented pages of different make: with and without content elements and names, with link lists, captions and notices among the text."""
    menu = "<ul>" + "".join(f"<li><a href=x>{w}</a></li>" for w in ("Home", "World news", "Sports", "About us", "Contact")) + "</ul>"
    cards = "".join(f"<li><a href=x>{t}</a></li>" for t in (_MID, "another story of the day from the region", _SHORT, "the weather this week"))
    body = f"<p>+{_LONG}<p>+{_MID} <a>{_SHORT}</a> {_LONG}<p>+{_SHORT}<p>+So<p>+{_LONG} {_LONG}<p>+Two words<p>+{_LONG}<p>+Three more words<p>+{_MID}<ul><li>+{_SHORT}<li>+One <a>link</a> and more<li>+{_MID}</ul><p>+{_LONG}<p>+{_MID}"
    few = f"<p>+{_MID}<p>+Yes<p>+<a>{_SHORT}</a><p>+{_MID}"
    titled = f"<h1>+A bridge too dear</h1>{body}"
    foot = f"<p>Copyright 2026 The Paper, all rights reserved</p><p><a>Imprint</a> <a>Privacy policy</a> <a>Terms</a></p><p>{_MID}</p>"
    notice = f"<p>{_MID} we use cookies to make this site work for you</p>"
    comments = f"<p>{_LONG}</p><p>{_SHORT}</p><p>I agree</p>"
    return [
        # content elements, with menus and link lists inside and outside
        f"<nav>{menu}</nav><main>{titled}<ul>{cards}</ul></main><footer>{foot}</footer>",
        f"<header><p>The Paper</p>{menu}</header><article><header><h1>+A bridge</h1><p>+By A Writer</p></header>{body}<h2>+More of it</h2>{few}<aside>{notice}</aside>{few}</article><aside>{menu}{notice}</aside>",
        f"<div>{notice}</div><article><h1>+Title</h1>{few}<p>+a<p>+{_LONG}</article><div>{menu}</div><footer>{foot}</footer>",
        f"<article><p>+{_SHORT}</article><footer>{foot}</footer>", f"<article><p>+Word<p>+Two words<p>+{_MID}</article><ul>{cards}</ul>",
        "<article><p>+Some text</article>", f"<article><p>+{_LONG}<p>+Ends</article>", "<article><h1>+T</h1><p>+One two</article>", f"<main><h2>+A title</h2><p>+{_MID}<p>+Three last words</main>",
        f"<article><p>+{_MID}<p>+{_LONG}<p>+So<p>+it is</article>", f"<div>{menu}</div><article><h1>+T</h1><p>+{_LONG}<p>+Yes</article>", f"<div>{_MID}</div><article><p>+One<p>+{_LONG}<p>+End</article>",
        f"<main><h1>+News</h1><p>+{_SHORT}</main>", f"<article><h1>+T</h1><p>+{_LONG}</article>", "<main><p>+One<p>+Two</main><footer>Three</footer>",
        f"<article><p>+{_LONG} {_LONG} {_LONG}</article>", f"<main><p>+<a>{_MID}</a></main>", f"<div>{menu}</div><article><p>+{_SHORT}</article><div>{menu}</div>",
        f"<article><p>+{_LONG}<table><tr><td>+Cost<td>+12<tr><td>+Length<td>+300 m</table><p>+{_LONG}<ol><li>+{_MID}<li>+{_SHORT}</ol></article>",
        f"<div>{_SHORT}</div><article>{body}<div>+{_MID}</div><div class=share><a>Tweet</a> <a>Mail</a></div><section class=comments>{comments}</section></article>{menu}",
        f"<main><div class=newsletter><p>{_MID}</p><form><p>Your mail</p></form></div>{titled}<div class=related><h3>Related</h3><ul>{cards}</ul></div></main>",
        # names only
        f"<div id=page><div id=header><h1>The Paper</h1>{menu}</div><div id=content><h2>+A bridge</h2>{body}</div><div class=sidebar><h3>Recent</h3><p>{_LONG}</p>{menu}</div><div id=footer>{foot}</div></div>",
        f"<div class=top-nav>{menu}</div><div class=post-content>{few}{body}</div><div class=ad-slot><p>{_MID}</p></div><div class=cookie-banner>{notice}</div>",
        f"<div class=entry-content><p>+{_SHORT}<p>+{_LONG}<p>+No</div><div id=comments>{comments}{comments}</div>",
        # neither: words, links and neighbours
        f"<div>{menu}</div><div><h1>+A bridge too dear</h1>{body}{body}</div><div>{menu}</div><div><p>Contact</p><p>Imprint</p></div>",
        f"<table><tr><td>{menu}<td><h2>+Title of it</h2>{body}<td><p><a>Ad one</a><p><a>Ad two here</a></table><p>Copyright 2026</p>",
        f"<div>Site name</div><div>{menu}</div><div><p>+{_LONG}</p><p>+{_LONG} {_LONG}</p><p>+{_MID}</p><p>+{_LONG}</p></div><ul>{cards}</ul>",
        f"<div><a>Log in</a></div><div><a>Search</a></div><h1>+The long read</h1><div>+{_LONG}</div><div>+{_LONG}</div><blockquote>+{_SHORT} {_SHORT}</blockquote><div>+{_LONG}</div><div><a>Next</a></div><div>Page 1</div>",
        f"<div><h1>+Bridges</h1>{body}</div>", f"<p>+{_LONG}<p>+{_MID}<p>+{_LONG}", f"<div>+{_MID}</div><div>+{_MID}</div><div>+{_LONG}</div><div>+{_MID}</div><div>+{_MID}</div>",
        f"<ul>{cards}</ul><div>{menu}</div><p>12 May</p><ul>{cards}</ul>", f"<div>{menu}</div><p>Nothing here</p><div>{menu}</div>",
    ]


def labelled_table() -> np.ndarray:
    """Features and label of every block of the training pages."""
    out = []
    for page in training_pages():
        found = blocks(page)
        out.append(np.column_stack([features(found), [b.text.startswith("+") for b in found]]))
    return np.vstack(out).astype(float)


@lru_cache(1)
def trained_tree() -> Tree:
    table = labelled_table()
    return grow(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    """The main text blocks of a page, joined by line ends."""
    if not page:
        return ""
    found = blocks(page)
    keep = tree.main(features(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column`` and with ``text`` and ``n_chars``."""
    ship(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(column))
    schema = T.StructType([f for f in rows.schema if f.name != column] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained_tree()
        for batch in batches:
            # a batch is extracted in parts, so that its texts aren't all held twice
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.as_py(), tree) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=[*part.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op4_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages.select("page_id", "url", "html"))
