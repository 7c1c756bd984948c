"""Main text of web pages: flat text blocks, classified by a decision tree over their own and their neighbours' shape."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.html_labels import LABEL, labelled_pages

#: Elements that end a block of text where they start and where they end.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose content is never shown text.
HIDDEN = frozenset("script style noscript template title textarea iframe object svg math canvas audio video".split())
#: Those of them that browsers read on after when their end tag is missing.
EMBEDDED = frozenset("noscript template iframe object svg math canvas audio video".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open element of the values (their end tags may be left out).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: Elements that hold what surrounds an article.
FRAME = frozenset("nav footer aside menu dialog button select search".split())
#: First words of names that make even an ``article`` element what readers wrote.
READER_WORDS = frozenset("comment comments reply replies respond response responses discussion disqus".split())
#: A form that holds more than this share of a page's words wraps the page; any other is no part of the article.
WRAPPER_SHARE = 0.5
#: Words in class, id and role values that name what surrounds an article, and those that name the article.
FRAME_WORDS = frozenset("""ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments
    complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus feedback foot footer
    gdpr header hidden legal login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay
    pager pagination popup privacy promo promoted promotion reader related reply replies respond responses search share
    sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar topbar tracking warning
    widget""".split())
MAIN_WORDS = frozenset("article articlebody body content entry main maincontent post story text".split())
#: Parts of a name that tell a state or a layout of the element, not what it is: has-sidebar, comments-open.
STATE_WORDS = frozenset("""has have no not with without open opened closed enabled disabled active inactive layout
    js""".split())
#: Frame words that name the head of an article when an article word comes before them: post-header.
HEAD_WORDS = frozenset("header banner masthead".split())
# A quote is a delimiter only at the start of a value; possessive, so that cut-off tags cost no backtracking.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)"""
                    r"""((?:[^>=]++|=\s*+(?>"[^"]*"|'[^']*'|[^\s>"'][^\s>]*|))*+)>""", re.S)
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_MARKED = re.compile(r"class|id|role|hidden|style", re.I)
_IN_VALUE = re.compile(r"=\s*+[^\s\"'>]++\Z")
_BLANK = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_frame",
            "in_main", "page_has_main", "is_heading")


@dataclass
class Block:
    """One run of text between block boundaries."""

    text: str
    words: int
    linked: int
    in_frame: bool
    in_main: bool
    heading: bool
    form: int = 0  # number of the outermost form around it, 0 without


@dataclass
class _Open:
    name: str
    frame: bool
    main: bool
    form: int = 0


@dataclass
class _Builder:
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)

    def flush(self, stack: list[_Open]) -> None:
        text = _BLANK.sub(" ", unescape("".join(p for p, _ in self.parts))).strip()
        if text:
            linked = sum(len(unescape(p).split()) for p, in_link in self.parts if in_link)
            top = stack[-1] if stack else _Open("", False, False)
            heading = any(e.name in ("h1", "h2", "h3", "h4", "h5", "h6") for e in stack[-3:])
            n = len(text.split())
            self.blocks.append(Block(text, n, min(n, linked), top.frame, top.main, heading, top.form))
        self.parts.clear()


def _names(value: str) -> tuple[bool, bool]:
    """(names what surrounds an article, names the article) of a class, id or role value, name by name.

    The first whole name decides. Of a name of several words (parted by signs or capitals), a frame word counts unless the
    element also has a whole main name, the name tells a state or layout, or it is the head of an article.
    """
    frame = main = part_frame = part_main = False
    for name in value.split():
        parts = [w for w in re.split(r"[^a-z]+", _CAMEL.sub("-", name).lower()) if w]
        name = name.lower()
        if name in FRAME_WORDS or name in MAIN_WORDS:
            frame |= name in FRAME_WORDS and not main
            main |= name in MAIN_WORDS and not frame
            continue
        if STATE_WORDS.intersection(parts):
            continue
        surrounds = FRAME_WORDS.intersection(parts)
        if not surrounds:
            part_main |= bool(MAIN_WORDS.intersection(parts))
        elif not (surrounds <= HEAD_WORDS and parts[0] in MAIN_WORDS and parts[0] not in ("main", "body")):
            part_frame = True
    return frame or part_frame and not main, main or part_main


def _by_readers(value: str) -> bool:
    """Whether a class, id or role value names what readers wrote: comment, comment-body, replyList."""
    names = [[w for w in re.split(r"[^a-z]+", _CAMEL.sub("-", x).lower()) if w] for x in value.split()]
    return any(parts and parts[0] in READER_WORDS and not STATE_WORDS.intersection(parts) for parts in names)


def _marks(name: str, attributes: str) -> tuple[bool, bool]:
    """(belongs to what surrounds an article, belongs to the article), from the element and its names.

    The whole page is neither. Names do not make an ``article`` or ``main`` element part of what surrounds one, unless they
    say that readers wrote it.
    """
    if name in ("html", "body"):
        return False, False
    own = name in ("article", "main")
    frame, main = name in FRAME, own
    named_frame = named_main = False
    for key, value in _ATTR.findall(attributes) if _MARKED.search(attributes) else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            frame = True
        elif key == "style":
            frame |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()))
        elif key in ("class", "id", "role"):
            frame |= own and _by_readers(value)
            f, m = _names(value)
            named_frame |= f
            named_main |= m
    return frame or named_frame and not own, main or named_main


def text_blocks(html: str | None) -> list[Block]:
    """The page as a flat list of blocks, in page order; unclosed, stray and cut-off tags are tolerated."""
    html = html or ""
    out, stack, links, at, breaks, forms = _Builder(), [], 0, 0, 0, 0
    n = len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        end = m.start() if m else n
        if end > at:
            chunk = html[at:end]
            if not m:  # a tag that the page's end cuts off is markup, not text
                cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", chunk)
                chunk = chunk[:cut.start()] if cut else chunk
            if chunk:
                out.parts.append((chunk, links > 0))
                if not chunk.isspace():
                    breaks = 0
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # an end tag closes the nearest such element, and what is open inside it
            if name in BLOCK or name == "p":
                out.flush(stack)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    if name == "a":
                        links = max(0, links - 1)
                    if name in BLOCK or all(e.name not in BLOCK for e in stack[i:]):
                        links -= sum(e.name == "a" for e in stack[i + 1:])
                        links = max(0, links)
                        del stack[i:]
                    break
            continue
        closed = m[3].endswith("/") and not _IN_VALUE.search(m[3])  # a slash that ends an unquoted value closes nothing
        if name in HIDDEN and not closed:
            tag = re.compile(rf"<(/?){re.escape(name)}\b[^>]*>", re.I)
            open_, close = 1, None
            while open_ and (close := tag.search(html, close.end() if close else at)):
                if name in EMBEDDED and name not in ("svg", "object") and not close[1]:
                    close = None  # begins anew before it ended: the first has no end
                    break
                open_ += -1 if close[1] else int(name in ("svg", "object") and not close[0].endswith("/>"))
            at = close.end() if close else at if name in EMBEDDED else n
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:  # two breaks in a row part blocks, one is white space
                out.flush(stack)
            else:
                out.parts.append((" ", links > 0))
            continue
        if name in BLOCK:
            out.flush(stack)
            breaks = 0
            shut = CLOSES.get(name, ())
            while stack and (stack[-1].name in shut or stack[-1].name == "p"
                             or stack[-1].name in ("b", "i", "em", "strong", "u", "span", "font", "a")
                             and any(e.name == "p" for e in stack[-4:])):
                links -= stack[-1].name == "a"
                stack.pop()
            links = max(0, links)
        if name in VOID or closed:
            continue
        frame, main = _marks(name, m[3])
        if stack:
            top = stack[-1]
            # a page header names the site; a header inside the article belongs to the article
            frame |= top.frame or name == "header" and not top.main
            main = (main or top.main) and not frame
        else:
            frame |= name == "header"
            main = main and not frame
        links += name == "a"
        form = stack[-1].form if stack else 0
        if name == "form" and not form:
            forms += 1
            form = forms
        stack.append(_Open(name, frame, main, form))
    out.flush(stack)
    _leave_out_forms(out.blocks)
    return out.blocks


def _leave_out_forms(blocks: list[Block]) -> None:
    """Blocks in a form are no part of the article, unless the form wraps the page."""
    words: dict[int, int] = {}
    for b in blocks:
        words[b.form] = words.get(b.form, 0) + b.words
    for b in blocks:
        if b.form and words[b.form] <= WRAPPER_SHARE * sum(words.values()):
            b.in_frame, b.in_main = True, False


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row per block: words and link density of it and of its neighbours, and where it stands."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked for b in blocks], float) / words
    before, after = np.r_[0.0, words[:-1]], np.r_[words[1:], 0.0]
    d_before, d_after = np.r_[1.0, density[:-1]], np.r_[density[1:], 1.0]
    main = np.array([b.in_main for b in blocks], float)
    return np.column_stack([words, density, before, d_before, after, d_after, [b.in_frame for b in blocks], main,
                            np.full(len(blocks), main.any(), float), [b.heading for b in blocks]])


@dataclass(frozen=True)
class Tree:
    """A binary decision tree in flat arrays: a leaf has feature -1."""

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    keep: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(x) and (inner := self.feature[node] >= 0).any():
            go_left = x[np.arange(len(x)), np.maximum(self.feature[node], 0)] <= self.bound[node]
            node = np.where(inner, np.where(go_left, self.left[node], self.right[node]), node)
        return self.keep[node]


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """Grow a tree by the largest drop in Gini impurity; ties take the first feature and the lowest bound. The first question is
    whether the page names an article at all, so that pages that do not are judged by words, links and neighbours."""
    first = FEATURES.index("page_has_main")
    nodes: list[list] = []

    def gini(a: np.ndarray) -> np.ndarray:
        return 2 * a * (1 - a)

    def grow(rows: np.ndarray, level: int) -> int:
        me, share = len(nodes), y[rows].mean()
        nodes.append([-1, 0.0, -1, -1, share >= 0.5])
        if level == depth or share in (0.0, 1.0):
            return me
        best = (1e-9, -1, 0.0)
        for f in [first] if not level and len(set(x[rows, first])) > 1 else range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, ones = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(rows))
            ok = (v[1:] > v[:-1]) & (n >= least) & (len(rows) - n >= least)
            if not ok.any():
                continue
            parts = (n * gini(ones[:-1] / n) + (len(rows) - n) * gini((ones[-1] - ones[:-1]) / (len(rows) - n)))
            gain = np.where(ok, gini(share) - parts / len(rows), -1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], f, (v[i] + v[i + 1]) / 2)
        if best[1] >= 0:
            go = x[rows, best[1]] <= best[2]
            nodes[me][:2] = best[1:]
            nodes[me][2], nodes[me][3] = grow(rows[go], level + 1), grow(rows[~go], level + 1)
        return me

    grow(np.arange(len(y)), 0)
    return Tree(*[np.array(c) for c in zip(*nodes)])


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the small labelled pages, one row per block."""
    xs, ys = [], []
    for html in labelled_pages():
        blocks = text_blocks(html)
        xs.append(block_features(blocks))
        ys.append(np.array([b.text.endswith(LABEL) for b in blocks], float))
    return np.vstack(xs), np.concatenate(ys)


def main_text(html: str | None, tree: Tree) -> str:
    blocks = text_blocks(html)
    keep = tree.predict(block_features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The columns of ``pages`` without the HTML, and the page's main text with its length in code points.

    Per-row work in one scan, no shuffle; the tree is trained on the labelled table (a fixed few hundred blocks) and
    travels with the tasks. Defined cases: null and empty HTML give an empty text; HTML without tags is one block;
    repeated rows each come out; an empty table stays empty; input columns named like ``text_col`` or ``n_chars`` are
    replaced.
    """
    tree = train_tree(*labelled_table())
    keep = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]

    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h, tree) for h in batch], dtype=object)

    udf = F.pandas_udf(extract, "string")
    return (pages.withColumn("__text", udf(F.col(html_col)))
            .select(*keep, F.col("__text").alias(text_col), F.length("__text").cast("long").alias("n_chars")))
