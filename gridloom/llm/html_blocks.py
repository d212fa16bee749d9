"""Main text of web pages: flat blocks of text, kept or dropped by a decision tree.

A page is cut into blocks at block-level tags; what remains inside is inline. Each block has the number of its
words, the share of them in links, the same of the block before and after, and the marks of the elements around it
(by tag, role and words of class and id). A small decision tree, grown on the labelled blocks of `html_samples`,
tells article text from the rest. Only the tree, a few dozen nodes, travels to the tasks.

Defined results: a null or empty page, or one without article text, gives an empty text. Comments, scripts, styles
and the like never make blocks; an unclosed one swallows the rest of the page, as in browsers. Pages of any length are
read once from left to right. Repeated rows give repeated results; an empty table gives no rows; columns the
operator adds replace input columns of the same name, all others are carried along.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import LONG, STRING, with_text

#: Labelled blocks that come to the driver to grow the tree, and bounds of the tree.
MAX_TRAINING_BLOCKS, DEPTH, LEAST_LEAF = 20_000, 7, 1
FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "inner_mark", "least_mark", "heading", "list_item",
)

# Fixed values of HTML: elements that start a block, elements whose content is not text, elements that part words.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td textarea tfoot th thead tr ul".split()
)
OPAQUE = frozenset("script style title template noscript iframe object svg canvas audio video textarea xmp noembed noframes".split())
SPACES = frozenset(("br", "img"))
#: Elements that end where one of their kind starts, and those that carry no mark of their own.
SIBLINGS = {"li": "l", "dt": "d", "dd": "d", "td": "c", "th": "c", "tr": "r", "option": "o"}
PLAIN = frozenset(("p", "html", "head", "body", "hr"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# Marks of elements: 2 and -2 by tag or role, 1 and -1 by words of class or id, 0 without a mark.
MAIN_TAGS = frozenset(("article", "main"))
REST_TAGS = frozenset("nav aside footer form menu dialog button select fieldset label legend search".split())
MAIN_ROLES = frozenset(("main", "article"))
REST_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MAIN_WORDS = frozenset("article content main post entry body story text page".split())
REST_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices alert "
    "disclaimer nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar toolbar footer bottombar copyright legal sidebar rail widget "
    "widgets related recommended recommendations trending popular teaser share sharing social follow newsletter signup subscribe login search form comment "
    "comments commentlist disqus reply replies respond feedback discussion pagination pager tags tagcloud popup modal overlay skip".split()
)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def mark_of(name: str, attributes: str) -> int:
    """Mark of an element by its own tag, role, class and id."""
    mark = 2 if name in MAIN_TAGS else -2 if name in REST_TAGS or name == "header" else 0
    words: set[str] = set()
    if attributes and name not in ("html", "body"):
        for key, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            if key.lower() == "role":
                role = value.strip().lower()
                mark = 2 if role in MAIN_ROLES else -2 if role in REST_ROLES else mark
            else:
                words.update(w.lower() for w in _WORD.findall(value))
    if words & REST_WORDS and not (name in HEADINGS and words & MAIN_WORDS):
        return min(mark, -1) if mark <= 0 else -1
    if words & MAIN_WORDS and mark == 0:
        return 1
    return mark


class Block:
    __slots__ = ("text", "words", "linked", "inner", "least", "heading", "item")

    def __init__(self, text: str, linked: int, inner: int, least: int, heading: bool, item: bool):
        self.text, self.words, self.linked = text, len(text.split()), linked
        self.inner, self.least, self.heading, self.item = inner, least, heading, item


def _decoded(raw: str) -> str:
    return html.unescape(raw) if "&" in raw else raw


def _tag_end(page: str, at: int) -> int:
    """Place of the > that ends the tag, outside quoted values; -1 where there is none."""
    while True:
        found = _QUOTE.search(page, at)
        if not found:
            return -1
        if found.group() == ">":
            return found.start()
        # A quote counts only as the start of a value, that is after an equals sign.
        if page[:found.start()][-64:].rstrip()[-1:] != "=":
            at = found.end()
            continue
        close = page.find(found.group(), found.end())
        if close < 0:
            return page.find(">", found.end())
        at = close + 1


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, each with its white space settled."""
    made: list[Block] = []
    # Open elements that may carry a mark: (name, mark, least mark so far, innermost mark so far).
    stack: list[tuple[str, int, int]] = [("", 2, 0)]
    open_now: Counter = Counter()
    parts: list[str] = []
    linked, links, heading, item = 0, 0, "", False

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            made.append(Block(text, linked, stack[-1][2], stack[-1][1], bool(heading), item))
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = _decoded(raw)
            parts.append(text)
            if links:
                linked += len(text.split())

    at, size, lower = 0, len(page), None
    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            add(page[at:])
            break
        after = page[sign + 1: sign + 2]
        if after == "!" or after == "?":
            add(page[at:sign])
            if page.startswith("<!--", sign):
                if page.startswith(("<!-->", "<!--->"), sign):
                    at = page.index(">", sign) + 1
                    continue
                close = page.find("-->", sign + 4)
                at = size if close < 0 else close + 3
            else:
                close = page.find(">", sign)
                at = size if close < 0 else close + 1
            continue
        ending = after == "/"
        found = _NAME.match(page, sign + 1 + ending)
        if not found:
            # Not a tag: the sign is text.
            add(page[at: sign + 1])
            at = sign + 1
            continue
        add(page[at:sign])
        name = found.group().lower()
        close = _tag_end(page, found.end())
        if close < 0:
            break
        attributes = page[found.end():close]
        at = close + 1
        if ending:
            if name in BLOCK:
                flush()
                if open_now[name]:
                    while True:
                        gone = stack.pop()[0]
                        open_now[gone] -= 1
                        if gone == name:
                            break
                if name == heading:
                    heading = ""
                if name == "li":
                    item = False
            elif name == "a":
                links = 0
            continue
        if name in OPAQUE:
            if name in ("svg", "textarea", "title"):
                parts.append(" ")
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else re.sub(r"[A-Z]", lambda x: x.group().lower(), page)
            close = lower.find(f"</{name}", at)
            end = -1 if close < 0 else page.find(">", close)
            at = size if end < 0 else end + 1
            continue
        if name == "a":
            links = 1
        elif name in SPACES:
            parts.append(" ")
        if name in BLOCK:
            flush()
            if name in HEADINGS:
                heading = name
            elif name == "li":
                item = True
            if name not in PLAIN:
                kind = SIBLINGS.get(name)
                while kind and SIBLINGS.get(stack[-1][0]) == kind:
                    open_now[stack.pop()[0]] -= 1
                top = stack[-1]
                mark = mark_of(name, attributes)
                if name == "header" and mark == -2 and top[2] > 0:
                    mark = 0
                stack.append((name, min(top[1], mark) if mark else top[1], mark or top[2]))
                open_now[name] += 1
            elif name == "p":
                heading = ""
    flush()
    return made


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block; zeros for neighbours beyond the ends."""
    x = np.zeros((len(found), len(FEATURES)))
    if not found:
        return x
    words = np.array([b.words for b in found], float)
    density = np.array([min(b.linked, b.words) for b in found], float) / np.maximum(words, 1)
    x[:, 0], x[:, 1] = words, density
    x[1:, 2], x[1:, 3] = words[:-1], density[:-1]
    x[:-1, 4], x[:-1, 5] = words[1:], density[1:]
    x[:, 6] = [b.inner for b in found]
    x[:, 7] = [b.least for b in found]
    x[:, 8] = [b.heading for b in found]
    x[:, 9] = [b.item for b in found]
    return x


class Tree:
    """A binary decision tree as arrays: feature (-1 at a leaf), threshold, child for up to it, child beyond, value."""

    def __init__(self, nodes: list[tuple[int, float, int, int, float]]):
        cols = list(zip(*nodes))
        self.feature, self.low, self.high = (np.array(cols[i], np.int64) for i in (0, 2, 3))
        self.threshold, self.value = np.array(cols[1], float), np.array(cols[4], float)

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            rows = np.flatnonzero(self.feature[at] >= 0)
            if not len(rows):
                return self.value[at] >= 0.5
            node = at[rows]
            at[rows] = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.low[node], self.high[node])


def _best_split(x: np.ndarray, y: np.ndarray) -> tuple[float, int, float] | None:
    """(Gini impurity after, feature, threshold) of the best cut, the first of equals."""
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        left, ones = np.arange(1, len(t)), np.cumsum(t)[:-1]
        right, rest = len(t) - left, t.sum() - ones
        impurity = 2 * (ones * (left - ones) / left + rest * (right - rest) / right)
        impurity[(v[1:] == v[:-1]) | (left < LEAST_LEAF) | (right < LEAST_LEAF)] = np.inf
        i = int(np.argmin(impurity)) if len(impurity) else -1
        if i >= 0 and np.isfinite(impurity[i]) and (best is None or impurity[i] < best[0] - 1e-9):
            best = (float(impurity[i]), f, float((v[i] + v[i + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Tree:
    nodes: list = []

    def make(rows: np.ndarray, left: int) -> int:
        me, share = len(nodes), float(y[rows].mean()) if len(rows) else 1.0
        nodes.append((-1, 0.0, me, me, share))
        cut = _best_split(x[rows], y[rows]) if left and 0 < share < 1 else None
        if cut:
            goes = x[rows, cut[1]] <= cut[2]
            nodes[me] = (cut[1], cut[2], make(rows[goes], left - 1), make(rows[~goes], left - 1), share)
        return me

    make(np.arange(len(y)), depth)
    return Tree(nodes)


def fit(labelled: DataFrame, limit: int = MAX_TRAINING_BLOCKS) -> Tree:
    """Tree from a table with the columns FEATURES and `kept` (0 or 1): at most `limit` rows, those of least hash."""
    rows = labelled.select(*[F.col(c).cast("double") for c in FEATURES], F.col("kept").cast("double")).dropna()
    got = rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(limit).toPandas().to_numpy(float).reshape(-1, len(FEATURES) + 1)
    return grow(got[:, :-1], got[:, -1])


def text_of(page: str, tree: Tree) -> str:
    found = blocks(page)
    keep = tree.predict(features(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, tree: Tree, html_col: str = "html") -> DataFrame:
    """pages without `html_col`, with `text` and `n_chars` of the article."""

    def make():
        def work(raw: list[bytes | None]) -> Iterator[list]:
            texts = [text_of(r.decode("utf-8", "replace"), tree) if r else "" for r in raw]
            return [texts, [len(t) for t in texts]]

        return work

    made = with_text(pages, html_col, [("text", STRING), ("n_chars", LONG)], make)
    return made.drop(html_col) if html_col.lower() not in ("text", "n_chars") else made
