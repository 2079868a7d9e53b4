"""Main text of HTML pages: flat text blocks, classified by a small decision tree.

A page is cut into flat blocks of text at block-level tags. Each block has its number of words and its link density (share of its
words inside links), those of the block before and after it, its zone (inside an article element, inside
navigation and the like, or neither) and whether it is a heading. A decision tree grown on the labelled table ``LABELLED``
says which blocks are main text.

Defined results: null, empty and markup-only pages give ''. Broken markup never fails: an unclosed tag ends with the page,
a stray end tag closes nothing, an unterminated comment or script reaches to the end of the page.
"""

from __future__ import annotations

import html as entities
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How elements are treated.
DROPPED = ["script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "textarea", "select", "button"]
BOILER = ["nav", "header", "footer", "aside", "form", "menu", "dialog"]
CONTENT = ["article", "main"]
BLOCK = [
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
    "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
#: Elements that end an open element of the same kind without an end tag.
SELF_CLOSING = ["p", "li", "dt", "dd", "tr", "td", "th", "option"]
#: Words in class, id or role that mark boilerplate.
HINTS = [
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "menu", "nav", "navbar", "navigation", "newsletter",
    "notice", "popup", "promo", "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
]

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "zone", "heading"]
#: Labelled table: the FEATURES of a block (zone 1 article, 0 open, -1 boilerplate) and whether it is main text.
LABELLED = [
    (45, 0.0, 30, 0.0, 50, 0.0, 1, 0, 1), (3, 0.0, 40, 0.0, 35, 0.0, 1, 0, 1), (1, 0.0, 8, 0.0, 60, 0.0, 1, 0, 1),
    (8, 0.0, 6, 1.0, 40, 0.0, 1, 1, 1), (2, 0.0, 1, 1.0, 3, 0.0, 1, 1, 1), (120, 0.02, 8, 0.0, 1, 1.0, 1, 0, 1),
    (6, 1.0, 70, 0.0, 80, 0.0, 1, 0, 1), (12, 0.5, 20, 0.0, 15, 0.0, 1, 0, 1), (2, 0.0, 2, 0.0, 2, 0.0, 1, 0, 1),
    (18, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (1, 1.0, 2, 0.0, 1, 0.0, 1, 0, 1), (900, 0.0, 12, 0.0, 7, 0.3, 1, 0, 1),
    (4, 0.0, 40, 0.0, 1, 1.0, 1, 0, 1), (1, 0.0, 0, 0.0, 4, 1.0, 1, 1, 1), (4, 1.0, 1, 0.0, 12, 0.0, 1, 0, 1),
    (7, 0.0, 2, 1.0, 3, 1.0, 1, 0, 1), (3, 1.0, 5, 1.0, 2, 1.0, 1, 0, 1), (12, 0.1, 90, 0.0, 6, 1.0, 1, 0, 1),
    (2, 0.0, 30, 0.0, 0, 0.0, 1, 0, 1), (16, 0.0, 4, 0.9, 2, 0.7, 1, 0, 1), (5, 0.4, 1, 1.0, 60, 0.0, 1, 0, 1),
    (1, 0.0, 20, 0.0, 8, 1.0, 1, 1, 1), (9, 1.0, 3, 0.0, 3, 1.0, 1, 1, 1), (3, 0.0, 3, 1.0, 1, 1.0, 1, 0, 1),
    (6, 0.0, 2, 0.0, 2, 1.0, 1, 0, 1), (12, 0.9, 5, 1.0, 8, 0.7, 1, 0, 1), (2, 1.0, 2, 1.0, 3, 1.0, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, -1, 0, 0), (2, 1.0, 1, 1.0, 9, 0.0, -1, 0, 0), (9, 0.0, 1, 1.0, 7, 0.0, -1, 0, 0),
    (11, 0.0, 50, 0.0, 0, 0.0, -1, 0, 0), (60, 0.0, 45, 0.0, 30, 0.0, -1, 0, 0), (25, 0.1, 5, 0.0, 8, 0.0, -1, 0, 0),
    (4, 0.0, 60, 0.0, 40, 0.0, -1, 1, 0), (3, 0.0, 100, 0.0, 2, 0.0, -1, 0, 0), (140, 0.0, 20, 0.0, 18, 0.0, -1, 0, 0),
    (7, 0.0, 0, 0.0, 0, 0.0, -1, 0, 0), (15, 0.4, 3, 1.0, 6, 0.0, -1, 0, 0), (1, 0.0, 45, 0.0, 3, 1.0, -1, 0, 0),
    (55, 0.0, 40, 0.0, 62, 0.0, 0, 0, 1), (30, 0.05, 7, 0.0, 44, 0.0, 0, 0, 1), (24, 0.0, 90, 0.0, 3, 1.0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 48, 0.0, 0, 1, 1), (4, 0.0, 60, 0.0, 33, 0.0, 0, 1, 1), (9, 0.0, 52, 0.0, 41, 0.0, 0, 0, 1),
    (14, 0.0, 38, 0.0, 70, 0.1, 0, 0, 1), (80, 0.1, 0, 0.0, 0, 0.0, 0, 0, 1), (18, 0.0, 26, 0.0, 19, 0.0, 0, 0, 1),
    (200, 0.2, 3, 0.0, 4, 0.9, 0, 0, 1), (40, 0.0, 1, 1.0, 2, 1.0, 0, 0, 1), (22, 0.3, 35, 0.0, 28, 0.0, 0, 0, 1),
    (6, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (12, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (5, 0.0, 40, 0.0, 45, 0.0, 0, 0, 1),
    (8, 0.0, 30, 0.0, 1, 1.0, 0, 0, 1), (5, 0.0, 55, 0.0, 2, 1.0, 0, 0, 1), (2, 0.0, 0, 0.0, 40, 0.0, 0, 1, 1),
    (4, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
    (3, 0.0, 40, 0.0, 1, 1.0, 0, 0, 1), (4, 0.0, 28, 0.0, 3, 1.0, 0, 0, 1), (2, 0.0, 36, 0.0, 50, 0.0, 0, 0, 1),
    (3, 0.0, 60, 0.0, 25, 0.0, 0, 0, 1), (60, 0.0, 1, 1.0, 1, 1.0, 0, 0, 1), (30, 0.0, 2, 1.0, 3, 1.0, 0, 0, 1),
    (25, 0.0, 4, 1.0, 2, 1.0, 0, 0, 1), (110, 0.05, 3, 1.0, 1, 1.0, 0, 0, 1), (5, 0.0, 4, 1.0, 2, 1.0, 0, 0, 0),
    (3, 0.0, 5, 0.0, 40, 0.0, 0, 1, 1), (6, 0.0, 10, 0.0, 30, 0.0, 0, 1, 1),
    (5, 0.0, 80, 0.0, 50, 0.0, 0, 0, 1), (3, 0.0, 100, 0.0, 20, 0.0, 0, 0, 1), (6, 0.0, 120, 0.0, 1, 1.0, 0, 0, 1),
    (7, 0.0, 150, 0.0, 8, 0.0, 0, 0, 1), (3, 0.0, 70, 0.0, 2, 1.0, 0, 0, 1), (4, 0.0, 110, 0.0, 0, 0.0, 0, 0, 0),
    (1, 0.0, 1, 1.0, 40, 0.0, 0, 1, 1), (2, 0.0, 3, 1.0, 30, 0.0, 0, 1, 1), (4, 0.0, 2, 1.0, 60, 0.0, 0, 1, 1),
    (3, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0), (5, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0), (3, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0),
    (2, 1.0, 50, 0.0, 2, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0), (1, 1.0, 40, 0.0, 1, 1.0, 0, 0, 0),
    (3, 0.0, 6, 1.0, 5, 1.0, 0, 0, 0), (8, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), (4, 1.0, 60, 0.0, 3, 1.0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0), (5, 1.0, 4, 0.8, 6, 1.0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0), (6, 0.0, 3, 0.0, 2, 1.0, 0, 0, 0), (12, 0.9, 5, 1.0, 8, 0.7, 0, 0, 0),
    (4, 0.0, 70, 0.0, 0, 0.0, 0, 0, 0), (30, 0.8, 3, 1.0, 5, 0.9, 0, 0, 0), (2, 0.0, 1, 0.0, 2, 0.0, 0, 0, 0),
    (7, 0.6, 40, 0.0, 2, 1.0, 0, 0, 0), (1, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0), (50, 0.9, 2, 1.0, 2, 1.0, 0, 0, 0),
]
# what is no text in the open is text inside an article, and what is text in the open is none inside boilerplate
LABELLED += [(*row[:6], 1, row[7], 1) for row in LABELLED if row[6] == 0 and not row[8]]
LABELLED += [(*row[:6], -1, row[7], 0) for row in LABELLED if row[6] == 0 and row[8]]

_MARKUP = regex.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)", regex.DOTALL)
_HINT = regex.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", regex.IGNORECASE)
_HIDDEN = regex.compile(r"\shidden(?:[\s=/]|\Z)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", regex.IGNORECASE)
_PART = regex.compile(r"[^a-z]+")


@dataclass
class Block:
    text: str
    words: int
    links: float
    zone: int
    heading: int


def _marked(attributes: str) -> bool:
    for m in _HINT.finditer(attributes):
        if not _HINT_WORDS.isdisjoint(_PART.split((m[1] or m[2] or m[3] or "").lower())):
            return True
    return False


_HINT_WORDS = frozenset(HINTS)
_DROPPED, _BOILER, _CONTENT, _BLOCK, _VOID, _SELF = map(frozenset, (DROPPED, BOILER, CONTENT, BLOCK, VOID, SELF_CLOSING))


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page in order. Text of dropped elements is left out."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, int]] = []  # name, drops, is boilerplate, is content, change of the depth in hints
    parts: list[tuple[str, bool]] = []
    depth = {"drop": 0, "boiler": 0, "hint": 0, "content": 0, "link": 0, "heading": 0}

    def flush() -> None:
        if not parts:
            return
        text = " ".join(entities.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = sum(len(t.split()) for t, in_link in parts if in_link)
            n = len(text.split())
            zone = -1 if depth["boiler"] or depth["hint"] else 1 if depth["content"] else 0
            out.append(Block(text, n, min(1.0, linked / n), zone, int(depth["heading"] > 0)))
        parts.clear()

    def enter(name: str, attributes: str, sign: int, entry: tuple[str, bool, bool, bool, int]) -> None:
        _, drops, boiler, content, hint = entry
        depth["drop"] += sign * drops
        depth["boiler"] += sign * boiler
        depth["content"] += sign * content
        depth["hint"] += sign * hint
        depth["link"] += sign * (name == "a")
        depth["heading"] += sign * (len(name) == 2 and name[0] == "h" and name[1].isdigit())

    def leave() -> None:
        entry = stack.pop()
        if entry[0] in _BLOCK:
            flush()
        enter(entry[0], "", -1, entry)

    page = page or ""
    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text and not depth["drop"]:
            parts.append((text, depth["link"] > 0))
        if not m:
            break
        at = max(m.end(), at + 1)
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if any(name == e[0] for e in stack):
                while stack[-1][0] != name:
                    leave()
                leave()
            elif name in _BLOCK:
                flush()
            continue
        if name in _VOID:
            if name in _BLOCK:
                flush()
            elif name == "br" and not depth["drop"]:
                parts.append((" ", False))
            continue
        if name in _SELF:
            opened = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name or stack[i][0] in _STOPS), None)
            if opened is not None and stack[opened][0] == name:
                while len(stack) > opened:
                    leave()
        if name in ("script", "style") and not m[3].endswith("/"):
            end = regex.compile(rf"</{name}\s*>", regex.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _BLOCK:
            flush()
        if m[3].endswith("/") and name not in _BLOCK:
            continue
        inside = any(e[0] in _CONTENT for e in stack)
        # a header inside an article belongs to it; outside it is the page's
        boiler = (name in _BOILER and not (name == "header" and inside)) or bool(_HIDDEN.search(m[3]))
        hint = int(_marked(m[3]))
        if name in ("html", "body"):
            boiler, hint = False, 0
        elif name in _CONTENT:
            # hints of page wrappers end at the outermost article or main; inside it they mark comments and the like again
            hint = 0 if inside else -depth["hint"]
        entry = (name, name in _DROPPED, boiler, name in _CONTENT, hint)
        stack.append(entry)
        enter(name, m[3], 1, entry)
    flush()
    return out


_STOPS = frozenset(["ul", "ol", "dl", "table", "div", "section", "article", "body", "td", "th", "blockquote", "main", "aside", "nav", "footer", "header"])


def vectors(found: list[Block]) -> np.ndarray:
    """FEATURES of the blocks of one page."""
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.links for b in found), 0], float)
    own = np.array([(b.zone, b.heading) for b in found], float).reshape(-1, 2)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], own])


@dataclass
class Tree:
    """Binary decision tree as arrays; a leaf has feature -1."""

    feature: list[int]
    cut: list[float]
    below: list[int]
    above: list[int]
    answer: list[int]

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut = np.array(self.feature), np.array(self.cut)
        below, above, answer = np.array(self.below), np.array(self.above), np.array(self.answer)
        node = np.zeros(len(x), int)
        while (feature[node] >= 0).any():
            f = feature[node]
            low = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[node]
            node = np.where(f < 0, node, np.where(low, below[node], above[node]))
        return answer[node]


def grow_tree(rows: list[tuple], depth: int = 9) -> Tree:
    """Decision tree by Gini impurity over labelled rows (features..., label)."""
    data = np.array(rows, float)
    tree = Tree([], [], [], [], [])

    def impurity(y: np.ndarray) -> float:
        return 2 * len(y) * y.mean() * (1 - y.mean()) if len(y) else 0.0

    def grow(part: np.ndarray, left: int) -> int:
        x, y = part[:, :-1], part[:, -1]
        node = len(tree.feature)
        for values, value in ((tree.feature, -1), (tree.cut, 0.0), (tree.below, -1), (tree.above, -1), (tree.answer, int(y.mean() >= 0.5))):
            values.append(value)
        best = (impurity(y) - 1e-9, -1, 0.0)
        if left and impurity(y) > 0:
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    low = x[:, f] <= cut
                    best = min(best, (impurity(y[low]) + impurity(y[~low]), f, float(cut)))
        if best[1] >= 0:
            low = x[:, best[1]] <= best[2]
            tree.feature[node], tree.cut[node] = best[1], best[2]
            tree.below[node] = grow(part[low], left - 1)
            tree.above[node] = grow(part[~low], left - 1)
        return node

    grow(data, depth)
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree.predict(vectors(found))) if keep)


def extract(pages: DataFrame, labelled: list[tuple] = LABELLED, html: str = "html", out: str = "text") -> DataFrame:
    """Append the main text of ``html``. A column named ``out`` is replaced."""
    kept = [c for c in pages.columns if c != out]
    at = kept.index(html)
    tree = grow_tree(labelled)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [main_text(p, tree) for p in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*kept, out])

    source = pages.select(*kept)
    return source.mapInArrow(run, source.withColumn(out, F.lit("")).schema)
