"""Main text of web pages, block by block.

A page is cut into flat blocks of text at its block elements. A block is known by its own
words and share of linked words and by those of its neighbours, and by where it stands; a
decision tree that is trained on a small labelled table says which blocks are the article's.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.labelled_blocks import PAGES, SCALES
from newsprep.llm.shared import slices

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*)(?:>|\Z)"
    r"|<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre "
    "search section summary table caption tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of the page, and those that are left as they open.
UNSEEN = set("script style template noscript svg math iframe object canvas textarea title select datalist".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "blockquote", "pre", "dd", "figcaption"}
#: An element of a group ends the one before it.
GROUPS = [{"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, HEADINGS, {"option"}, {"thead", "tbody", "tfoot"}]
GROUP = {name: group for group in GROUPS for name in group}

ARTICLE, CHROME = {"article", "main"}, {"nav", "footer", "aside", "menu", "dialog", "search"}
CHROME_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Words in the names of elements that hold something else than the article.
OTHER = set(
    "ad ads adv advert adverts advertisement advertising alert author banner bio breadcrumb breadcrumbs byline comment "
    "commentlist comments consent cookie cookies copyright dateline disclaimer discussion disqus donate follow foot "
    "footer gdpr header hidden legal login masthead menu meta modal nav navbar navigation newsletter notice "
    "notification outbrain overlay pager pagination paywall popup promo promoted promotion recommended related "
    "replies reply respond rss share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "taboola tags teaser toolbar topbar trending warning widget widgets".split()
)
OWN = set("article articlebody content entry main post story text".split())
#: Words that headings of such sections, and such blocks, start or end with.
CUE = re.compile(
    r"(?:comments?|responses?|replies|related|read more|see also|more from|most read|recommended|you may also like|"
    r"share|follow us|newsletter|subscribe|advertisement|sponsored|cookies?|privacy|log in|sign up|tags)\W*$",
    re.IGNORECASE,
)

FEATURES = (
    "words", "linked", "words_before", "linked_before", "words_after", "linked_after", "place", "other", "own",
    "form", "heading", "paragraph", "cue", "under_cue", "sentence", "copyright",
)


class Block(NamedTuple):
    text: str
    start: int
    words: int
    linked: int
    tag: str
    #: 1 in an article, -1 in a menu, header, footer or the like, else 0.
    place: int
    other: bool
    own: bool
    form: bool


class _Open(NamedTuple):
    name: str
    place: int
    other: bool
    own: bool
    form: bool


def _opened(name: str, rest: str, within: _Open) -> _Open:
    """What holds inside an element, by its name, its own names, and what is around it."""
    place, other, own, form = within[1:]
    names, skip = [], False
    for value in (a or b or c for a, b, c in NAMES.findall(rest)) if "=" in rest else ():
        for part in PARTS.findall(value):
            part = part.lower()
            # "has-sidebar" or "no-comments" says how a page looks, not what an element is.
            if not skip:
                names.append(part)
            skip = part in ("has", "no", "with", "without")
    if name in ("body", "html"):
        return _Open(name, place, other, own, form)
    if name in ARTICLE or "main" in names and "role" in rest:
        place = 1
        names = [n for n in names if n in ("comment", "comments", "reply", "teaser", "related")]
    elif name in CHROME or name == "header" and place != 1 or name == "form" and place == 1 or not CHROME_ROLES.isdisjoint(names) and "role" in rest:
        place = -1
    other = other or not OTHER.isdisjoint(names)
    if " hidden" in rest and re.search(r"\shidden(?:[\s=/]|$)", rest):
        other = True
    own = (own or not OWN.isdisjoint(names)) and not other
    return _Open(name, place, other, own, form or name == "form")


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, references decoded and white space made single."""
    out: list[Block] = []
    stack, open_names = [_Open("", 0, False, False, False)], Counter()
    pieces: list[tuple[str, bool]] = []
    link_depth, start, at = 0, -1, 0

    def add(text: str, begin: int) -> None:
        nonlocal start
        if text:
            if start < 0 and not text.isspace():
                start = begin
            pieces.append((markup.unescape(text) if "&" in text else text, link_depth > 0))

    def flush() -> None:
        nonlocal start
        if start >= 0:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                linked = sum(len(p.split()) for p, is_linked in pieces if is_linked)
                top, words = stack[-1], text.count(" ") + 1
                out.append(Block(text, start, words, min(linked, words), top.name, *top[1:]))
        pieces.clear()
        start = -1

    def close(name: str) -> None:
        nonlocal link_depth
        while True:
            gone = stack.pop().name
            open_names[gone] -= 1
            if len(stack) < link_depth:
                link_depth = 0
            if gone == name:
                return

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:], at)
            break
        add(page[at : m.start()], at)
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in UNSEEN:
            if not m["end"] and not m["rest"].endswith("/"):
                closing = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else end
            continue
        if name in BLOCKS or "-" in name:
            flush()
            if m["end"]:
                if open_names[name]:
                    close(name)
                continue
            if stack[-1].name == "p":
                close("p")
            if stack[-1].name in GROUP.get(name, ()):
                close(stack[-1].name)
            stack.append(_opened(name, m["rest"], stack[-1]))
            open_names[name] += 1
        elif name in ("a", "button", "label"):
            link_depth = 0 if m["end"] else len(stack)
        elif name == "br":
            pieces.append((" ", False))
        elif name == "hr":
            flush()
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block of a page."""
    rows = np.zeros((len(found), len(FEATURES)))
    has_article = any(b.place == 1 and not b.other for b in found)
    under_cue = False
    for row, b in zip(rows, found):
        cue = b.words <= 8 and CUE.search(b.text) is not None
        if b.tag in HEADINGS:
            under_cue = cue
        place = -2 if b.place < 0 else 1 if b.place > 0 else -1 if has_article else 0
        row[:2] = b.words, b.linked / b.words
        row[6:] = (
            place, b.other, b.own, b.form, b.tag in HEADINGS, b.tag in PARAGRAPHS, cue, under_cue,
            b.text[-1] in ".!?…\"'”’»)", "©" in b.text,
        )
    rows[1:, 2:4] = rows[:-1, :2]
    rows[:-1, 4:6] = rows[1:, :2]
    return rows


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table's blocks."""
    xs, ys = [], []
    for page in PAGES:
        for scale in SCALES:
            def words(m, scale=scale):
                n = int(m[1])
                n = max(1, round(n * scale)) if n > 2 else n
                return " ".join(["word"] * n) + ("." if n > 5 else "")

            starts, labels, text = [], [], ""
            for line in page.strip().split("\n"):
                starts.append(len(text))
                labels.append(line[0])
                text += re.sub(r"\{(\d+)\}", words, line[1:])
            found = blocks(text)
            own = [labels[np.searchsorted(starts, b.start, side="right") - 1] for b in found]
            xs.append(features(found))
            ys += [label == "+" for label in own]
    return np.concatenate(xs), np.array(ys)


class Tree(NamedTuple):
    """A binary tree in arrays: go left where the feature is at most the limit."""

    feature: list
    limit: list
    left: list
    right: list
    share: list

    def says(self, row) -> bool:
        node = 0
        while self.feature[node] >= 0:
            node = (self.left if row[self.feature[node]] <= self.limit[node] else self.right)[node]
        return self.share[node] > 0.5


def train(x: np.ndarray, y: np.ndarray, *, depth: int = 10, least: int = 2) -> Tree:
    """Grow a tree by Gini impurity; ties go to the first feature and the lowest limit."""
    tree = Tree([], [], [], [], [])

    def grow(rows: np.ndarray, level: int) -> int:
        node = len(tree.feature)
        own = y[rows]
        for column, value in zip(tree, (-1, 0.0, -1, -1, float(own.mean()) if len(own) else 0.0)):
            column.append(value)
        best = (0.0, -1, 0.0)
        if level < depth and 0 < own.sum() < len(own):
            impurity = own.mean() * (1 - own.mean()) * len(own)
            for f in range(x.shape[1]):
                order = np.argsort(x[rows, f], kind="stable")
                values, hits = x[rows, f][order], np.cumsum(own[order])
                n = np.arange(1, len(own))
                left, right = hits[:-1], hits[-1] - hits[:-1]
                after = left * (1 - left / n) + right * (1 - right / (len(own) - n))
                after[(values[1:] == values[:-1]) | (n < least) | (len(own) - n < least)] = np.inf
                at = int(np.argmin(after))
                gain = impurity - after[at]
                if gain > best[0] + 1e-9:
                    best = (gain, f, (values[at] + values[at + 1]) / 2)
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            tree.feature[node], tree.limit[node] = best[1], best[2]
            tree.left[node] = grow(rows[low], level + 1)
            tree.right[node] = grow(rows[~low], level + 1)
        return node

    grow(np.arange(len(y)), 0)
    return tree


@lru_cache(1)
def trained() -> Tree:
    return train(*labelled())


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if tree.says(row))


def extract_main_text(
    df: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", tree: Tree | None = None
) -> DataFrame:
    """The article of every page: key, url, text and its length in code points.

    The tree is trained on the driver, on the labelled table of some hundred blocks (or is
    given); pages are narrow work in the scan's stage, one at a time. A null or empty page,
    or one without an article, has empty text. Every row gives one, repeated ones too; an
    empty table gives none, other columns are ignored.
    """
    tree = tree or trained()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 8_000_000):
            texts = [main_text(p, tree) if p else "" for p in (v.as_py() for v in batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["key", "url", "text", "n_chars"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    found = rows.mapInArrow(extract, f"key {kind}, url string, text string, n_chars bigint")
    return found.withColumnsRenamed({"key": key, "url": url})
