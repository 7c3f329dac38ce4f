"""The main text of web pages: flat text blocks, judged by a decision tree on word counts and link densities of neighbours.

A page is cut into blocks, the runs of text between block-level tags. A block is described by the words and link density of
itself, its predecessor and its successor, by where it stands (in an article, in a container named like content, in
something that is never content) and by its kind. A small tree, fitted on the labelled blocks below when a query is
planned, says which blocks stay. Pages are judged one by one in the tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""
    <!--(?:-?>|.*?(?:--!?>|\Z))
  | <(?P<raw>script|style|title|textarea|iframe|noembed|noframes|xmp)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
  | <(?P<skip>noscript|template|svg|math|select|button|object|audio|video|canvas|datalist)(?=[\s/>])[^>]*>.*?</(?P=skip)\s*>
  | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:[^'"<>]|"[^"]*"|'[^']*')*+)>
  | </?[a-zA-Z](?P<broken>[^<>]*)>?
  | <[!?/][^>]*>?
""", re.S | re.I | re.X)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOP = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:\s|$)")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_BLOCKS = _HEADINGS | set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header "
    "hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements that end when another begins, where they are innermost.
_CLOSES = {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"},
           "tr": {"p", "td", "th", "tr"}, **dict.fromkeys(("thead", "tbody", "tfoot"), {"p", "td", "th", "tr", "thead", "tbody", "tfoot"})}
# What stands around a block. Marks of class names end at an article (WEAK) or hold for all within (STRONG).
MAIN, HINT, CHROME, WEAK, STRONG, FORM, ARTICLE = 1, 2, 4, 8, 16, 32, 64
_ROLES = {"main": MAIN, "article": MAIN, **dict.fromkeys(
    ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar"), CHROME)}
_STRONG = re.compile(r"ads?|ad(?:box|slot|unit|sense|container|wrapper)|advert\w*|sponsor\w*|promos?|promotion\w*|comments?|commentlist|disqus|repl(?:y|ies)|"
                     r"respond|related|recommend\w*|teasers?|newsletter|subscribe\w*|cookies?|consent|gdpr|notices?|alerts?|popup|modal|paywall|share|sharing|social")
_WEAK = re.compile(r"banner|breadcrumbs?|overlay|login|signup|menus?|nav|navbar|navigation|sidebar|rail|aside|widgets?|footer|header|masthead|topbar|toolbar|"
                   r"pagination|pager|trending|popular|tags|tagcloud|skip|copyright|legal|search|outbrain|taboola")
_GOOD = {"article", "content", "entry", "post", "story", "body", "text", "prose", "main"}


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    around: int
    tag: str
    attrs: str


def marks(attrs: str) -> int:
    """What the attributes of an element say of the text in it."""
    found = 0
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            for part in value.split():
                names = [n.lower() for n in _NAME.findall(part)]
                names = [n for i, n in enumerate(names) if not i or names[i - 1] not in ("with", "has", "no")]
                good = _GOOD & set(names)
                if any(_STRONG.fullmatch(n) for n in names):
                    found |= STRONG
                elif any(_WEAK.fullmatch(n) for n in names) and not ("header" in names and good - {"main", "body", "text"}):
                    found |= WEAK
                elif good:
                    found |= HINT
        elif name == "role":
            found |= _ROLES.get(value.lower(), 0)
        elif name == "itemprop" and value.lower() == "articlebody":
            found |= MAIN
        elif name == "hidden" or (name, value.lower()) == ("aria-hidden", "true") or name == "style" and "display:none" in value.replace(" ", "").lower():
            found |= STRONG
    return found


def around(parent: int, tag: str, attrs: str) -> int:
    """The flags within an element, from those around it."""
    own = marks(attrs) if attrs and tag not in ("html", "body") else 0
    flags = parent | own
    if tag in ("nav", "aside", "footer", "menu", "dialog", "search") or tag == "header" and not parent & MAIN:
        flags |= CHROME
    elif tag in ("form", "fieldset"):
        flags |= FORM
    elif tag in ("article", "main") or own & MAIN:
        if not parent & MAIN:
            flags &= ~(WEAK | FORM) | own
        if tag == "article" and parent & ARTICLE:  # an article in an article is a comment or a teaser
            flags |= STRONG
        flags |= MAIN | (ARTICLE if tag == "article" else 0)
    return flags


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Scripts, styles, form controls and comments in the markup hold no text."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, str]] = [("", 0, "")]
    open_tags: Counter[str] = Counter()
    link, place = -1, 0  # depth of the stack at which the open link began

    def flush() -> None:
        words = "".join(text).split()
        if words:
            tag, flags, attrs = stack[-1]
            out.append(Block(" ".join(words), len(words), len("".join(linked).split()), flags, tag, attrs))
        text.clear()
        linked.clear()

    def add(piece: str) -> None:
        text.append(piece)
        linked.append(piece if link >= 0 else " ")

    def pop() -> None:
        nonlocal link
        open_tags[stack.pop()[0]] -= 1
        if len(stack) <= link:
            link = -1

    for token in _TOKEN.finditer(page):
        if token.start() > place:
            piece = page[place:token.start()]
            add(unescape(piece) if "&" in piece else piece)
        place = token.end()
        tag = token["tag"]
        if tag is None:
            if token["broken"] is None:
                continue
            tag = re.match(r"[a-zA-Z0-9]*", token[0].lstrip("</"))[0]
        tag, attrs, end = tag.lower(), token["attrs"] or "", token[0].startswith("</")
        if tag == "a":
            link = -1 if end else len(stack) if "href" in attrs else link
        elif tag in ("br", "wbr"):
            add(" " if tag == "br" else "")
        elif tag in _BLOCKS:
            flush()
            if not end:
                closes = _CLOSES.get(tag, {"p"})
                while stack[-1][0] in closes:
                    pop()
                if tag != "hr":
                    stack.append((tag, around(stack[-1][1], tag, attrs), attrs))
                    open_tags[tag] += 1
            elif tag not in ("body", "html") and open_tags[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
    if place < len(page):
        piece = page[place:]
        add(unescape(piece) if "&" in piece else piece)
    flush()
    return out


COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "outside", "inside", "best", "page", "heading", "item", "sentence")


def described(found: list[Block]) -> np.ndarray:
    """One row of COLUMNS per block of a page."""
    n = len(found)
    out = np.zeros((n, len(COLUMNS)))
    if not n:
        return out
    words = np.array([b.words for b in found], float)
    links = np.array([b.linked for b in found]) / words
    flags = np.array([b.around for b in found])
    outside = (flags & (CHROME | WEAK | STRONG | FORM)) != 0
    inside = np.where(flags & MAIN, 2, np.where(flags & HINT, 1, 0))
    page = inside[~outside].max() if (~outside).any() else 0
    out[:, 0], out[:, 1] = words, links
    out[1:, 2], out[1:, 3], out[:-1, 4], out[:-1, 5] = words[:-1], links[:-1], words[1:], links[1:]
    out[:, 6], out[:, 7], out[:, 8], out[:, 9] = outside, inside, inside >= page, page
    out[:, 10] = [b.tag in _HEADINGS for b in found]
    out[:, 11] = [b.tag in ("li", "dt", "dd", "td", "th") for b in found]
    out[:, 12] = [_STOP.search(b.text) is not None for b in found]
    return out


# The labelled table: pages in which `{n}` stands for n words and `{n.}` for a sentence of them; blocks marked `k` are main text.
_MENU = "<ul><li><a href=x>{1}</a><li><a href=x>{2}</a><li><a href=x>{1}</a></ul>"
LABELLED = [
    "<nav>" + _MENU + "</nav><div class=ad>{8.}</div><article><h1 k>{9}</h1><p k>{30.}<p k>{2.}</p><p k>{1}</p><p k>{55.}</article><footer>{9.}</footer>",
    "<header><p>{3}</p>" + _MENU + "</header><main><h1 k>{6}</h1><p k>{18.} <a href=x>{3}</a> {9.}</p><h2 k>{3}</h2><ul><li k>{4}<li k>{11.}<li k>{2}</ul>"
    "<blockquote k>{20.}</blockquote><p k>{5.}</p></main><aside><h3>{2}</h3><p>{25.}</p></aside><footer><p>{20.}</p></footer>",
    "<div id=top>{3}</div><div class=menu>" + _MENU + "</div><div class=content><h1 k>{5}</h1><p k>{60.}</p><p k>{3.}</p><p k>{24.}</p></div>"
    "<div class=sidebar><p>{30.}</p></div><div>{6} <a href=x>{3}</a></div>",
    "<table><tr><td>" + _MENU + "<td><h1 k>{6}</h1><p k>{45.}</p><p k>{12.}</p><p k>{33.}</p></table><p><a href=x>{2}</a> <a href=x>{2}</a> {2}</p>",
    "<div><a href=x>{2}</a> <a href=x>{1}</a> <a href=x>{2}</a></div><div><h1 k>{7}</h1><div k>{80.}</div><div k>{25.}</div><div k>{40.}</div></div>"
    "<div><a href=x>{4}</a></div><div><a href=x>{6}</a></div><div>{4}</div>",
    "<div>{2}</div>" + _MENU + "<h2 k>{8}</h2><p k>{35.}</p><p k>{9.}</p><p k>{28.}</p><p>{3} <a href=x>{4}</a> {1}</p>",
    "<article><header><h1 k>{8}</h1></header><p k>{40.}</p><p class=notice>{14.}</p><p k>{22.}</p><table><tr><td k>{2}<td k>{3}<tr><td k>{1}<td k>{2}</table>"
    "<section class=comments><h2>{1}</h2><p>{35.}</p><p>{4.}</p></section></article><div><p>{20.}</p></div>",
    "<div class=cookie-banner>{30.}</div><form><p>{8.}</p><label>{2}</label></form><div class=post><p k>{15.}</p><p k>{4.}</p><p k>{62.}</p>"
    "<ul><li k>{7}<li k>{9}</ul></div><div class=comment><p>{28.}</p></div><div>{25.}</div><p>{12.}</p>",
    "<main><p k>{3}</p><p k>{26.}</p><pre k>{12}</pre><p k><a href=x>{5}</a></p><p k>{17.}</p></main><p>{16.}</p><section><h2>{3}</h2><p>{40.}</p></section>",
    "<p k>{50.}</p><p k>{20.}</p><p k>{6.}</p><p k>{38.}</p>",
    "<article><p k>{7}</p></article><footer>{12.}</footer>",
    "<div><a href=x>{3}</a></div><div><p><a href=x>{9}</a></p><p><a href=x>{12}</a></p><p><a href=x>{8}</a></p></div><div>{3}</div>",
    "<article><h2 k>{4}</h2><p k>{11.}</p></article><article><h2 k>{5}</h2><p k>{14.}</p></article><section><p>{18.}</p></section><div>{9.}</div>",
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """(described blocks, labels) of the labelled pages at three scales of length."""
    def filled(page: str, scale: float) -> str:
        return re.sub(r"\{(\d+)(\.?)\}", lambda m: " ".join(["word"] * max(1, round(int(m[1]) * scale))) + m[2], page)

    found = [blocks(filled(page, scale)) for scale in (0.6, 1.0, 2.0) for page in LABELLED]
    return np.concatenate([described(f) for f in found]), np.array([b.attrs.split()[-1:] == ["k"] for f in found for b in f])


def fit(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 3):
    """A binary tree of (column, cut, low branch, high branch) by Gini impurity; leaves are the share of true labels."""
    share = float(y.mean())
    best, gain = None, 1e-9
    if depth and 0 < share < 1:
        for column in range(x.shape[1]):
            order = np.argsort(x[:, column], kind="stable")
            v, hits = x[order, column], np.cumsum(y[order])
            n = np.arange(1, len(y))
            p, q = hits[:-1] / n, (hits[-1] - hits[:-1]) / (len(y) - n)
            fall = share * (1 - share) - (n * p * (1 - p) + (len(y) - n) * q * (1 - q)) / len(y)
            fall[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = 0
            i = int(fall.argmax())
            if fall[i] > gain:
                best, gain = (column, (v[i] + v[i + 1]) / 2), fall[i]
    if best is None:
        return share
    low = x[:, best[0]] < best[1]
    return (*best, fit(x[low], y[low], depth - 1, least), fit(x[~low], y[~low], depth - 1, least))


def judge(tree, x: np.ndarray) -> np.ndarray:
    """The share of true labels in the leaf that each row falls into."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    column, cut, below, above = tree
    low = x[:, column] < cut
    out = np.empty(len(x))
    out[low], out[~low] = judge(below, x[low]), judge(above, x[~low])
    return out


def main_text(pages: DataFrame, tree=None, html_col: str = "html") -> DataFrame:
    """`pages` without `html_col` and with `text`, `n_chars` (code points), `n_blocks` and `n_main`, one row per row.

    The main blocks of the whole page, one space for white space within a block (a no-break space and a line break count),
    joined by a line break. Null and empty pages, and pages without a main block, have an empty text. Rows are judged one
    by one: repeated rows get equal texts; columns of `pages` that clash with the new ones are replaced.
    """
    tree = fit(*labelled_table()) if tree is None else tree
    added = [("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_main", pa.int64())]
    rest = [c for c in pages.columns if c != html_col and c not in dict(added)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0):
                found = blocks(value.as_py() or "")
                kept = judge(tree, described(found)) >= 0.5
                text = "\n".join(b.text for b, k in zip(found, kept) if k)
                rows.append((text, len(text), len(found), int(kept.sum())))
            new = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], names=[*batch.schema.names[1:], *dict(added)])

    slim = pages.select(F.col(html_col), *rest)
    kinds = slim.select(*rest).withColumns({n: F.lit(None).cast("string" if n == "text" else "long") for n, _ in added}).schema
    return slim.mapInArrow(extract, kinds)
