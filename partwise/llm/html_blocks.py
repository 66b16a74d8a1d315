"""HTML text extraction: flat text blocks classified by a decision tree.

A page is read once, front to back, into flat blocks: stretches of text between
block-level tags. Each block is described by its own words and link density,
those of the blocks before and after, its kind (heading, list item, sentence)
and what its open containers are called. A decision tree, grown on the labelled
table in ``html_labels``, tells the blocks of the article from the rest; they
are joined by newlines.

Scripts, styles, comments, form controls and the like are no blocks. Character
references are decoded and white space becomes one space after the cut into
blocks, so decoded '<' is text. Unclosed tags are tolerated: an end tag closes
the nearest open container of its name, if there is one.

Cases: NULL and empty html give empty text, as do pages without an article. A
page cut off inside a tag loses that tag only. Rows sharing a page_id are read
one by one. An empty table gives no rows. Extra columns are ignored. A page is
held whole in its task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import column
from partwise.llm.html_labels import PAGES

# FIXED VALUES: HTML's element kinds, and words in class or id that tell what a container holds.
RAW = "script style textarea title iframe".split()
BOXES = "noscript template svg select button datalist canvas audio video".split()
CONTAINERS = "article aside body details dialog div dl fieldset figure footer form header html main menu nav ol section table tbody td tr ul".split()
BLOCKS = CONTAINERS + "address blockquote caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hr label legend li option p pre summary th thead tfoot".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
OUTSIDE_TAGS = "nav footer aside form menu header dialog".split()
INSIDE_TAGS = "article main".split()
OUTSIDE_WORDS = """ad ads advert advertisement adverts alert announcement aside banner breadcrumb breadcrumbs byline comment commenter comments complementary consent
contentinfo cookie cookies copyright dialog
disclaimer discussion disqus feedback footer form gdpr header login masthead menu meta modal nav navbar navigation newsletter notice notification pager pagination popup promo
promoted promotion recommended register related replies reply respond reviews search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar
widget widgets""".split()  # fmt: skip
INSIDE_WORDS = "article body content entry main post story text".split()
#: First or last words of a name that say what a thing is about, or lacks, and not what it is (category-reviews, notice-free).
ABOUT = "category cat tag topic subject has no not without".split()
LACKING = "free less".split()
#: Words of names made of a heading (comments-on-law).
JOINING = "a about an and as at by for from how in is of on or the to what why with".split()

_ATTRIBUTES = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
#: Comments; raw text, which runs to its end tag or the end of the page; boxes, which need their end tag; tags; broken tags.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<box>{'|'.join(BOXES)})\b{_ATTRIBUTES}(?<!/)>.*?</(?P=box)\s*>"
    rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9]*)(?P<rest>{_ATTRIBUTES})>|<[/!?a-z][^<>]*(?:>|\Z)",
    re.I | re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SPACE = re.compile(r"\s+")
_SETS = {k: frozenset(v) for k, v in dict(containers=CONTAINERS, blocks=BLOCKS, headings=HEADINGS, out_tags=OUTSIDE_TAGS, in_tags=INSIDE_TAGS, out_words=OUTSIDE_WORDS, in_words=INSIDE_WORDS, about=ABOUT, lacking=LACKING, joining=JOINING).items()}

#: Words counted of a block or its neighbour; more tell nothing more.
_FEW = 40


def _names(rest: str) -> list[list[str]]:
    """The words of each name in an element's class, id and role; camelCase counts as several."""
    found = _NAMED.findall(rest) if rest else ()
    return [[w.lower() for w in _WORD.findall(name)] for value in found for name in value.split()]


def _named(rest: str, article: bool = False) -> int:
    """What the names of an element say: -1 outside the article, 1 inside, 0 nothing.

    A name that tells what a thing is about says nothing, nor does one made of a heading. An article or main
    element is outside only if a whole name says so, and no other that it is the article.
    """
    outside = inside = False
    for words in _names(rest):
        if not words or len(words) > 1 and (words[0] in _SETS["about"] or words[-1] in _SETS["lacking"]):
            continue
        if len(words) > 2 and any(w in _SETS["joining"] for w in words[1:-1]):
            continue
        if not article or len(words) == 1:
            outside |= any(w in _SETS["out_words"] for w in words)
        inside |= any(w in _SETS["in_words"] for w in words)
    if article and inside:
        return 1
    return -1 if outside else int(inside)


class _Context:
    """Open containers, and what their names say."""

    def __init__(self):
        self.open: list[tuple[str, int, int]] = []  # tag, hint of the tag, hint of class and id

    def begin(self, tag: str, rest: str) -> None:
        by_tag = -1 if tag in _SETS["out_tags"] else 1 if tag in _SETS["in_tags"] else 0
        if tag == "header" and any(t > 0 for _, t, _ in self.open):
            by_tag = 0  # an article's own header, not the page's
        # Names on the page's own frame ("with-sidebar") say nothing of the text in it.
        by_name = 0 if tag in ("html", "body", "main") else _named(rest, tag == "article")
        self.open.append((tag, by_tag, by_name))

    def end(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def hints(self) -> tuple[int, int, int, int]:
        """Innermost hint; outside tag, outside name and inside container anywhere."""
        inner = 0
        for _, by_tag, by_name in reversed(self.open):
            inner = by_name if by_name < 0 else by_tag or by_name
            if inner:
                break
        return inner, int(any(t < 0 for _, t, _ in self.open)), int(any(n < 0 for *_, n in self.open)), int(any(t > 0 or n > 0 for _, t, n in self.open))


def blocks(page: str) -> list[tuple[str, int, str, tuple]]:
    """(text, words in links, tag, hints) of each block of a page, in order."""
    out, parts, linked = [], [], []
    context, tag, in_link, at, begun = _Context(), "", False, 0, None

    def close():
        nonlocal begun
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((text, sum(len(html.unescape(x).split()) for x in linked), tag, begun))
        parts.clear()
        linked.clear()
        begun = None

    def add(text: str):
        nonlocal begun
        if begun is None and text.strip():
            begun = context.hints()
        parts.append(text)
        if in_link:
            linked.append(text)

    # The head is no text; a page may do without its tags.
    head = re.match(r"(?:(?!<body|</head).)*?<head\b.*?(?=</head\s*>|<body\b|\Z)", page, re.I | re.S) if "<head" in page.lower() else None
    at = head.end() if head else 0
    for m in _TOKEN.finditer(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m["tag"] or "").lower()
        if not name:
            continue
        if name == "a":
            in_link = not m["end"]
        elif name in ("br", "wbr"):
            parts.append(" " if name == "br" else "")
        elif name in _SETS["blocks"]:
            close()
            if m["end"]:
                if name in _SETS["containers"]:
                    context.end(name)
                tag = ""
            else:
                in_link = False
                if name in _SETS["containers"]:
                    context.begin(name, m["rest"])
                elif m["rest"] and _named(m["rest"]) < 0:
                    tag = "-" + name
                    continue
                tag = name
    if at < len(page):
        add(page[at:])
    close()
    return out


def features(found: list[tuple]) -> np.ndarray:
    """One row per block: words and link density of it and its neighbours, its kind, its containers."""
    n = len(found)
    words = np.array([min(_FEW, len(b[0].split())) for b in found], float)
    density = np.array([min(1.0, b[1] / max(1, len(b[0].split()))) for b in found], float)
    before, after = (lambda x: np.concatenate(([0], x[:-1]))), (lambda x: np.concatenate((x[1:], [0])))
    kind = [b[2].lstrip("-") for b in found]
    hints = np.array([b[3] for b in found], float).reshape(n, 4)
    return np.column_stack([
        words, density, before(words), before(density), after(words), after(density),
        [k in _SETS["headings"] for k in kind], [k in ("li", "td", "th", "dt", "dd") for k in kind], [b[0][-1:] in ".!?:;\"'”»…" for b in found],
        hints, [b[2][:1] == "-" for b in found],
    ]).astype(float)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """A binary decision tree by Gini impurity: (feature, threshold, lower, upper) or the share of label 1."""
    if depth == 0 or len(set(y.tolist())) == 1:
        return (float(y.mean()),)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] < cut
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut))
    if best is None:
        return (float(y.mean()),)
    low = x[:, best[1]] < best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] >= 0.5)
    low = x[:, tree[0]] < tree[1]
    out = np.zeros(len(x), bool)
    out[low] = classify(tree[2], x[low])
    out[~low] = classify(tree[3], x[~low])
    return out


def labelled(pages: list[str] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of marked pages."""
    xs, ys = [], []
    for page in pages:
        marked = blocks(page)
        plain = [(text[2:], links, tag, hints) for text, links, tag, hints in marked]
        xs.append(features(plain))
        ys.append(np.array([text[0] == "+" for text, *_ in marked], float))
    return np.concatenate(xs), np.concatenate(ys)


def article(page: str, tree: tuple) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b[0] for b, keep in zip(found, classify(tree, features(found))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    tree = grow(*labelled())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [article(p.as_py() or "", tree) for p in column(batch, "html")]
            yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
