"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events; every block element becomes a
line with its text length and the number of tags in it, its own included. The ratios are
smoothed with a Gaussian and a threshold clusters lines into content and
boilerplate. Elements that are never article text (menus, scripts ...) are left
out while parsing. Where a page marks its article, the content regions are those
inside it, unless the regions outside hold more text: then the ratio alone decides.

Blocks whose class, id or role marks them as boilerplate are left out too, and
forms and page headers. A mark is a whole name (``sidebar``), one that ends in it
(``site-footer``) or begins with it before a word for a container
(``comment-list``); ``has-sidebar``, ``no-comments`` or ``social-science`` are none.
Such a block stays if it holds the page's ``main``, or more than half of the
page's text while no article is marked outside; comments never do. If nothing
else is left of a page, its marked blocks stay.

Defined cases: null or empty html gives an empty text; a page cut off in a tag
loses that tag only; extra columns are kept out; rows are independent, so
repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav
    ol p pre section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"html", "body"}
NEVER = frozenset("""aside button canvas dialog footer head iframe input menu nav noscript object
    option script select style svg template textarea title video audio""".split())
ARTICLE = frozenset(["article", "main"])
# Words of class, id and role attributes that mark what is not article text (a choice, not a standard).
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs
    comment comments cookie cookies consent disqus footer masthead menu modal nav navbar navigation
    newsletter notice notices popup promo promoted related respond replies share sharing sidebar
    social sponsor sponsored subscribe toolbar widget""".split())
COMMENTS = frozenset("comment comments disqus respond replies".split())
HEADS = frozenset(["header", "masthead"])
# Words that make a mark out of a name that begins with one, and words that turn a name's mark down.
HOLDERS = frozenset("""area articles bar block body box button buttons container content feed form group icons
    inner item items left links list main menu outer panel posts right row section slot stories thread top unit
    widget wrap wrapper""".split())
DENIALS = frozenset("has have no non not with without".split())
# A line of at least so many tags and a quarter of the limit is a list of links.
LIST_TAGS = 8
_WORD = re.compile(r"[a-z]+")
_OPEN_TAG = re.compile(r"<[/!?a-zA-Z]")


def marks_in(names: str, marks: frozenset[str]) -> set[str]:
    """The marks that the names of a class, id or role attribute carry."""
    found = set()
    for name in names.lower().split():
        words = _WORD.findall(name)
        if not words or DENIALS.intersection(words):
            continue
        if words[-1] in marks:
            found.add(words[-1])
        elif words[0] in marks and HOLDERS.issuperset(words[1:]):
            found.add(words[0])
    return found


class _Lines(HTMLParser):
    """Collects (text, tags, in article, open marks) for each block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Open elements: name, does it hide its content, number of its mark.
        self.stack: list[tuple[str, bool, int | None]] = []
        self.open: Counter[str] = Counter()
        self.hidden = self.inside = 0
        self.lines: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.marked: list[int] = []  # open marks
        self.comments: list[bool] = []  # of each mark: are these comments
        self.mains: set[int] = set()  # marks around a main element
        self.articles: list[tuple[int, ...]] = []  # marks around each article

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(1, self.tags), self.inside > 0, tuple(self.marked)))
        self.tags = 0
        self.parts.clear()

    def kind(self, tag: str, attrs) -> str | None:
        """"never" for what is never article text, "mark" or "comments" for what is marked so."""
        if tag in NEVER:
            return "never"
        found = set()
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return "never"
            if value and name == "style" and "display:none" in value.replace(" ", "").lower():
                return "never"
            if value and name in ("class", "id", "role"):
                found |= marks_in(value, MARKS if self.inside else MARKS | HEADS)
        if found & COMMENTS and tag not in ("html", "body", "main"):
            return "comments"
        if tag == "form" or tag == "header" and not self.inside:
            return "mark"
        return "mark" if found and tag not in ("html", "body", "article", "main") else None

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += not self.hidden
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_tag("p")
        if tag == "li" and self.stack and self.stack[-1][0] == "li":
            self.close_tag("li")
        kind = self.kind(tag, attrs)
        mark = None
        if kind and kind != "never" and tag in BLOCK and not self.hidden:
            mark = len(self.comments)
            self.comments.append(kind == "comments")
            self.marked.append(mark)
        hide = kind is not None and mark is None
        self.stack.append((tag, hide, mark))
        self.open[tag] += 1
        self.hidden += hide
        if tag in ARTICLE and not self.hidden:
            self.inside += 1
            self.articles.append(tuple(self.marked))
            if tag == "main":
                self.mains.update(self.marked)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_tag(self, tag: str) -> None:
        if not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if any(mark is not None for _, _, mark in self.stack[k:]):
                    self.flush()
                for t, hide, mark in reversed(self.stack[k:]):
                    if t in ARTICLE and not self.hidden:
                        self.inside -= 1
                    self.hidden -= hide
                    self.open[t] -= 1
                    if mark is not None:
                        self.marked.pop()
                del self.stack[k:]
                return
            if tag == "p" and self.stack[k][0] in CLOSES_P:
                return  # a p does not reach out of the block around it

    def handle_endtag(self, tag):
        self.tags += not self.hidden
        if tag in BLOCK:
            self.flush()
        self.close_tag(tag)

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)

    def kept_marks(self) -> set[int]:
        """Marked blocks that hold the article after all."""
        kept = {m for m in self.mains if not self.comments[m]}
        text = Counter()
        for t, _, _, marks in self.lines:
            text.update(dict.fromkeys(marks, len(t)))
        if not any(kept.issuperset(marks) for marks in self.articles):
            whole = sum(len(t) for t, *_ in self.lines)
            kept |= {m for m, n in text.items() if 2 * n > whole and not self.comments[m]}
        if not any(kept.issuperset(marks) for *_, marks in self.lines):
            kept.update(text)
        return kept

    def visible(self) -> tuple[list[tuple[str, int, bool]], bool]:
        """(text, tags, in article) of the lines outside boilerplate, and whether an article is marked."""
        kept = self.kept_marks()
        lines = [(t, n, inside) for t, n, inside, marks in self.lines if kept.issuperset(marks)]
        return lines, any(kept.issuperset(marks) for marks in self.articles)


def smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    padded = np.pad(ratio, r, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def best_of_runs(values: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """For each line the largest value in its unbroken run of lines inside; minus infinity outside."""
    run = np.cumsum(np.diff(inside, prepend=False) != 0)
    best = np.full(run[-1] + 1, -np.inf)
    np.maximum.at(best, run, values)
    return np.where(inside, best[run], -np.inf)


def page_lines(html: str) -> tuple[list[tuple[str, int, bool]], bool]:
    parser = _Lines()
    parser.feed(html)
    if _OPEN_TAG.match(parser.rawdata):
        parser.rawdata = ""  # a tag that the page's end cuts off
    parser.close()
    parser.flush()
    return parser.visible()


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.5) -> str:
    """Article text of a page: lines of the selected content regions joined by newlines.

    ``share``: outside a marked article a line is content if its smoothed text-to-tag ratio is
    at least this share of the mean of the page's ratios.
    """
    if not html:
        return ""
    lines, marked = page_lines(html)
    if not lines:
        return ""
    own = np.array([len(t) / n for t, n, _ in lines])
    ratio = smoothed(own, sigma)
    limit = share * ratio.mean()
    # A region takes in the lines beside it that reach the limit by themselves, and no lists of links,
    # whose many tags tell them from headings.
    links = (np.array([n for _, n, _ in lines]) >= LIST_TAGS) & (4 * own < limit)
    region = ratio >= limit
    keep = (best_of_runs(region, region | (own >= limit)) > 0) & ~links
    if marked:
        # Where the page marks its article, an unbroken run of its lines is one region: short
        # lines stay with the long ones beside them, and the region's best ratio decides.
        inside = np.array([i for _, _, i in lines])
        article = best_of_runs(ratio, inside) >= limit
        size = np.array([len(t) for t, _, _ in lines])
        if size[article].sum() >= size[keep & ~inside].sum():
            keep = article
    return "\n".join(t for (t, _, _), k in zip(lines, keep) if k)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 sigma: float = 1.0, share: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, sigma, share) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
