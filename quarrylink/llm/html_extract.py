"""Main text of web pages by nearest-URL page differencing.

Pages of one host with the same lines are one page here, at the least of their paths; all get what it
gets. Pages are ordered by host, path and id; each is paired with the neighbour in that order, on the same
host, whose path has the longer common prefix with its own. All their text lines are aligned by a longest
common subsequence, and the lines they share are deleted: menus, notices and footers that a site
repeats. A check of every line follows. Sites repeat passages in articles too, so what differencing deletes of the
body of an ``<article>`` comes back; a header or footer in it (``outer``), but for headings, stays deleted. Of what
differencing leaves, lines in elements made for navigation, adverts, forms or comments go, and, where there is an
``<article>`` (or else ``<main>``), all lines outside.

The order is global: rows get their place in a range sort, and are dealt out in runs of ``RUN`` places
with one page of context at each end. So a host of any size is spread evenly, and the result does not
depend on the number of tasks.

Lines are aligned by their 64-bit hashes, so pages are parsed twice instead of stored: for these, and for the text.
Elements end where HTML ends them: void elements hold
nothing, and a ``p``, ``li``, ``dt``, ``dd``, ``option`` or table part without an end tag ends where the next one
begins or its parent ends.

Defined results: a null html is empty and gives an empty text; a null url or one without ``://`` has
the empty host; very long pages are parsed whole in one pass; repeated rows are pages each; of neighbours with
prefixes of the same length the one before counts; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, small_batches

RUN = 64

TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[/a-zA-Z][^>]*(?:>|$)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"\s+")

#: Elements and names of HTML by what they are for.
RAW = {"script", "style", "title", "textarea", "xmp", "noframes", "noembed", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CHROME = {"head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "iframe", "button", "select", "dialog", "menu", "object", "canvas"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option",
    "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that end an open paragraph; for others, which open elements they end, and what bounds the search.
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "xmp",
}
P_BOUNDS = {"button", "caption", "html", "object", "table", "td", "template", "th"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}), "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
IN_HEAD = {"base", "head", "html", "link", "meta", "noscript", "script", "style", "template", "title"}
CHROME_NAMES = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "menu",
    "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "share", "sidebar", "social", "sponsor", "sponsored",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OUTER_NAMES = {"header", "masthead", "footer"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}


class Line(NamedTuple):
    text: str
    article: bool
    main: bool
    chrome: bool
    outer: bool = False


def _is_outer(tag: str, rest: str) -> bool:
    """Whether a block of an article is made for a header or footer, which may be the article's or the site's."""
    if tag == "header":
        return True
    return any(set(re.split(r"[\s_-]+", v.strip("\"'").lower())) & OUTER_NAMES for n, v in ATTRIBUTE.findall(rest) if n.lower() in ("class", "id")) if rest.strip() else False


def _is_chrome(tag: str, rest: str, inside: bool) -> bool:
    if tag in CHROME or tag == "header" and not inside:
        return True
    for name, value in ATTRIBUTE.findall(rest) if rest.strip() else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words = set(re.split(r"[\s_-]+", value))
            if words & CHROME_NAMES or not inside and words & OUTER_NAMES:
                return True
        elif name == "role" and value in CHROME_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


class _Open:
    """The open elements: a stack of (tag, whether a region of chrome begins with it, the text it stands in, whether an outer one does).

    Blocks end where a block or a region begins or ends; a region within a line, as an icon in a sentence, has a line
    of its own, and the sentence goes on behind it.
    """

    def __init__(self):
        self.stack: list[tuple[str, bool, list[str] | None, bool]] = []
        self.counts = {"article": 0, "main": 0}
        self.chrome = self.outer = self.headings = 0
        self.buffer: list[str] = []
        self.lines: list[Line] = []

    def end_block(self) -> None:
        if self.buffer:
            text = SPACE.sub(" ", entities.unescape("".join(self.buffer))).strip()
            self.buffer = []
            if text:
                free = not self.chrome
                self.lines.append(Line(text, free and self.counts["article"] > 0, free and self.counts["main"] > 0, not free, free and self.outer > 0 and not self.headings))

    def push(self, tag: str, chrome: bool, outer: bool = False) -> None:
        around = None
        if chrome and tag not in BLOCKS:
            around, self.buffer = self.buffer, []
        self.stack.append((tag, chrome, around, outer))
        self.chrome += chrome
        self.outer += outer
        self.headings += tag in HEADINGS
        if tag in self.counts:
            self.counts[tag] += 1

    def remove(self, k: int, only: bool = False) -> None:
        """Ends the element at place k, and, if not ``only`` it, those in it."""
        for tag, chrome, around, outer in [self.stack[k]] if only else self.stack[k:][::-1]:
            if chrome or tag in BLOCKS:
                self.end_block()
            self.chrome -= chrome
            self.outer -= outer
            self.headings -= tag in HEADINGS
            if around is not None:
                self.buffer = around
            if tag in self.counts:
                self.counts[tag] -= 1
        del self.stack[k : k + 1 if only else None]

    def last(self, tags: set[str], bounds: set[str] | frozenset = frozenset()) -> int | None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                return k
            if self.stack[k][0] in bounds:
                return None
        return None

    def begins(self, tag: str) -> None:
        """Ends what the start of an element ends by the rules of HTML."""
        if tag not in IN_HEAD and (k := self.last({"head"})) is not None:
            self.remove(k)
        if tag in ENDS and (k := self.last(*ENDS[tag])) is not None:
            self.remove(k)
        if tag in ENDS_P and (k := self.last({"p"}, P_BOUNDS)) is not None:
            self.remove(k)


def lines_of(page: str) -> list[Line]:
    """The text blocks of a page in order; each a line, with what it stands in."""
    open_, at = _Open(), 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            open_.buffer.append(page[at : m.start()])
        at = m.end()
        if not (tag := (m["tag"] or "").lower()):
            continue
        if m["end"] and tag != "br":
            if (k := open_.last({tag})) is not None:
                open_.remove(k, only=tag not in BLOCKS and tag not in CHROME)
            elif tag in BLOCKS:
                open_.end_block()
            continue
        if tag == "br":
            open_.buffer.append(" ")
        open_.begins(tag)
        if tag in BLOCKS:
            open_.end_block()
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else len(page)
        elif tag not in VOID and not (m["rest"].endswith("/") and (tag in ("svg", "math") or open_.last({"svg", "math"}) is not None)):
            inside = open_.counts["article"] > 0
            chrome = not open_.chrome and _is_chrome(tag, m["rest"], inside)
            open_.push(tag, chrome, inside and not chrome and tag in BLOCKS and tag != "article" and _is_outer(tag, m["rest"]))
    open_.buffer.append(page[at:])
    open_.end_block()
    if open_.stack:
        open_.remove(0)
    open_.end_block()
    return open_.lines


def common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists as places (i, j), by Hunt and Szymanski's method between equal ends."""
    n = prefix(a, b)
    m = prefix(a[n:][::-1], b[n:][::-1])
    head, tail = [(k, k) for k in range(n)], [(len(a) - k, len(b) - k) for k in range(m, 0, -1)]
    places = defaultdict(list)
    for j in range(n, len(b) - m):
        places[b[j]].append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(n, len(a) - m):
        line = a[i]
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, j, links[k - 1] if k else None)
            ends[k : k + 1], links[k : k + 1] = [j], [link]
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[:2])
        link = link[2]
    return head + out[::-1] + tail


def prefix(a: str | list, b: str | list) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def kept_places(own: tuple, neighbours: list[tuple]) -> list[int]:
    """Places of the lines of ``own`` (host, path, lines) that the nearest of its neighbours does not share."""
    path, lines = own[1:3]
    useful = [n for n in neighbours if n and n[0] == own[0] and n[2] != lines]
    if not useful:
        return list(range(len(lines)))
    nearest = max(useful, key=lambda n: prefix(n[1], path))
    gone = {i for i, _ in common(lines, nearest[2])}
    return [i for i in range(len(lines)) if i not in gone]


def main_text(page: str, kept: list[int] | None = None) -> str:
    """The page's text, of which differencing keeps the lines at ``kept`` (all, if None)."""
    return text_of(lines_of(page), kept)


def text_of(lines: list[Line], kept: list[int] | None) -> str:
    """What the check leaves: the article, without outer lines that differencing deletes; else kept lines of the main element, or of all, but for chrome."""
    left = set(range(len(lines)) if kept is None else kept)
    if any(x.article for x in lines):
        return "\n".join(x.text for i, x in enumerate(lines) if x.article and (not x.outer or i in left))
    stay = [x for i, x in enumerate(lines) if i in left and not x.chrome]
    if any(x.main for x in stay):
        stay = [x for x in stay if x.main]
    return "\n".join(x.text for x in stay)


def _marks(lines: list[Line]) -> np.ndarray:
    """A 64-bit hash of each line's text."""
    return np.frombuffer(b"".join(xxhash.xxh3_64_digest(x.text.encode("utf-8", "surrogatepass")) for x in lines), np.int64)


def _outline(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """The page's columns, and marks: its lines' hashes; if ``whole``, also the lines and their kinds."""
    for batch in batches:
        parsed = [lines_of(x.as_py() or "") for x in batch.column("html")]
        found = {c: batch.column(c) for c in batch.schema.names if c != "html"} | {"marks": pa.array(map(_marks, parsed), pa.list_(pa.int64()))}
        if whole:
            found["lines"] = pa.array([[x.text for x in p] for p in parsed], pa.list_(pa.string()))
            found["kinds"] = pa.array([[x.article + 2 * x.main + 4 * x.chrome + 8 * x.outer for x in p] for p in parsed], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(list(found.values()), list(found))


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by run and place: what differencing keeps of the lines of each."""
    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    before, own = None, next(rows, None)
    ids, keys, kept = [], [], []
    while own:
        after = next(rows, None)
        near = [x[5:] if x and x[0] == own[0] and abs(x[1] - own[1]) == 1 else None for x in (before, after)]
        places = kept_places(own[5:8], [n and n[:3] for n in near])
        if own[2] and places:
            ids.append(own[3])
            keys.append(own[4])
            kept.append(places)
        before, own = own, after
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(kept, pa.list_(pa.int32()))], ["a", "b", "kept"])


def _placed(rows: DataFrame, *by: str) -> DataFrame:
    """Adds place, the row's number in the order of ``by``, without bringing rows together."""
    ranked = settle(rows.sort(*by)).withColumn("_m", F.monotonically_increasing_id())
    ranked = ranked.withColumn("_p", F.shiftright("_m", 33))
    sizes = ranked.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each task of the sort
    starts = sizes.withColumn("_s", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n"))
    return ranked.join(F.broadcast(starts), "_p").withColumn("place", F.col("_s") + F.col("_m") - F.shiftleft("_p", 33)).drop("_m", "_p", "_n", "_s")


def _parsed(pages: DataFrame, whole: bool) -> DataFrame:
    """Every page parsed: page_id, url, host, path, hashes a and b of host and lines, and marks; or, if ``whole``, lines and kinds."""
    url = F.coalesce("url", F.lit(""))
    keyed = pages.select(
        "page_id", "url", F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"), "html",
    )
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, host string, path string, marks array<long>" + ", lines array<string>, kinds array<int>" * whole
    outlines = keyed.mapInArrow(lambda b: _outline(b, whole), schema)
    return outlines.select("*", F.xxhash64("host", "marks").alias("a"), F.xxhash64(F.lit("second"), "host", "marks").alias("b"))


def outlined(pages: DataFrame) -> DataFrame:
    """page_id, host, path, marks, a and b of every page, stored."""
    return settle(_parsed(pages, False).drop("url"))


def differenced(outlines: DataFrame) -> DataFrame:
    """(a, b, kept): places of the lines that stay, of every page."""
    first = F.min_by(F.struct("host", "path", "page_id", "marks"), F.struct("path", "page_id")).alias("first")
    distinct = outlines.groupBy("a", "b").agg(first).select("a", "b", "first.*")
    placed = _placed(distinct, "host", "path", "page_id", "a", "b")
    run, at = F.floor(F.col("place") / RUN), F.pmod("place", F.lit(RUN))
    runs = F.when(at == 0, F.array(run, run - 1)).when(at == RUN - 1, F.array(run, run + 1)).otherwise(F.array(run))
    dealt = placed.select("*", F.explode(runs).alias("run"))
    dealt = dealt.select("run", "place", (F.col("run") == run).alias("own"), "a", "b", "host", "path", "marks")
    return dealt.repartition("run").sortWithinPartitions("run", "place").mapInArrow(_difference, "a long, b long, kept array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for cells in zip(*(batch.column(c) for c in ("lines", "kinds", "kept")), strict=True):
                lines, kinds, kept = (x.as_py() for x in cells)
                texts.append(text_of([Line(x, *(bool(k & bit) for bit in (1, 2, 4, 8))) for x, k in zip(lines, kinds, strict=True)], kept or []))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    small_batches(pages.sparkSession)
    kept = differenced(outlined(pages))
    whole = _parsed(pages, True).select("page_id", "url", "lines", "kinds", "a", "b").join(kept, ["a", "b"], "left").select("page_id", "url", "lines", "kinds", "kept")
    texts = whole.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
