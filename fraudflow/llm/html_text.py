"""Main text of web pages by line-block distribution.

Method: markup is stripped and the page becomes lines, one per block element.
The text length of each line is summed over a sliding window of lines; the sum
surges where the article begins and dives where it ends. A surge is measured
against the median sum, with long lines clipped, so no single paragraph sets the
bar; it reaches back to the lines before it, up to a whole window without text.
From the first surge to the last dive all is kept, lists of links between two
surges too. Lines that the markup itself calls something else (menus, headers,
footers, sidebars, notices, adverts, forms, comments) count as empty, so they
cannot make a surge, and links count little. Where hardly any text is outside of
such blocks, one that holds most of the page's text is the page's frame (a form
around everything, a menu that never ends), and only the blocks inside it count
as something else. The tags article and main only add weight to their lines;
surge and dive decide on all pages.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, read_table

SLICE = 2 << 20
#: Share of the page's text below which text outside of menus, forms and so on is hardly any, and above which a block of theirs holds most of it.
HARDLY, MOST = 0.1, 0.5
#: Lines of the sliding window.
WINDOW = 3
#: Share of the median window sum at which a surge begins, and the length beyond which a line adds no more to a sum.
SURGE, LONG = 0.15, 200

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>|</?[a-zA-Z][^>]*\Z", re.S
)
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "select", "xmp"}
_ASIDE = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "fieldset"}
#: Parts of a form inside a line: their text goes, the line stays one.
_INLINE_ASIDE = {"button", "label"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5",
    "h6", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What ends an element that has no end tag.
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|\Z)", re.I)
_UNSEEN = re.compile(r"(?:^|\s)(?:aria-hidden\s*=\s*[\"']?true\b|style\s*=\s*(?:\"[^\"]*display\s*:\s*none|'[^']*display\s*:\s*none))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_OTHER = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation",
    "menu", "menubar", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "foot", "colophon", "sidebar", "aside", "complementary", "contentinfo",
    "widget", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "form", "search", "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended",
    "pagination", "pager", "toolbar", "copyright", "legal", "disclaimer", "skip", "tags", "metadata", "byline",
}


#: Words that say where or how large something is, not what.
_PLACE = {
    "site", "page", "global", "main", "primary", "secondary", "top", "bottom", "left", "right", "upper", "lower", "first", "last", "sub", "mini", "sticky", "fixed", "mobile", "desktop",
    "box", "bar", "wrapper", "wrap", "container", "content", "area", "section", "block", "panel", "list", "slot", "unit", "inner", "outer", "item", "items", "link", "links", "row", "column",
    "post", "entry", "article", "blog", "wp", "js", "id", "text", "title", "heading", "group", "widget", "module",
}


#: Words and tags of blocks that are never a page's frame, however much they hold.
_NEVER = {"comment", "comments", "disqus", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored"}
_NEVER_TAGS = {"footer", "dialog", "head"}
OTHER, NEVER = 1, 2


def _other(name: str, attributes: str) -> int:
    """Whether an element is hidden, or class, id or role call a block something else than the article; 0 if not.

    A class counts only as a whole: all its words have to say so or say where it
    is. ``cookie-notice`` and ``main-nav`` do, ``has-sidebar`` and
    ``search-results`` do not. The id of a heading is made of its text and says
    nothing.
    """
    if not attributes:
        return 0
    if _UNSEEN.search(attributes) or _HIDDEN.search(_QUOTED.sub('""', attributes)):
        return NEVER
    if name not in _BLOCK or name in ("html", "body", "main", "article"):
        return 0
    for found in _NAME.finditer(attributes):
        if name in _HEADINGS and found[1].lower() == "id":
            continue
        for token in html.unescape(next(filter(None, found.groups()[1:]), "")).split():
            parts = {p.lower() for p in _PART.findall(token) if not p.isdigit()}
            if parts & _OTHER and parts <= _OTHER | _PLACE:
                return NEVER if parts & _NEVER else OTHER
    return 0


class _Lines:
    """Lines of a page with the length of their text outside links, and the blocks of something else that they are in."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.linked = 0

    def text(self, part: str, in_link: bool) -> None:
        self.parts.append(part)
        if in_link:
            self.linked += len(part)

    def end(self, inside: bool, others: tuple[int, ...]) -> None:
        if self.parts:
            line = " ".join(html.unescape("".join(self.parts)).split())
            if line:
                outside = max(0, len(line) - self.linked)
                # links with nothing but spaces between them hold no text outside
                self.lines.append((line, outside if outside > line.count(" ") else 0, inside, others))
            self.parts, self.linked = [], 0


_PLAIN, _ARTICLE, _MUTE = 0, -1, -2


class _Page:
    """Reads a page once; ``open`` are its open blocks as (name, what it is): plain, article, mute or the number of a block of something else."""

    def __init__(self, page: str) -> None:
        self.out = _Lines()
        self.open: list[tuple[str, int]] = []
        self.others: tuple[int, ...] = ()
        self.never: set[int] = set()
        self.count = self.article = self.mute = self.links = 0
        at, end, find = 0, len(page), _TAG.search
        while at < end:
            found = find(page, at)
            if not self.mute and (upto := found.start() if found else end) > at:
                self.out.text(page[at:upto], self.links > 0)
            if not found:
                break
            at = found.end()
            name = (found[2] or found[5] or "").lower()
            if not name:
                continue
            if found[1] or found[4]:
                self.closed(name)
            elif name in _RAW:
                self.line()
                at = _after(page, at, name)
            else:
                self.opened(name, found[3] or found[6] or "")
        self.line()

    def line(self) -> None:
        self.out.end(self.article > 0, self.others)

    def opened(self, name: str, attributes: str) -> None:
        block = name in _BLOCK or name in _ASIDE
        if block:
            self.line()
            # a block ends an open paragraph, an item the one before it
            if self.open and (self.open[-1][0] == "p" or name in _ENDED_BY.get(self.open[-1][0], ())):
                self.pop()
        if name in _VOID:
            if name != "wbr":
                self.out.text(" ", False)
            return
        if attributes.endswith("/"):
            return
        other = OTHER if name in _ASIDE and not (name == "header" and self.article) else _other(name, attributes)
        if name in _INLINE_ASIDE or (other and not block):
            self.mute += 1
            self.open.append((name, _MUTE))
        elif other:
            self.count += 1
            if name in _NEVER_TAGS or _other(name if name in _BLOCK else "div", attributes) == NEVER:
                self.never.add(self.count)
            self.others += (self.count,)
            self.open.append((name, self.count))
        elif name in ("article", "main"):
            self.article += 1
            self.open.append((name, _ARTICLE))
        elif block:
            self.open.append((name, _PLAIN))
        elif name == "a":
            self.links = 1
        elif name in ("td", "th"):
            self.out.text(" ", False)

    def pop(self) -> None:
        _, what = self.open.pop()
        if what == _ARTICLE:
            self.article -= 1
        elif what == _MUTE:
            self.mute -= 1
        elif what != _PLAIN:
            self.others = self.others[:-1]

    def closed(self, name: str) -> None:
        """Ends an element and what is still open inside it; an end without a beginning only ends a line."""
        if name == "a":
            self.links = 0
            return
        if name in _BLOCK or name in _ASIDE or name in _RAW:
            self.line()
        if any(n == name for n, _ in self.open):
            while self.open:
                last, what = self.open[-1]
                if what != _MUTE:
                    self.line()
                self.pop()
                if last == name:
                    break


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(line, length outside links, inside the tags of an article) of all lines that count."""
    read = _Page(page)
    lines, never = read.out.lines, read.never
    frames: set[int] = set()
    some = [(n, others) for _, n, _, others in lines if not never.intersection(others)]
    total = sum(n for n, _ in some)
    if sum(n for n, others in some if not others) < HARDLY * total:
        held: dict[int, int] = {}
        for n, others in some:
            for o in others:
                held[o] = held.get(o, 0) + n
        frames = {o for o, n in held.items() if n > MOST * total and n > LONG}
    return [(line, n, inside) for line, n, inside, others in lines if frames.issuperset(others)]


def _after(page: str, at: int, name: str) -> int:
    """The place after the end tag of a raw element."""
    found = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, at)
    return found.end() if found else len(page)


def main_text(page: str) -> str:
    """The article of a page, a line per block; empty if there is none."""
    lines = page_lines(page)
    # a line in the tags of an article weighs more, and its links count too
    held = [min(n, LONG) + (min(len(line), LONG) if inside else 0) for line, n, inside in lines]
    sums = [sum(held[i : i + WINDOW]) for i in range(len(held))]
    some = sorted(filter(None, sums))
    if not some:
        return ""
    least = SURGE * some[len(some) // 2]
    # runs of lines with text and no dive (a whole window without) between them; those with a surge are the article
    runs: list[list] = []
    for i, weight in enumerate(held):
        if not weight:
            continue
        if not runs or i - runs[-1][1] - 1 > WINDOW:
            runs.append([i, i, False])
        runs[-1][1] = i
        runs[-1][2] |= sums[i] >= least
    surged = [run for run in runs if run[2]]
    return "\n".join(line for line, _, _ in lines[surged[0][0] : surged[-1][1] + 1])


def _extract(rows):
    for batch in batches(rows, SLICE, "html"):
        texts = [main_text(page) for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"]
        )


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row of ``pages``.

    A null or empty page, or one without an article, gives an empty text;
    repeated rows are extracted each; null keys and urls stay null; an empty
    table gives no rows. Other columns of ``pages`` are ignored, whatever their
    names. No shuffle: each page is read, stripped and judged on its own.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    out = rows.mapInArrow(_extract, f"id {kinds[key]}, url {kinds[url]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": key, "url": url})


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    """``extract_text`` over ``pages``."""
    return extract_text(read_table(spark, sf_dir, "pages"))
