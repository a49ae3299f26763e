"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block; what markup itself declares to be a menu, header,
footer, sidebar, notice, advert, form, script, style or reader comment leaves a gap of empty lines.
Text lengths (links count nothing) are summed over sliding windows of `WINDOW` lines.  A window
that surges over `SURGE` characters opens a passage; the window in which the sum dives to nothing
closes it.  The text between is kept whole, short lines included.  Inside an article or main
element any text is a surge, linked or not, and lines outside count nothing.  A passage too short
to surge stays if it lies in the element around a surging block, so a removed advert cuts nothing
off.  A page in which nothing surges keeps the passage with the most text.

Elements that are not block elements leave the block around them whole, also where they are removed.
Names of classes say less than tags: `has-sidebar` is the name of a whole page as well.  Those of
headings say nothing, nor do ids inside an article, which are made from headings.  So the
lines of forms and of elements with marked names are held back, not dropped.  Where those of one
kind of marking hold over half of the unlinked text of the page (of the article, if there is one),
they are the body and come back, without the marked elements within them unless the same holds
there.  That only adds: what the page gives without them stays.

Character references are decoded; white space inside a block is one space.  Null, empty and
text-free pages give an empty string.  Repeated rows are taken one by one.  Markup that is cut
off, unbalanced or unquoted never fails.  Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows

WINDOW = 3
SURGE = 80
FLUSH_CHARS = 8_000_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|xmp|iframe)\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Any other element is inline, as in browsers.
BLOCKS = set(
    "address area article aside base blockquote body br caption center col colgroup dd details dialog "
    "dir div dl dt embed fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html input legend li link listing main menu meta nav noframes ol optgroup option "
    "p param plaintext pre search section select source summary table tbody td tfoot th thead tr track "
    "ul xmp".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# removed with their content, without breaking the block around them
INLINE_ASIDE = set("button noscript template svg object canvas datalist audio video applet".split())
ASIDE_TAGS = set(
    "nav header footer aside menu dialog select button noscript template svg object canvas "
    "datalist audio video applet".split()
)
ASIDE_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar".split()
)
COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond", "replies"}
ASIDE_WORDS = COMMENTS | set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar "
    "footer bottombar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended recommendations "
    "widget pagination pager toolbar search copyright disclaimer".split()
)
BODY_WORDS = {"article", "entry", "post", "story", "content", "main", "body"}
SOFT_WORDS = {"header", "footer", "banner", "alert", "search", "widget"}
CONTENT_TAGS = {"article", "main"}
# elements that end an open paragraph or an open element of their own name
IMPLIED = set("p li dt dd tr td th option div ul ol dl table section h1 h2 h3 h4 h5 h6 pre".split())
NESTED = {"div", "ul", "ol", "dl", "table", "section"}


def attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)
    } if source.strip(" /") else {}


def apart(name: str, attrs: dict[str, str], content: bool = False) -> str | None:
    """Why an element is no part of the article: `comments`, `aside`, None if it may be one, or
    what marks it, by which it is held back.

    The ids of headings are made from their texts, so only hiding counts there; within an article
    (`content`) the ids of other elements say nothing but that they hold comments."""
    if name in ASIDE_TAGS:
        return "aside"
    if not attrs:
        return "marked" if name == "form" else None
    named, words = set(), set()
    if name not in HEADINGS:
        named = {w.lower() for w in PART.findall(attrs.get("id", ""))}
        words = {w.lower() for w in PART.findall(attrs.get("class", ""))}
    if (words | named) & COMMENTS:
        return "comments"
    if not content:
        words |= named
    if name in ("html", "body") or name in CONTENT_TAGS:
        return None
    found = words & ASIDE_WORDS
    if words & BODY_WORDS:
        found -= SOFT_WORDS
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true"
    style = attrs.get("style", "").replace(" ", "").lower()
    role = attrs.get("role", "").lower()
    if hidden or "display:none" in style or role in ASIDE_ROLES:
        return "aside"
    if found or name == "form" or role == "form":
        return " ".join(["marked", *sorted(found)])
    return None


NO_ASIDE, ASIDE, COMMENT = -1, -2, -3  # else the number of a marked element


class Line(NamedTuple):
    text: str
    weight: int  # characters outside links
    inside: bool  # of an article or main element
    block: int  # number of the innermost element
    held: int  # number of the innermost marked element, or NO_ASIDE


class Element(NamedTuple):
    name: str
    block: int
    held: int  # as it was around the element
    content: bool


BLANK = Line("", 0, False, 0, NO_ASIDE)


class Lines:
    """The lines of a page, with the elements they are in and those by which they are held back."""

    def __init__(self) -> None:
        self.rows: list[Line] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self.content = 0
        self.found = False  # text inside an article
        self.held = NO_ASIDE
        self.marks: list[tuple[str, int]] = []  # of each marked element: how, and the one around
        self.parents = [0]
        self.elements: list[Element] = []
        self.opened: Counter[str] = Counter()

    def text(self, piece: str) -> None:
        if "&" in piece:
            piece = entities.unescape(piece)
        self.parts.append(piece)
        if self.links:
            self.linked += len(piece.strip())

    def block(self) -> int:
        return self.elements[-1].block if self.elements else 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                inside = self.content > 0
                weight = max(len(text) - self.linked, int(inside))
                self.rows.append(Line(text, weight, inside, self.block(), self.held))
                self.found |= inside and self.held == NO_ASIDE
            self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.flush()
        if self.rows and self.rows[-1].text:
            self.rows += [BLANK] * WINDOW

    def begin(self, name: str, why: str | None) -> None:
        ends = ("p",) if name in NESTED else ("p", name)
        while name in IMPLIED and self.elements and self.elements[-1].name in ends:
            self._pop()
        content = name in CONTENT_TAGS and self.held > ASIDE
        block = self.block()
        if name in BLOCKS:
            self.parents.append(block)
            block = len(self.parents) - 1
        self.elements.append(Element(name, block, self.held, content))
        self.opened[name] += 1
        self.content += content
        if not why or self.held <= ASIDE:
            return
        if why in ("aside", "comments"):
            self.held = ASIDE if why == "aside" else COMMENT
        else:
            self.marks.append((why, self.held))
            self.held = len(self.marks) - 1

    def _pop(self) -> None:
        last = self.elements.pop()
        self.opened[last.name] -= 1
        if last.held != self.held:
            if last.name not in INLINE_ASIDE:
                self.gap()
            self.held = last.held
        self.content -= last.content

    def end(self, name: str) -> None:
        """Close an element and what was left open in it; only its own end tag, or that of the
        page, closes an article."""
        outer = name in CONTENT_TAGS or name in ("body", "html")
        if not self.opened[name]:
            return
        for at in range(len(self.elements) - 1, -1, -1):
            if self.elements[at].name == name:
                break
            if self.elements[at].content and not outer:
                return
        while len(self.elements) > at:
            self._pop()

    def release(self) -> None:
        """Nothing open holds back any more."""
        self.gap()
        self.held = NO_ASIDE
        for k in range(len(self.elements) - 1, -1, -1):
            if self.elements[k].held == NO_ASIDE:
                break
            self.elements[k] = self.elements[k]._replace(held=NO_ASIDE)


def lines_of(page: str) -> Lines:
    lines, at = Lines(), 0
    for token in TOKEN.finditer(page):
        if token.start() > at and lines.held > ASIDE:
            lines.text(page[at : token.start()])
        at = token.end()
        if not token["name"]:
            if token["raw"] and token["raw"].lower() in BLOCKS:
                lines.flush()
            continue
        name, end = token["name"].lower(), token["end"] == "/"
        if name == "a":
            lines.links = 0 if end else 1
        elif name in BLOCKS:
            lines.flush()
            lines.links = 0
        if end:
            lines.end(name)
            continue
        if name in VOID:
            continue
        # an aside that was never closed ends where the article begins
        if name in CONTENT_TAGS and lines.held not in (NO_ASIDE, COMMENT) and not lines.found:
            lines.release()
        why = None
        if lines.held > ASIDE:
            why = apart(name, attributes(token["attrs"]), lines.content > 0)
        if why:
            if name not in INLINE_ASIDE:
                lines.gap()
            if token["attrs"].endswith("/"):
                continue
        if why or name in BLOCKS or lines.held != NO_ASIDE:
            lines.begin(name, why)
    if at < len(page) and lines.held > ASIDE:
        lines.text(page[at:])
    lines.flush()
    return lines


def chosen(lines: Lines, at: list[int]) -> set[int]:
    """Which of the lines with the given numbers are the main text."""
    rows = [lines.rows[k] for k in at]
    article = any(r.inside for r in rows)
    weights = [r.weight if r.inside or not article else 0 for r in rows]
    least = 1 if article else SURGE
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(rows))]
    passages, i = [], 0
    while i < len(rows):
        if not sums[i]:
            i += 1
            continue
        begin, top = i, 0
        while i < len(rows) and sums[i]:  # until the window sum dives to nothing
            top = max(top, sums[i])
            i += 1
        while not weights[begin]:
            begin += 1
        passages.append((begin, i, top, sum(weights[begin:i])))
    surging = [p for p in passages if p[2] >= least]
    kept = surging or sorted(passages, key=lambda p: -p[3])[:1]
    if len(surging) < len(passages) and surging:
        around = {lines.parents[r.block] for b, e, *_ in surging for r in rows[b:e] if r.weight}
        within = [0 in around]
        for block, parent in enumerate(lines.parents[1:], 1):
            within.append(block in around or within[parent])
        kept = [
            p for p in passages
            if p[2] >= least or any(r.weight and within[r.block] for r in rows[p[0] : p[1]])
        ]
    return {
        at[k] for begin, end, _, _ in kept for k in range(begin, end)
        if rows[k].text and (rows[k].inside or not article)
    }


def bodies(lines: Lines) -> set[int]:
    """The marked elements that hold most of the text: of those directly in the page (then: in
    the ones just found), all of one marking with over half of it."""
    article = lines.found
    sizes = [0] * len(lines.marks)
    whole = 0
    for r in lines.rows:
        if r.inside or not article:
            whole += r.weight
            if r.held >= 0:
                sizes[r.held] += r.weight
    within: dict[int, list[int]] = {}
    for k in range(len(sizes) - 1, -1, -1):
        around = lines.marks[k][1]
        within.setdefault(around, []).append(k)
        if around >= 0:
            sizes[around] += sizes[k]
    found: set[int] = set()
    level = [NO_ASIDE]
    while level:
        by_marking: dict[str, list[int]] = {}
        for k in (k for around in level for k in within.get(around, [])):
            by_marking.setdefault(lines.marks[k][0], []).append(k)
        level = []
        for group in by_marking.values():
            size = sum(sizes[k] for k in group)
            if 2 * size > whole:
                level, whole = group, size
                break
        found.update(level)
    return found


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    plain = [k for k, r in enumerate(lines.rows) if r.held == NO_ASIDE]
    kept = chosen(lines, plain)
    if len(plain) < len(lines.rows) and (found := bodies(lines)):
        found.add(NO_ASIDE)
        kept |= chosen(lines, [k for k, r in enumerate(lines.rows) if r.held in found])
    return "\n".join(lines.rows[k].text for k in sorted(kept))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url and the main `text` of each page, without a shuffle."""
    named = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        rows, held = [], 0
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for page, url, source in zip(ids, urls, batch.column(2), strict=True):
                text = main_text(source.as_py())
                rows.append((page, url, text))
                held += len(text)
                if held >= FLUSH_CHARS:
                    yield rows
                    rows, held = [], 0
        yield rows

    kinds = {c: t.dataType.simpleString() for c, t in zip(named.columns, named.schema, strict=True)}
    return map_rows(named, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
