"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element.  A line weighs as much as its text outside links, inside an
article as much as its whole text.  Scripts,
styles, menus, headers, footers, sidebars, notices, adverts, forms and comments leave one empty line each, however long
they are, and the edge of an article leaves a gap of WINDOW empty lines.  The weights are summed over sliding windows of
WINDOW lines: text surges where a window's sum leaves zero and dives where it comes back.  All stretches between surge and
dive that lie inside an article or main element are kept; on a page without any, the heaviest and all others with a window
of at least DENSE.

An element without end tag ends where HTML ends it: a paragraph at the next block, an item or cell at the next one, and any
at the end tag of what encloses it.

Elements are known by their names, or by whole names in their class, id or role: a word of the list, alone or in a compound
with other such words and words of layout ("comment-list", but not "comments-open").  No html, body, article or main element
goes by a name, but an article that is a "comment"; and where no article, or hardly any text, would be left, an element that
holds an article, or over half of the page's text, stays whatever it is called.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from hourgrid.llm.common import col, text_of

WINDOW = 3
DENSE = 86  # code points outside links in a window: a line of prose

# Element names and words of classes, ids and roles.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
CONTENT = frozenset("article main".split())
ASIDE = frozenset("head nav footer aside form button select datalist dialog menu noscript template svg canvas object audio video map".split())
OUTER = frozenset("header".split())  # belongs to the text inside an article
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs footer contentinfo sidebar sidenav complementary widget widgets cookie cookies consent gdpr notice "
    "notices notification alert alertdialog popup modal overlay dialog newsletter subscribe subscription signup login register "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond replies pagination pager "
    "toolbar search searchbox form skip copyright".split()
)
OUTER_WORDS = frozenset("header masthead topbar".split())
LAYOUT = frozenset(
    "area bar block body box button buttons column container content entry footer form group header heading icon icons inline inner item items left "
    "link links list main message modal module nav outer page panel policy post posts right row section site slot social text thread title top "
    "bottom unit wrap wrapper stories story article articles us to the this on your my".split()
)
WHOLE = frozenset("html body article main".split())

BLOCKS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
WALLS = frozenset("table caption td th button object template".split())  # end tags of what is outside have no effect inside
ROWS = frozenset("tr tbody thead tfoot".split())
THROUGH = CONTENT | ROWS | WALLS | frozenset("body html".split())  # their end tags pass walls
HEAD = frozenset("base basefont bgsound head html link meta noscript noframes script style template title".split())
# elements that end without an end tag, at the start of which, and what hides them from it
IMPLIED = (
    (frozenset(["p"]), BLOCKS, WALLS),
    (frozenset(["li"]), frozenset(["li"]), BLOCKS - frozenset("address div p li".split()) | WALLS),
    (frozenset(["dt", "dd"]), frozenset(["dt", "dd"]), BLOCKS - frozenset("address div p dt dd".split()) | WALLS),
    (frozenset(["option"]), frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
    (frozenset(["td", "th"]), frozenset(["td", "th"]) | ROWS, frozenset(["table"])),
    (frozenset(["tr"]), ROWS, frozenset(["table"])),
)

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>?")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
_COMMENT = re.compile(r"""\bclass\s*+=\s*+(?:"comment"|'comment'|comment(?=[\s>]|$)|["'][^"']*(?<=[\s"'])comment(?=[\s"']))""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")
WHITE = " \t\n\r\f\v"
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _called(attributes: str, words: frozenset[str], role: bool = True) -> bool:
    """Whether a whole name in class, id or role is one of the words, alone or with others and words of layout."""
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [p for p in _SPLIT.split(_CAMEL.sub("-", name).lower()) if p and not p.isdigit()]
            if any(p in words for p in parts) and all(p in words or p in LAYOUT or p in WORDS for p in parts):
                return True
    return False


def _by_name(name: str, inside: bool) -> bool:
    """Whether an element is not part of the text, whatever it is called."""
    return name in ASIDE or name in OUTER and not inside


def _by_words(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's class, id or role says that it is not part of the text, or it is hidden."""
    if not attributes.strip():
        return False
    if name in WHOLE:
        return name == "article" and _COMMENT.search(attributes) is not None
    return _called(attributes, WORDS) or not inside and _called(attributes, OUTER_WORDS) or _HIDDEN.search(attributes) is not None


class _Lines:
    """Lines of a page as they come up: text, weight, and whether inside an article."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.weight: list[int] = []
        self.inside: list[bool] = []
        self.parts: list[str] = []
        self.linked = 0
        self.size = self.articles = 0  # of the whole page so far, what is left out by its words included

    def flush(self, inside: bool) -> None:
        line = " ".join("".join(self.parts).split())
        if line:
            self._add(line, len(line) if inside else max(0, len(line) - self.linked), inside)
        self.parts, self.linked = [], 0

    def _add(self, line: str, weight: int, inside: bool) -> None:
        self.text.append(line)
        self.weight.append(weight)
        self.inside.append(inside)

    def hole(self, inside: bool) -> None:
        self.flush(inside)
        if self.text and self.text[-1]:
            self._add("", 0, inside)

    def gap(self, inside: bool) -> None:
        self.flush(inside)
        for _ in range(WINDOW):
            self._add("", 0, inside)


class _Named:
    """What an element holds that its class, id or role speaks against: code points, and whether an article."""

    def __init__(self, page: "_Lines"):
        self.page, self.size, self.articles = page, -page.size, -page.articles

    def close(self) -> None:
        self.size += self.page.size
        self.articles += self.page.articles


class _Open:
    """Open elements, with the place of the innermost wall and of each that a start tag may end; no step walks the stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, tuple[int, ...]]] = []
        self.where: dict[str, list[int]] = {}
        self.marked: list[tuple[int, _Named]] = []  # open elements that are measured, with their places

    def cut(self, n: int) -> None:
        while len(self.stack) > n:
            self.where[self.stack.pop()[0]].pop()
        while self.marked and self.marked[-1][0] >= n:
            self.marked.pop()[1].close()

    def imply(self, name: str) -> None:
        """End what ends at the start of ``name``."""
        for k, (_, starts, _) in enumerate(IMPLIED):
            if name in starts and self.stack and self.stack[-1][2][k] >= 0:
                self.cut(self.stack[-1][2][k])

    def push(self, name: str) -> None:
        n = len(self.stack)
        _, wall, before = self.stack[-1] if n else ("", -1, (-1,) * len(IMPLIED))
        places = tuple(n if name in ends else -1 if name in hides else b for (ends, _, hides), b in zip(IMPLIED, before))
        self.stack.append((name, n if name in WALLS else wall, places))
        self.where.setdefault(name, []).append(n)

    def last(self, name: str) -> int:
        """Place of the element that an end tag ends, -1 if none."""
        places = self.where.get(name)
        return places[-1] if places and (name in THROUGH or places[-1] >= self.stack[-1][1]) else -1


def _lines(page: str) -> _Lines:
    """The lines of a page; where nothing else is left, elements that their words speak against stay."""
    named: dict[int, _Named] = {}
    out = _parsed(page, frozenset(), named)
    no_article = not any(i and w for i, w in zip(out.inside, out.weight)) and any(e.articles for e in named.values())
    no_text = sum(out.weight) < DENSE and any(2 * e.size > max(out.size, DENSE) for e in named.values())
    if no_article or no_text:
        named = {}
        _parsed(page, None, named)
        keeps = lambda e: e.articles if no_article else 2 * e.size > max(out.size, DENSE)
        out = _parsed(page, frozenset(at for at, e in named.items() if keeps(e)), {})
    return out


def _parsed(page: str, spared: frozenset[int] | None, named: dict[int, _Named]) -> _Lines:
    """Lines of a page without what is set aside, but for the elements at ``spared`` (all that go by their words, if None).

    ``named`` gets what the outermost of the elements hold that go by their words, or all of them if all are spared.
    """
    out, at, depth, links = _Lines(), 0, 0, 0
    opened, skipped, quiet = _Open(), -1, False  # the place of the element that is being left out, and whether by its name
    while at < len(page):
        lt = page.find("<", at)
        lt = len(page) if lt < 0 else lt
        if lt > at and not (skipped >= 0 and quiet):
            text = html.unescape(page[at:lt])
            out.size += len(text) - sum(map(text.count, WHITE))
            if skipped < 0:
                out.parts.append(text)
                out.linked += len(text) if links else 0
        if lt == len(page):
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
            continue
        tag = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if not tag:  # a bare "<" is text
            if skipped < 0:
                out.parts.append("<")
            at = lt + 1
            continue
        at, closing, name, attributes = tag.end(), tag[1], tag[2].lower(), tag[3]
        if name in RAW and not closing:
            end = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.start()
            continue
        if closing:
            place = opened.last(name)
            if place < skipped and name in CONTENT and depth:
                opened.cut(skipped)
            if place >= 0:
                opened.cut(place)
            if skipped >= 0 and (place == skipped or len(opened.stack) > skipped):
                skipped = -1 if place == skipped else skipped
                continue
        else:
            opened.imply(name)
            if len(opened.stack) > skipped >= 0:
                # an element that was never closed ends where the page goes on
                lost = opened.stack[-1][0] == "head" and name not in HEAD or name in CONTENT and not depth and not _by_words(name, attributes, False) and quiet
                if not lost:
                    if not quiet and name in CONTENT and not _by_words(name, attributes, False):
                        out.articles += 1
                    if name not in VOID and (name not in INLINE or name == opened.stack[skipped][0]):
                        opened.push(name)
                    continue
                opened.cut(skipped)
        skipped = -1
        if not closing and name not in VOID:
            quiet = _by_name(name, depth > 0)
            words = not quiet and _by_words(name, attributes, depth > 0)
            if words and (spared is None or lt not in spared):
                named[lt] = _Named(out)
                opened.marked.append((len(opened.stack), named[lt]))
            if quiet or words and spared is not None and lt not in spared:
                out.hole(depth > 0)
                skipped = len(opened.stack)
                opened.push(name)
                continue
            if words and name in INLINE:
                opened.push(name)
        if not closing and name not in VOID and name not in INLINE:
            opened.push(name)
        if name in CONTENT:
            out.articles += not closing
            if not closing and not depth:
                out.gap(False)
            depth = max(0, depth + (-1 if closing else 1))
            if closing and not depth:
                out.flush(True)
                out.gap(False)
            else:
                out.flush(True)
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br":
            out.parts.append(" ")
        elif name not in INLINE:
            out.flush(depth > 0)
            links = 0
    opened.cut(0)
    out.gap(depth > 0)
    return out


def main_text(page: str) -> str:
    """The main text of a page: its blocks joined by newlines, empty if it has none."""
    lines = _lines(page)
    sums, running = [], 0
    for n, weight in enumerate(lines.weight):  # over the line and the WINDOW - 1 before it
        running += weight - (lines.weight[n - WINDOW] if n >= WINDOW else 0)
        sums.append(running)
    stretches, surge = [], None
    for n, total in enumerate(sums):
        if total and surge is None:
            surge = n
        elif not total and surge is not None:
            stretches.append((surge, n))
            surge = None
    kept = [s for s in stretches if any(lines.inside[slice(*s)])]
    if not kept and stretches:
        heaviest = max(stretches, key=lambda s: (sum(lines.weight[slice(*s)]), -s[0]))
        dense = [s for s in stretches if s == heaviest or max(sums[slice(*s)]) >= DENSE]
        kept = [(start, max(n for n in range(start, dive) if lines.weight[n]) + 1) for start, dive in dense]
    return "\n".join(line for s in kept for line in lines.text[slice(*s)] if line)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text`` and ``n_chars``, the code points of the text.

    Null pages count as empty and give empty texts; identifiers and addresses pass through, nulls and repeats included.  An
    empty table gives an empty result; other columns are not read.
    """
    slim = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), text_of(pages, html_col).alias("html"))
    schema = slim.drop("html").schema.add("text", "string").add("n_chars", "long")

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=schema.names)

    return slim.mapInArrow(stripped, schema)
