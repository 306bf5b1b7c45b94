"""Text of HTML pages, by a forgiving scanner that reads each page once from left to right.

It knows tags with quoted attributes, comments, raw-text elements, void and
self-closing elements, and which end tags close which open elements. Of the
tree it keeps only what decides where boilerplate ends: the open sectioning and
block elements. Nothing recurses and nothing is read twice, so its time is
linear in the page and no number of tags exhausts a stack.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Elements whose content is no text of the page.
BOILERPLATE = frozenset(("script", "style", "nav", "footer", "header", "aside", "noscript"))
# Elements whose content holds no tags; what is in the first two is no text either.
RAW = ("script", "style", "textarea", "title")
# Elements that an end tag of another block can close, and that stop the end tags of inline elements.
BLOCKS = frozenset(
    "address article aside blockquote button center details dialog dir div dl fieldset figcaption figure footer form header hgroup li listing main menu nav noscript ol pre search section summary ul".split()
)
# Elements across which the end tag of a block does not reach.
SCOPES = frozenset("applet caption marquee object table td template th".split())
PAGE = StructType([StructField("title", StringType()), StructField("paragraphs", ArrayType(StringType()))])

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# Possessive: what is an attribute value stays one, and a tag without an end is found out in one pass.
_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=|["'])*+>""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_BREAKS = re.compile(r"\n{3,}")


class _Open:
    """The open elements that matter, and how many of them are boilerplate."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self.scopes: list[Counter] = [Counter()]
        self.all: Counter = Counter()
        self.hidden = 0

    def start(self, name: str) -> None:
        self.stack.append(name)
        self.all[name] += 1
        self.scopes[-1][name] += 1
        self.hidden += name in BOILERPLATE
        if name in SCOPES:
            self.scopes.append(Counter())

    def end(self, name: str) -> None:
        if not (self.all if name in SCOPES else self.scopes[-1])[name]:
            return
        while True:
            last = self.stack.pop()
            if last in SCOPES:
                self.scopes.pop()
            self.all[last] -= 1
            self.scopes[-1][last] -= 1
            self.hidden -= last in BOILERPLATE
            if last == name:
                return


def page(source: str) -> tuple[str, str | None]:
    """(text nodes outside boilerplate joined by line feeds, title or None).

    As browsers read it: a boilerplate element without an end hides the rest of
    the block it is in; a comment, tag or raw-text element without an end takes
    the rest of the page.
    """
    out: list[str] = []
    title: str | None = None
    open_ = _Open()
    at, n = 0, len(source)
    text_from = 0

    def text(stop: int) -> None:
        if stop > text_from and not open_.hidden:
            out.append(html.unescape(source[text_from:stop]))

    while True:
        at = source.find("<", at)
        if at < 0:
            text(n)
            break
        mark = source[at + 1 : at + 2]
        if mark in ("!", "?") or mark == "/" and not source[at + 2 : at + 3].isalpha():
            if mark == "/" and at + 2 >= n:
                at += 1
                continue
            text(at)
            stop = source.find("-->", at + 4) if source.startswith("<!--", at) else source.find(">", at)
            if stop < 0:
                break
            at = text_from = stop + (3 if source.startswith("<!--", at) else 1)
            continue
        ending = mark == "/"
        found = _NAME.match(source, at + 1 + ending)
        if not found or not source[at + 1 + ending].isascii():
            at += 1
            continue
        text(at)
        rest = _REST.match(source, found.end())
        if not rest:
            break
        name = found[0].lower()
        at = text_from = rest.end()
        if ending:
            open_.end(name)
        elif source[rest.end() - 2] == "/" and rest.end() - 2 >= found.end():
            continue  # it closes itself
        elif name in _RAW_END:
            close = _RAW_END[name].search(source, at)
            stop = close.start() if close else n
            if name in ("title", "textarea") and not open_.hidden:
                inside = html.unescape(source[at:stop])
                if name == "title" and title is None:
                    title = inside
                if inside:
                    out.append(inside)
            if not close:
                break
            rest = _REST.match(source, close.end())
            if not rest:
                break
            at = text_from = rest.end()
        elif name in BLOCKS or name in SCOPES:
            open_.start(name)
    return "\n".join(out), title


def paragraphs_of(source: str | None) -> list[str] | None:
    """Stripped paragraphs of a page's text, between blank lines."""
    return None if source is None else _cut(page(source)[0])


def _cut(text: str) -> list[str]:
    return [p for p in map(str.strip, _BREAKS.sub("\n\n", text).split("\n\n")) if p]


def _page_row(source: str | None) -> tuple[str | None, list[str] | None]:
    if source is None:
        return None, None
    text, title = page(source)
    return (title or "").strip() or None, _cut(text)


def html_page(c: Column) -> Column:
    """``title, paragraphs`` of a page, parsed once, in Arrow batches; both null of null."""
    return F.pandas_udf(lambda s: pd.DataFrame([_page_row(x) for x in s], columns=PAGE.fieldNames()), PAGE)(c)


def html_paragraphs(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(paragraphs_of, na_action="ignore"), ArrayType(StringType()))(c)


def html_title(c: Column) -> Column:
    return html_page(c)["title"]
