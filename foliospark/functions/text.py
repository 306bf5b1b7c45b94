"""Text transforms, ``Column -> Column``, in an order that matters.

Patterns run in the JVM; ``(?U)`` gives ``\\s``, ``\\d`` and ``\\S`` their Unicode
meaning and ``(?d)`` makes ``^`` and ``$`` heed line feeds only. The separators
U+001C to U+001F count as white space too. Only HTML entities, whose table no
built-in function has, go through Python, and only texts that hold a ``&``.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Transform = Callable[[Column], Column]
_S = r"[\s\x1c-\x1f]"

# What each transform takes out, as (pattern, replacement).
TAG = (r"<[^>]+>", " ")
LINK = (r"\[([^\]]+)\]\([^\)]+\)", "$1")
URL = (r"(?U)https?://[^\s\x1c-\x1f]+", "")
CONTROL = (r"[\p{C}&&[^\n\t]]", "")
PAGE_MARK = (rf"(?iU)page{_S}+\d+{_S}*(of{_S}+\d+)?", "")
NUMBER_LINE = (rf"(?mdU)^{_S}*\d{{1,4}}{_S}*$", "")
# Runs that are not one space already: a single one is let stand, for texts are full of them.
BLANKS = (r"(?U) [\s\x1c-\x1f&&[^\n]]+|[\s\x1c-\x1f&&[^\n ]][\s\x1c-\x1f&&[^\n]]*", " ")
LINE_FEEDS = (r"\n{3,}", "\n\n")
EDGES = (rf"(?U)\A{_S}+|{_S}+\z", "")
SENTENCE = rf"(?U)(?<=[.!?]){_S}+(?=[A-Z])"
PARAGRAPH = r"\n{2,}"
# Markdown syntax, in the order it is taken out.
MARKDOWN = (
    (r"!\[([^\]]*)\]\([^\)]+\)", "$1"),
    (r"\[([^\]]+)\]\([^\)]+\)", "$1"),
    (rf"(?U)#{{1,6}}{_S}*", ""),
    (r"[*_]{1,3}([^*_]+)[*_]{1,3}", "$1"),
    (r"`{1,3}[^`]*`{1,3}", ""),
    (rf"(?mdU)^>{_S}?", ""),
    (rf"(?mdU)^[-*+]{_S}", ""),
    (rf"(?mdU)^\d+\.{_S}", ""),
    (r"(?md)^---+$", ""),
)


def _sub(c: Column, *rules: tuple[str, str]) -> Column:
    return reduce(lambda col, rule: F.regexp_replace(col, rule[0], rule[1]), rules, c)


def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def strip_html_entities(c: Column) -> Column:
    """Named, numeric and cp1252 references as HTML5 reads them."""
    made = F.pandas_udf(_unescape, StringType())(F.when(F.contains(c, F.lit("&")), c))
    return F.coalesce(made, c)


def strip_html_tags(c: Column) -> Column:
    return _sub(c, TAG)


def strip_markdown_links(c: Column) -> Column:
    return _sub(c, LINK)


def strip_urls(c: Column) -> Column:
    return _sub(c, URL)


def strip_control_chars(c: Column) -> Column:
    """Characters of category C but line feed and tab, by the JVM's Unicode version."""
    return _sub(c, CONTROL)


def _no_control(text: str) -> str:
    return "".join(x for x in text if x in "\n\t" or unicodedata.category(x)[0] != "C")


def strip_control_chars_exact(c: Column) -> Column:
    """The same by Python's newer Unicode tables; only texts with a character beyond the basic plane or of category C leave the JVM."""
    odd = F.when(c.rlike(r"[\p{C}\x{10000}-\x{10FFFF}]"), c)
    return F.coalesce(F.pandas_udf(lambda s: s.map(_no_control, na_action="ignore"), StringType())(odd), c)


def strip_pdf_artefacts(c: Column) -> Column:
    return _sub(c, PAGE_MARK, NUMBER_LINE)


def strip(c: Column) -> Column:
    """Unicode white space off both ends; ``trim`` would take ASCII spaces only."""
    return _sub(c, EDGES)


def collapse_whitespace(c: Column) -> Column:
    """Once blanks are spaces, spaces and line feeds are all the white space there is, and a plain trim strips it."""
    return F.btrim(_sub(c, BLANKS, LINE_FEEDS), F.lit(" \n"))


def strip_markdown(c: Column) -> Column:
    return _sub(c, *MARKDOWN)


def is_empty(c: Column) -> Column:
    """Null, or nothing but white space."""
    return ~F.coalesce(c.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


#: The default chain.
DEFAULT: tuple[Transform, ...] = (
    strip_html_entities,
    strip_html_tags,
    strip_markdown_links,
    strip_urls,
    strip_control_chars,
    strip_pdf_artefacts,
    collapse_whitespace,
)


def as_transform(f: Transform | Callable[[str], str], python: bool = False) -> Transform:
    """A ``str -> str`` callable as a transform (Arrow batches); a column function as it is."""
    if not python:
        return f
    return lambda c: F.pandas_udf(lambda s: s.map(f, na_action="ignore"), StringType())(c)


def normalize(c: Column, chain: tuple[Transform, ...] | None = None) -> Column:
    """Fold the chain over a column; ``None`` is the default chain, an empty one changes nothing."""
    return reduce(lambda col, f: f(col), DEFAULT if chain is None else chain, c)


def paragraphs(c: Column) -> Column:
    """Stripped, non-blank paragraphs."""
    return F.filter(F.transform(F.split(c, PARAGRAPH), strip), lambda p: p != "")


def sentences(c: Column) -> Column:
    """Stripped, non-blank sentences: cut after ``.!?`` before an ASCII capital."""
    return F.filter(F.transform(F.split(c, SENTENCE), strip), lambda s: s != "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, rf"(?U){_S}+"), lambda w: w != "")


def lines_kept(c: Column) -> Column:
    """Lines with their line feeds, all line ends as line feeds first; no empty last one."""
    unix = F.regexp_replace(c, "\r\n?", "\n")
    return F.filter(F.split(unix, "(?<=\n)"), lambda x: x != "")


def line_buckets(c: Column, size: int = 200) -> Column:
    """A text in buckets of ``size`` lines, unstripped, by slices of the array of lines: no shuffle."""

    def made(lines: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(lines) / size).cast("int") - 1))
        parts = F.transform(starts, lambda i: F.array_join(F.slice(lines, i * size + 1, size), ""))
        return F.when(F.size(lines) > 0, parts).otherwise(F.array().cast("array<string>"))

    # A transform over one element binds the lines, which the lambda would otherwise split again for each bucket.
    return F.flatten(F.transform(F.array(lines_kept(c)), made))
