"""Problem 9: per-document statistics, and which documents are not natural prose.

One Arrow pass measures each whole text. Which documents are no prose is decided
by an ordered rule list over those statistics. ``quality_training`` induced it
by incremental reduced-error pruning; its thresholds stand in ``quality_rules``
and are applied as one native CASE expression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.quality_rules import RULES
from foliospark.storage import table

#: The statistics that are asked for, then those of the text's form; all are doubles. Shares are of the characters of all lines, but for those of lines and words.
STATISTICS = ("words", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words")
FORM = ("digit_ratio", "delimited", "named", "marked", "entries", "short", "listed", "coded", "prose", "continued", "sentences_per_word", "distinct_words", "repeated_pairs", "menu", "odd_signs", "repeated_lines")

_RUN = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"\d")
_SENTENCE = re.compile(r"[.!?…][\"'»”’)]*(?:\s|\Z)")
_MARK = re.compile(r"(?:\[[ xX]?\]|[^\w\s\"'“”«»„()\[\]{}¿¡#|<>&=/\\]{1,2}|\(?(?:\d{1,3}|[a-zA-Zа-яА-Я]{1,2}|[ivxIVX]{1,4})[.)]|\d{2})\s+\S")
_LEADER = re.compile(r"(?:\.\s?){4,}\s*\d+$")
_NAMED = re.compile(r"^[^\W\d_][^:|=\t]{0,30}[:=]\s*\S")
_ENTRY = re.compile(r"^\S[^.!?]{0,40}\s[–—-]\s[^.!?]{1,60}$")
_GAPS = re.compile(r"\S {2,}(?=\S)")
_STAMP = re.compile(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d|^\[?\d\d:\d\d:\d\d|^(?:0x)?[0-9a-fA-F]{6,}\s")
_CLOSED = re.compile(r"[.!?:…][\"'»”’)\]]*$")
_PUNCTUATED = re.compile(r"[.!?…][\"'»”’)\]]*$")
_ITEMS = re.compile(r"[,;] ?")
_MENU = re.compile(r"\s[/>»·]\s")
_ODD = re.compile(r"[^\w\s.,;:!?'\"()|/’‘“”«»„%€£°#*•¡¿&+…–—\-]|_")
_ROW = re.compile(r"\s\|\s")


def line_kind(line: str, tokens: list[str], going_on: bool, odd: int | None = None) -> str:
    """What a line looks like by itself; ``going_on``: the line before was prose that had not closed; ``odd``: its signs that texts lack, if counted."""
    n, k = len(line), len(tokens)
    if _STAMP.match(line):
        return "coded"
    if not going_on and len(_MENU.findall(line)) > 1 and not _DIGIT.search(line):
        return "menu"
    marked = _MARK.match(line)
    odd = len(_ODD.findall(line)) if odd is None else odd
    if odd > 0.08 * n and (not marked or len(_ODD.findall(line, marked.end() - 1)) > 0.08 * n):
        return "coded"
    tight = 0 if going_on else line.count(",") + line.count(";") - line.count(", ") - line.count("; ")
    if tight > 1 and k <= tight + 1:
        return "delimited"
    if max(map(len, tokens)) > 45 or k > 7 and sum(map(len, tokens)) < 2.6 * k and sum(c.isdigit() for c in line) > n / 4:
        return "coded"
    pipes, tabs = line.count("|"), line.count("\t")
    if tabs or pipes > 1 or pipes == 1 and k < 9:
        parts = [p for p in line.split("|") if p.strip()]
        if pipes and parts and all(_NAMED.match(p.strip()) for p in parts):
            return "named"
        return "delimited"
    if len(_GAPS.findall(line)) > 1 and k < 14:
        return "delimited"
    if marked:
        return "marked" if k < 12 or not _CLOSED.search(line) else "prose"
    if _LEADER.search(line):
        return "marked"
    if not going_on:
        seps = len(_ITEMS.findall(line))
        if seps > 1:
            if k <= 1.7 * (seps + 1):
                return "listed"
        if k < 9 and _NAMED.match(line) and not _CLOSED.search(line):
            return "named"
        if k < 10 and _ENTRY.match(line):
            return "entry"
    if going_on or k >= 7 or k >= 4 and n >= 38 or _CLOSED.search(line) and k > 3:
        return "prose"
    return "short"


def measure(text: str, languages_of: dict[str, tuple[int, ...]]) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS`` and ``FORM``.

    A blank text measures 0 throughout. Words are runs without white space;
    symbols are what is neither letter nor digit; the common words are those of
    the language that has most of them here.
    """
    tokens = text.split()
    n = len(tokens)
    if not n:
        return (0.0,) * (len(STATISTICS) + len(FORM))
    solid = sum(map(len, tokens))
    runs = _RUN.findall(text.lower())
    letters = sum(map(len, runs))
    counted = Counter(runs)
    digits = sum([times * sum(map(str.isdecimal, w)) for w, times in counted.items() if not w.isalpha()])
    votes: dict[int, int] = {}
    for word in counted.keys() & languages_of.keys():
        for lang in languages_of[word]:
            votes[lang] = votes.get(lang, 0) + counted[word]
    repeated = max(Counter(zip(runs, runs[1:])).values(), default=1) - 1
    seen: set[str] = set()
    again = 0
    shares = dict.fromkeys(("coded", "delimited", "named", "marked", "entry", "short", "listed", "prose", "menu"), 0)
    lines = closed = continued = whole = rows = odd = 0
    going_on = False
    for raw in text.split("\n"):
        line = raw.strip()
        if not line:
            going_on = False
            continue
        words = line.split()
        lines += 1
        ended = bool(_CLOSED.search(line))
        closed += ended and bool(_PUNCTUATED.search(line))
        odd_here = 0 if line.isascii() and line.isalnum() else len(_ODD.findall(line))
        odd += odd_here
        kind = line_kind(line, words, going_on, odd_here)
        continued += going_on and line[0].islower()
        whole += len(line)
        if line in seen:
            again += len(line)
        else:
            seen.add(line)
        shares[kind] += len(line)
        if kind == "delimited" and not _DIGIT.search(line) and _ROW.search(line):
            rows += len(line)
        going_on = kind == "prose" and not ended
    if shares["menu"]:  # rows of words without a figure are menus where other lines are
        shares["menu"] += rows
        shares["delimited"] -= rows
    return (
        float(n), solid / n, (solid - letters) / solid, closed / lines, max(votes.values(), default=0) / max(1, len(runs)),
        digits / solid, *[shares[k] / whole for k in ("delimited", "named", "marked", "entry", "short", "listed", "coded", "prose")],
        continued / lines, len(_SENTENCE.findall(text)) / n, len(counted) / max(1, len(runs)), repeated / max(1, len(runs)), shares["menu"] / whole, odd / solid, again / whole,
    )


def common_in(common_words: DataFrame) -> dict[str, tuple[int, ...]]:
    """Word -> numbers of the languages it is common in, of which there may be any number; a table of settings: more than 100,000 rows are refused."""
    rows = common_words.select("lang", "word").where("lang IS NOT NULL AND word IS NOT NULL").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("common_words is not a table of settings")
    return languages_of((r["lang"], r["word"]) for r in rows)


def languages_of(rows: Iterable[tuple[str, str]]) -> dict[str, tuple[int, ...]]:
    pairs = sorted({(word.lower(), lang) for lang, word in rows})
    order = {lang: i for i, lang in enumerate(sorted({lang for _, lang in pairs}))}
    out: dict[str, tuple[int, ...]] = {}
    for word, lang in pairs:
        out[word] = (*out.get(word, ()), order[lang])
    return out


def measured(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each document; a null text measures as a blank one, copies are measured each, empty tables give no rows."""
    known = common_in(common_words)
    names = STATISTICS + FORM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t or "", known) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.float64()) for c in (zip(*rows) if rows else [[]] * len(names))]], names=["doc_id", *names])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))


def case_expression(rules: list[tuple[str, list[tuple[str, str, float]]]]) -> str:
    """The ordered rules as SQL: the first whose conditions all hold names the kind."""
    whens = [f"WHEN {' AND '.join(f'{name} {op} {value!r}' for name, op, value in conditions)} THEN '{kind}'" for kind, conditions in rules]
    return f"CASE WHEN words = 0 THEN 'junk' {' '.join(whens)} ELSE 'prose' END"


def kind_of() -> Column:
    return F.expr(case_expression(RULES))


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "common_words"))


def p9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).select("doc_id", F.col("words").cast("long").alias("words"), *[F.round(c, 6).alias(c) for c in STATISTICS[1:]])


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).select("doc_id", kind_of().alias("kind")).where("kind <> 'prose'")


QUERIES = {"p9_found": p9_found, "p9_statistics": p9_statistics}
_FORM = r"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+') AS words, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS runs,
                  list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(regexp_replace(l, '^[\s\x{0b}\x{a0}]+', ''), '[\s\x{0b}\x{a0}]+$', '')), lambda l: l <> '') AS lines FROM documents),
n AS (SELECT *, list_sum(list_transform(words, lambda w: length(w))) AS solid, list_sum(list_transform(runs, lambda w: length(w))) AS letters FROM d),
c AS (SELECT doc_id, max(hits) AS hits FROM (SELECT doc_id, lang, count(*) AS hits FROM (SELECT doc_id, unnest(runs) AS word FROM n) JOIN (SELECT DISTINCT lang, lower(word) AS word FROM common_words) USING (word) GROUP BY doc_id, lang) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS words, round(coalesce(solid / len(words), 0), 6) AS mean_word_length, round(coalesce((solid - coalesce(letters, 0)) / solid, 0), 6) AS symbol_ratio,
       round(coalesce(len(list_filter(lines, lambda l: regexp_matches(l, '[.!?…]["''»”’)\]]*$'))) / len(lines), 0), 6) AS punctuated_lines, round(coalesce(hits / greatest(1, len(runs)), 0), 6) AS common_words
FROM n LEFT JOIN c USING (doc_id)
"""
SQL: dict[str, str] = {"p9_statistics": _FORM}
