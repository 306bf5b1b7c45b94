"""Induces the rule list of problem 9 by incremental reduced-error pruning (IREP).

    python -m foliospark.llm.quality_training DATA_DIR

There are no labels in the tables. ``annotate`` gives those that rules grow on:
it reads a text block by block with rules of its own and shares nothing with the
statistics that the rules see. Documents that people labelled (``HAND``, by
their ids) are kept out of it and measure annotator and list alike; a tenth of
the rest grows no rule either. At most ``MOST_DOCUMENTS`` documents are used,
those of the lowest hash; they are picked by Spark.
"""

from __future__ import annotations

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.prose_quality import FORM, STATISTICS, common_in, measure
from foliospark.storage import table

MOST_DOCUMENTS = 40_000
#: How many rows rightly covered a wrongly covered one outweighs when a rule is pruned.
WRONG = 4
DRAWS = 16
NAMES = STATISTICS + FORM
#: What rules may use: nothing that goes up or down with a text's length alone.
USABLE = tuple(n for n in NAMES if n not in ("words", "distinct_words"))
#: That a text has few signs or figures tells nothing: prose may have none.
SIGNS = ("symbol_ratio", "digit_ratio", "odd_signs", "sentences_per_word", "punctuated_lines")
#: Lines said again tell junk, not the form of a text.
FOR_FORM = tuple(n for n in USABLE if n != "repeated_lines")
Rule = tuple[str, list[tuple[str, str, float]]]

# Patterns of the annotator; it shares none with the statistics that the rules see.
_SENTENCE_END = re.compile(r"[.!?…:]['\"»”’)]*$")
_CELLS = (re.compile(r"\s*\|\s*"), re.compile(r"\t"), re.compile(r";(?! )"), re.compile(r",(?! )"), re.compile(r" {2,}"))
_MARKER = re.compile(r"(?:\[[ xX]?\]|[^\w\s\"'“«„(¿¡#|<>{}\\/=\[\]]{1,2}|\(?\w{1,3}[.)]|\d\d)\s+(?=\S)")
_DOTS = re.compile(r"(?:\.\s?){4,}\s*\d+$")
_FIELD = re.compile(r"[^\W\d_][^:|]{0,30}:\s\S")
_WORDS = re.compile(r"[^\W\d_]+")
_CRUMB = re.compile(r"\s[|/>»·]\s")
_PAIRED = re.compile(r"\S+(?:\s\S+){0,5}\s[–—-]\s\S+(?:\s\S+){0,7}$")
_LOG = re.compile(r"\d{4}-\d\d-\d\d[T ]\d\d:\d\d|\[?\d\d:\d\d:\d\d|(?:0x)?[0-9a-f]{6,}\s")
_FULL_STOPS = re.compile(r"[.!?…](?:\s|$)")


def _cells(line: str) -> int:
    return max(len(sep.split(line.strip("|"))) for sep in _CELLS)


def _noisy(text: str) -> bool:
    """Signs strewn in, or one endless run of them."""
    odd = sum(not c.isalnum() and c not in " .,;:!?'\"()/’‘“”„«»%€£°*•–—-+&…|\t¿¡#" for c in text)
    return odd > 0.07 * (len(text) - text.count(" ")) or max(map(len, text.split()), default=0) > 40 and " " not in text.strip()


def _lettered(line: str) -> bool:
    return 2 * sum(map(str.isalnum, line)) > len(line.replace(" ", ""))


def _paragraph(lines: list[str], at: int) -> tuple[int, str]:
    """(last line, text) of what a line runs on into."""
    end, text = at, lines[at]
    while not _SENTENCE_END.search(lines[end]) and end + 1 < len(lines) and len(lines[end].split()) > 3 and _cells(lines[end + 1]) <= 2 and not _MARKER.match(lines[end + 1]) and (lines[end + 1][0].islower() or len(lines[end]) > 45):
        end += 1
        text += " " + lines[end]
    return end, text


def _spoken(text: str, common: set[str]) -> bool:
    """Words with grammar: common ones between them, sentences, no pair of words over and over."""
    words = [w.lower() for w in _WORDS.findall(text)]
    if len(words) < 8:
        return True
    share = sum(w in common for w in words) / len(words)
    if share < 0.035 or len(words) > 20 and share < 0.08 and not _FULL_STOPS.search(text):
        return False
    return len(words) <= 20 or Counter(zip(words, words[1:])).most_common(1)[0][1] <= 0.2 * len(words)


def annotate(text: str, common: set[str]) -> str:
    """``prose``, ``list``, ``table`` or ``junk``: what most characters of the text belong to.

    Blocks between blank lines are read with their neighbours: a row is one of a
    table if the rows about it have as many cells, a paragraph is put together
    from the lines that run on, and judged as a whole.
    """
    size: Counter[str] = Counter()
    menu, menu_signs = 0, False
    blocks: list[list[str]] = [[]]
    for raw in text.split("\n"):
        if line := raw.strip():
            blocks[-1].append(line)
        elif blocks[-1]:
            blocks.append([])
    every = [line for b in blocks for line in b]
    if not every or len(every) > 4 and len(set(every)) < 0.15 * len(every):
        return "junk"
    for lines in filter(None, blocks):
        cells = list(map(_cells, lines))
        i = 0
        while i < len(lines):
            line, n = lines[i], len(lines[i])
            crumbs = len(_CRUMB.findall(line))
            few = len(line.split()) <= 4 * cells[i]
            near = [cells[k] for k in (i - 1, i + 1) if 0 <= k < len(lines)]
            marked = _MARKER.match(line)
            body = line[marked.end() :] if marked else line
            if _LOG.match(line):
                size["junk"] += n
            elif crumbs and not any(map(str.isdigit, line)) and not line.startswith("|") and len(_WORDS.findall(line)) <= 2.2 * (crumbs + 1) and _lettered(line):
                menu += n
                menu_signs = menu_signs or bool(re.search(r"\s[/>»·]\s", line))
            elif few and _lettered(line) and not _noisy(re.sub(r"[|,;\t]+", " ", line)) and (cells[i] > 3 or cells[i] > 2 and (any(k > 1 and k >= cells[i] - 2 for k in near) or "|" in line or "\t" in line) or cells[i] == 2 and ("|" in line or "\t" in line)):
                size["table"] += n
            elif _noisy(line) and not (marked and not _noisy(body)):
                size["junk"] += n
            elif marked and (len(body.split()) < 12 or not _SENTENCE_END.search(body)) and not (line[0] in "—–" and len(body.split()) > 7) or _DOTS.search(line):
                size["list"] += n
            else:
                end, whole = _paragraph(lines, i)
                words, commas = _WORDS.findall(whole), len(re.findall(r"[,;](?: |$)", whole))
                closed = bool(_SENTENCE_END.search(whole))
                if commas > 1 and len(whole.split()) <= 1.8 * (commas + 1):
                    kind = "list"
                elif len(words) < 7 and not (closed and len(words) > 3) and len(whole) < 60:
                    kind = "table" if _FIELD.match(whole) and not closed else "list"
                elif _PAIRED.match(whole) and len(words) < 10:
                    kind = "list"
                else:
                    kind = "prose" if _spoken(whole, common) else "junk"
                size[kind] += len(whole)
                i = end
            i += 1
    # Bare words between bars alone are rows of a table.
    size["junk" if menu_signs else "table"] += menu
    rest = {k: v for k, v in size.items() if k != "prose" and v}
    return "prose" if size["prose"] > sum(rest.values()) or not rest else max(rest, key=rest.get)


def _covers(conditions: list[tuple[str, str, float]], row: tuple[float, ...]) -> bool:
    return all(row[NAMES.index(n)] > v if op == ">" else row[NAMES.index(n)] <= v for n, op, v in conditions)


def _grow(pos: list, neg: list, usable: tuple[str, ...] = USABLE) -> list[tuple[str, str, float]]:
    """Add the condition of most information gain (FOIL) until no negative is covered."""
    conditions: list[tuple[str, str, float]] = []
    while neg and len(conditions) < 6:
        p0, n0 = len(pos), len(neg)
        base = math.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for name in usable:
            i = NAMES.index(name)
            marked = sorted([(r[i], 1) for r in pos] + [(r[i], 0) for r in neg])
            p = n = 0
            for k, (value, is_pos) in enumerate(marked[:-1]):
                p, n = p + is_pos, n + 1 - is_pos
                after = marked[k + 1][0]
                if after == value:
                    continue
                cut = round((value + after) / 2, 4)
                if not value <= cut < after:
                    continue
                for op, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
                    if op == "<=" and name in SIGNS:
                        continue
                    if pp and (g := pp * (math.log2(pp / (pp + nn)) - base)) > gain:
                        best, gain = (name, op, cut), g
        if best is None:
            break
        conditions.append(best)
        pos, neg = [r for r in pos if _covers([best], r)], [r for r in neg if _covers([best], r)]
    return conditions


def _prune(conditions: list, pos: list, neg: list) -> list:
    """Drop final conditions as long as more unseen rows come out right; of equals the strictest stays, for it errs least on what was not seen."""

    def worth(c: list) -> int:
        return sum(_covers(c, r) for r in pos) - WRONG * sum(_covers(c, r) for r in neg)

    best = max(range(len(conditions), 0, -1), key=lambda k: (worth(conditions[:k]), k))
    return conditions[:best]


def irep(rows: list[tuple[tuple[float, ...], str]], seed: int = 7) -> list[Rule]:
    """Ordered rules, junk first, for its texts can look like any other kind; a rule wrong on more than half of unseen rows ends its kind."""
    rng = random.Random(seed)
    rules: list[Rule] = []
    left = list(rows)
    for kind in ("junk", "table", "list"):
        while True:
            rng.shuffle(left)
            third = len(left) // 3
            held, used = left[:third], left[third:]
            pos = [r for r, k in used if k == kind]
            if not pos:
                break
            conditions = _grow(pos, [r for r, k in used if k != kind], USABLE if kind == "junk" else FOR_FORM)
            hp, hn = [r for r, k in held if k == kind], [r for r, k in held if k != kind]
            conditions = _prune(conditions, hp, hn) if conditions else []
            p, n = sum(_covers(conditions, r) for r in hp), sum(_covers(conditions, r) for r in hn)
            if not conditions or p <= n:
                break
            rules.append((kind, conditions))
            left = [(r, k) for r, k in left if not _covers(conditions, r)]
    return rules


def decide(rules: list[Rule], row: tuple[float, ...]) -> str:
    return "junk" if not row[0] else next((kind for kind, c in rules if _covers(c, row)), "prose")


def picked(documents: DataFrame, without: set[int]) -> list[tuple[int, str]]:
    """(id, text) of at most ``MOST_DOCUMENTS`` documents, those of the lowest hash, but for ``without``."""
    some = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(~F.col("doc_id").isin(sorted(without)))
    return [(r["doc_id"], r["text"]) for r in some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_DOCUMENTS).collect()]


def main(folder: str, hand: dict[int, str]) -> None:
    spark = SparkSession.builder.getOrCreate()
    documents = table(spark, folder, "documents", ["doc_id", "text"])
    known = common_in(table(spark, folder, "common_words"))
    rows = [(measure(t, known), annotate(t, set(known))) for _, t in picked(documents, set(hand))]
    tenth = len(rows) // 10
    held, rest = rows[:tenth], rows[tenth:]
    # The pruning set is drawn at random: of some draws, the list that is best on all it was made from.
    rules = max((irep(rest, seed) for seed in range(DRAWS)), key=lambda made: (sum(decide(made, r) == k for r, k in rest), -sum(len(c) for _, c in made)))
    print(f"{len(rules)} rules; as the annotator says for {sum(decide(rules, r) == k for r, k in held)} of {len(held)} held-out documents")
    read = {r["doc_id"]: r["text"] or "" for r in documents.where(F.col("doc_id").isin(sorted(hand))).collect()}
    print(f"as people say: rules {sum(decide(rules, measure(read[i], known)) == k for i, k in hand.items())}, annotator {sum(annotate(read[i], set(known)) == k for i, k in hand.items())} of {len(hand)}")
    body = "\n".join(f"    ({kind!r}, {conditions!r})," for kind, conditions in rules)
    Path(__file__).with_name("quality_rules.py").write_text(f'"""The rule list that ``quality_training`` induced; written by it."""\n\n# fmt: off\nRULES: list[tuple[str, list[tuple[str, str, float]]]] = [\n{body}\n]\n')


if __name__ == "__main__":
    from foliospark.llm.quality_labels import HAND

    main(sys.argv[1], HAND)
