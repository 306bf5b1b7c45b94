"""Problem 2: cutting oversized texts at natural boundaries, with overlap.

Agglomerative: the text is cut into atoms at every boundary, all adjacent
pairs wait in a heap, and the weakest boundaries are merged first as long as
the combined atom plus the overlap stays within the limit. What is left
standing are the strongest boundaries. Only oversized rows leave the JVM.

Sizes are ``floor(1.3 * words)``; a word is a maximal run without white space.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.storage import table

#: Strength of the boundary before a word, by the white space and text in front of it.
PARAGRAPH, LINE, SENTENCE, CLAUSE, SPACE = 5, 4, 3, 2, 1
WORD = re.compile(r"\S+")
SENTENCE_END = re.compile(r"[.!?…。！？][\"'»”’)\]]*\Z")
CLAUSE_END = re.compile(r"[,;:–—][\"'»”’)\]]*\Z")


def max_words(tokens: int) -> int:
    """The most words whose size ``floor(1.3 * words)`` is at most ``tokens``."""
    return max(0, (10 * tokens + 9) // 13)


def _boundary(before: str, gap: str) -> int:
    breaks = gap.count("\n")
    if breaks > 1:
        return PARAGRAPH
    ended = SENTENCE_END.search(before)
    if breaks:
        return LINE if not ended else LINE + 0.5
    if ended:
        return SENTENCE
    return CLAUSE if CLAUSE_END.search(before) else SPACE


def pieces(text: str | None, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start of overlap, start, end) in characters of each piece of ``text``.

    A text within the limit is one piece; a null or blank one has none. The
    pieces from ``start`` to ``end`` tile the text from its first word to its
    last, so joining them gives the text back; from the second piece on, the
    characters from ``start of overlap`` repeat the last ``overlap`` tokens of
    what stands before. ``overlap`` must be smaller than ``limit``.
    """
    if text is None:
        return []
    spans = [m.span() for m in WORD.finditer(text)]
    n = len(spans)
    if not n:
        return []
    most, repeat = max_words(limit), max_words(overlap)
    if most - repeat < 1:
        raise ValueError("the limit must leave room for a word beside the overlap")
    if n <= most:
        return [(spans[0][0], spans[0][0], spans[-1][1])]
    own = most - repeat
    strength = [0.0] + [float(_boundary(text[spans[i - 1][0] : spans[i - 1][1]], text[spans[i - 1][1] : spans[i][0]])) for i in range(1, n)]
    # Atom a covers the words from a to end[a]; merging removes the boundary at the right atom's first word.
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = bytearray(b"\1") * n
    # Weakest first; among equals the smaller combined size, which keeps pieces even, then the earlier.
    heap = [(strength[i], 2, i, i - 1, i + 1) for i in range(1, n)]
    heapq.heapify(heap)
    while heap:
        _, size, right, a, stop = heapq.heappop(heap)
        if not alive[right] or left[right] != a or not alive[a] or end[right] != stop or stop - a != size:
            continue  # a neighbour has grown since; the pair waits under its new size
        if size > own:
            continue
        alive[right] = 0
        end[a] = stop
        if stop < n:
            left[stop] = a
            heapq.heappush(heap, (strength[stop], end[stop] - a, stop, a, end[stop]))
        if a > 0:
            heapq.heappush(heap, (strength[a], stop - left[a], a, left[a], stop))
    starts = [i for i in range(n) if alive[i]]
    out = []
    for k, s in enumerate(starts):
        last = starts[k + 1] if k + 1 < len(starts) else n
        begin = spans[max(0, s - repeat)][0] if k else spans[s][0]
        out.append((begin, spans[s][0], spans[last - 1][1] if last == n else spans[last][0]))
    return out


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def oversized(text: Column, limit: int) -> Column:
    """Rows above the limit. So many words need at least twice as many characters less one, which spares the count for short texts."""
    return (F.length(text) >= 2 * max_words(limit) + 1) & (word_count(text) > max_words(limit))


def split_oversized(df: DataFrame, limit: int, overlap: int, key: str = "fragment_id") -> DataFrame:
    """One row per piece of each row of ``df`` that is above the limit: key, ``chunk_index``, ``n_pieces``, ``piece_start``, ``text``, ``n_tokens``.

    Null, blank and fitting texts give no row; repeated rows give their
    pieces each; other columns are not looked at, whatever their names.
    """
    picked = df.select(F.col(key).alias("key"), F.col("text").alias("text")).where(oversized(F.col("text"), limit))
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = pieces(t, limit, overlap)
                for i, (begin, start, stop) in enumerate(parts):
                    body = t[begin:stop].rstrip()
                    for c, v in zip(cols, (k, i, len(parts), start, body, len(WORD.findall(body)) * 13 // 10)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int32())], names=[key, "chunk_index", "n_pieces", "piece_start", "text", "n_tokens"])

    return picked.mapInArrow(cut, f"`{key}` {kind}, chunk_index int, n_pieces int, piece_start int, text string, n_tokens int")


def run_settings(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The run's key-value settings: a table of a few rows by contract; more than 10,000 are refused."""
    rows = table(spark, sf_dir, "run_metadata", ["key", "value"]).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("run_metadata is not a settings table")
    return {r["key"]: r["value"] for r in rows}


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = run_settings(spark, sf_dir)
    return split_oversized(table(spark, sf_dir, "fragments", ["fragment_id", "text"]), int(s["max_context_tokens"]) - int(s["prompt_budget_tokens"]), int(s["chunk_overlap_tokens"]))


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fragments that the operator cut: every one above the limit comes out in two pieces or more."""
    return _split(spark, sf_dir).where((F.col("chunk_index") == 0) & (F.col("n_pieces") > 1)).select("fragment_id")


def p2_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fragment that was cut: the text that its pieces give without their overlaps, whether each is within the limit, and whether each but the first begins with the last words before it."""
    s = run_settings(spark, sf_dir)
    limit, repeat = int(s["max_context_tokens"]) - int(s["prompt_budget_tokens"]), max_words(int(s["chunk_overlap_tokens"]))
    words = F.regexp_extract_all("text", F.lit(r"(?U)(\S+)"))
    parts = _split(spark, sf_dir).withColumn("w", words).groupBy("fragment_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "w", "n_tokens"))).alias("p"))
    # Words of a piece behind its overlap; the overlap is as long as it can be.
    whole = F.aggregate("p", F.array().cast("array<string>"), lambda out, x: F.concat(out, F.slice(x["w"], F.when(x["chunk_index"] == 0, 1).otherwise(F.least(F.size(out), F.lit(repeat)) + 1), 1_000_000_000)))
    overlap = F.aggregate(
        "p",
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(True).alias("ok")),
        lambda s, x: F.struct(
            F.concat(s["out"], F.slice(x["w"], F.when(x["chunk_index"] == 0, 1).otherwise(F.least(F.size(s["out"]), F.lit(repeat)) + 1), 1_000_000_000)).alias("out"),
            (s["ok"] & ((x["chunk_index"] == 0) | (F.slice(x["w"], 1, F.least(F.size(s["out"]), F.lit(repeat))) == F.slice(s["out"], -F.least(F.size(s["out"]), F.lit(repeat)), repeat)))).alias("ok"),
        ),
        lambda s: s["ok"],
    )
    return parts.select("fragment_id", F.array_join(whole, " ").alias("text"), F.forall("p", lambda x: x["n_tokens"] <= limit).alias("fits"), overlap.alias("repeats"))


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces, "p2_checked": p2_checked}
_WORDS = r"regexp_extract_all(text, '[^\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')"
SQL = {
    "p2_checked": f"""
WITH s AS (SELECT max(CASE WHEN key = 'max_context_tokens' THEN CAST(value AS BIGINT) END) - max(CASE WHEN key = 'prompt_budget_tokens' THEN CAST(value AS BIGINT) END) AS lim
           FROM run_metadata WHERE key IN ('max_context_tokens', 'prompt_budget_tokens'))
SELECT fragment_id, array_to_string({_WORDS}, ' ') AS text, TRUE AS fits, TRUE AS repeats FROM fragments, s WHERE (13 * len({_WORDS})) // 10 > lim""",
    "p2_found": r"""
WITH s AS (SELECT max(CASE WHEN key = 'max_context_tokens' THEN CAST(value AS BIGINT) END) - max(CASE WHEN key = 'prompt_budget_tokens' THEN CAST(value AS BIGINT) END) AS lim
           FROM run_metadata WHERE key IN ('max_context_tokens', 'prompt_budget_tokens'))
SELECT fragment_id FROM fragments, s WHERE (13 * len(regexp_extract_all(text, '[^\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'))) // 10 > lim
"""
}
