"""Texts into chunks of a token budget: greedy packing of sentences with overlap.

Whether a text fits is decided by a native expression (or, under a vocabulary,
an Arrow count); only texts above the budget go on. Packing is a fold with state
that looks back, which a lambda in the JVM can only do by copying its arrays at
each step; so the sentences, cut in the JVM, are packed in Arrow batches, in
time linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from foliospark.functions import text as T
from foliospark.functions import tokens as K


def word_parts(text: str, budget: int, size: Callable[[str], int]) -> list[str]:
    """A text of words only: words one by one until the next would exceed the budget; a word above it is a part of its own."""
    parts: list[list[str]] = []
    room = 0
    for word in text.split():
        cost = size(word)
        if not parts or cost > room:
            parts.append([])
            room = budget
        parts[-1].append(word)
        room -= cost
    return [" ".join(p) for p in parts]


def packed(sentences: list[str], budget: int, overlap: int, size: Callable[[str], int], strict: bool = False) -> list[str]:
    """Chunks of consecutive sentences; sentences above the budget are cut by words.

    A full chunk hands its last sentences on, as many as fit the overlap; with
    that a chunk may exceed the budget. ``strict`` hands on no more than leaves
    room for the next sentence, and makes parts that fit when counted whole.
    """
    part = max(1, (10 * budget + 9) // 13) if strict else budget
    sizes = [size(s) for s in sentences]
    out: list[str] = []
    first, held = 0, 0  # the open chunk: sentences from ``first``, of so many tokens
    for i, n in enumerate(sizes):
        if n > budget:
            if first < i:
                out.append(" ".join(sentences[first:i]))
            out += word_parts(sentences[i], part, size)
            first, held = i + 1, 0
            continue
        if held + n > budget:
            out.append(" ".join(sentences[first:i]))
            room = min(overlap, budget - n) if strict else overlap
            start, held = i, 0
            while start > first and held + sizes[start - 1] <= room:
                start -= 1
                held += sizes[start]
            first = start
        held += n
    if first < len(sentences):
        out.append(" ".join(sentences[first:]))
    return out


def hard_split(c: Column, budget: int, tokenizer: str = K.WORDS) -> Column:
    """An array of parts of so many tokens, word by word; empty for a blank text, null of null."""

    def cut(texts: pd.Series) -> pd.Series:
        size = K.sizer(tokenizer)
        return texts.map(lambda t: word_parts(t, budget, size), na_action="ignore")

    return F.pandas_udf(cut, ArrayType(StringType()))(c)


def with_chunks(df: DataFrame, budget: int, overlap: int, text: str = "text", strict: bool = False, into: str = "chunks", tokenizer: str = K.WORDS) -> DataFrame:
    """The columns of ``df`` and an array of chunks; a text within the budget is its only chunk, untouched; null of null."""
    if budget <= 0:
        raise ValueError("the budget must be positive")

    def cut(arrays: pd.Series) -> pd.Series:
        size = K.sizer(tokenizer)
        return arrays.map(lambda s: packed(list(s), budget, overlap, size, strict), na_action="ignore")

    c = F.col(f"`{text}`")
    # Columns of their own on the way: a text is counted and cut once.
    staged = df.withColumn("_fits", K.counted(c, tokenizer) <= budget)
    staged = staged.withColumn("_packed", F.pandas_udf(cut, ArrayType(StringType()))(F.when(~F.col("_fits"), T.sentences(c))))
    return staged.withColumn(into, F.when(~F.col("_fits"), F.col("_packed")).when(c.isNotNull(), F.array(c))).drop("_fits", "_packed")


def chunked(df: DataFrame, budget: int, overlap: int, text: str = "text", strict: bool = False, tokenizer: str = K.WORDS) -> DataFrame:
    """One row per chunk: the other columns, ``chunk_index`` anew for each row, and the chunk in place of the text; a null text gives none."""
    rest = [F.col(f"`{x}`") for x in df.columns if x not in (text, "chunk_index")]
    # Outer, and the nulls dropped after: for an inner one Catalyst infers a filter on the array, which computes it twice.
    cut = with_chunks(df, budget, overlap, text, strict, "_chunks", tokenizer).select(*rest, F.posexplode_outer("_chunks").alias("chunk_index", text))
    return cut.where(F.col("chunk_index").isNotNull())
