"""Token counts: the word heuristic as a native expression, exact ones under a vocabulary file as an Arrow UDF.

A tokenizer is named ``words`` (the heuristic), by the path of a file of ranks
that every executor can read, or by a name whose file ``<name>.tiktoken`` is in
the folder of ``Settings.tokenizer_files``.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Fixed value: tokens a word counts for.
PER_WORD = 1.3
WORDS = "words"
# How byte-level vocabularies cut texts before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PATTERNS = {"cl100k_base": r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}++|\p{N}{1,3}+| ?[^\s\p{L}\p{N}]++[\r\n]*+|\s++$|\s*[\r\n]|\s+(?!\S)|\s"}


def estimated(c: Column) -> Column:
    """``floor(1.3 * words)`` of a text; null of null."""
    return F.floor(F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+")) * F.lit(PER_WORD)).cast("int")


def tokenizer_path(name: str, folder: str = "") -> str:
    """``words``, or the file of a tokenizer; one that is not there is refused, not replaced by the heuristic."""
    if name == WORDS:
        return WORDS
    path = name if "/" in name else os.path.join(folder, f"{name}.tiktoken")
    if not os.path.isfile(path):
        raise FileNotFoundError(f"tokenizer {name!r}: no file {path}")
    return path


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = PATTERNS.get(os.path.basename(path).removesuffix(".tiktoken"), PATTERN)
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def sizer(path: str = WORDS) -> Callable[[str], int]:
    """Tokens of one text, for code that runs in Python; one encoder for each Python worker and file."""
    if path == WORDS:
        return lambda t: int(len(t.split()) * PER_WORD)
    encoding = _encoding(path)
    return lambda t: len(encoding.encode_ordinary(t))


def exact(c: Column, path: str) -> Column:
    """Tokens under a vocabulary of ranks that every executor can read; null of null."""
    return F.pandas_udf(lambda texts: texts.map(sizer(path), na_action="ignore").astype("Int32"), IntegerType())(c)


def counted(c: Column, path: str = WORDS) -> Column:
    return estimated(c) if path == WORDS else exact(c, path)
