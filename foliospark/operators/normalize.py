"""Fragments cleaned by a chain of transforms; the empty ones dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.storage import once


def normalized(df: DataFrame, chain: tuple[T.Transform, ...] | None = None, text: str = "text", keep_empty: bool = False) -> DataFrame:
    """All columns, ``text`` cleaned; rows left without text are dropped unless asked for."""
    out = df.withColumn(text, once(T.normalize(F.col(f"`{text}`"), chain)))
    return out if keep_empty else out.where(~T.is_empty(F.col(f"`{text}`")))
