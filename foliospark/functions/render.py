"""Structured values as text: JSON, rows, tables."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foliospark.functions.text import strip


def flat_lines(value, key: str = "") -> list[str]:
    """``a.b: value`` lines in the order of the source; lists as JSON, an empty object as one empty line."""
    if isinstance(value, dict):
        return [line for k, v in value.items() for line in flat_lines(v, f"{key}.{k}" if key else str(k))] or [""]
    return [f"{key}: {json.dumps(value, ensure_ascii=False) if isinstance(value, list) else value}"]


def item_text(value) -> str:
    """A top-level JSON item as text; a scalar as Python writes it."""
    return "\n".join(flat_lines(value)) if isinstance(value, (dict, list)) else str(value)


def _flattened(raw: str) -> str | None:
    try:
        return item_text(json.loads(raw))
    except (ValueError, RecursionError):
        return None


def flatten_json(c: Column) -> Column:
    """A JSON text flattened to lines; null where it is no JSON. Python, for the source's key order and its spelling of values."""
    return F.pandas_udf(lambda s: s.map(_flattened, na_action="ignore"), StringType())(c)


def row_text(columns: list[str]) -> Column:
    """``key: value | key: value`` over the values that are neither null nor empty."""
    parts = [F.when(F.col(c).cast("string") != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns]
    return F.concat_ws(" | ", *parts)


def table_text(rows: Column) -> Column:
    """An array of rows of cells: cells stripped and joined by `` | ``, rows by line feeds."""
    return F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda x: strip(x)), " | ")), "\n")


def ordered_text(order: list[str], value: str, sep: str) -> Column:
    """An aggregate: the values of a group in the order of columns, joined."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    return F.array_join(F.transform(rows, lambda r: r["_value"]), sep)


def metadata_map(metadata: Column) -> Column:
    """Provenance and ``extra`` in one map; a key of ``extra`` wins over a built-in one."""
    base = F.create_map(
        F.lit("source_path"), metadata["source_path"], F.lit("page_or_section"), metadata["page_or_section"], F.lit("timestamp"), metadata["timestamp"]
    )
    extra = F.coalesce(metadata["extra"], F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra)
