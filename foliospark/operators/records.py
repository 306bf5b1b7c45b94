"""Prompts, answers and training records."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from foliospark.functions.render import metadata_map

# Fixed value: the instruction that stands before a chunk.
INSTRUCTION = (
    "You are a dataset-generation assistant.  Given the following text excerpt, generate one high-quality question-and-answer pair "
    'suitable for instruction-tuning.  Return ONLY valid JSON with keys "instruction", "input", and "output".\n\n'
)
PARSED = StructType([StructField(n, StringType()) for n in ("instruction", "input", "output", "raw_json", "error_class")])
_OBJECT = re.compile(r"\{.*\}", re.S)
_FENCE = re.compile(r"```(?:json)?\s*")


def prompt(text: Column) -> Column:
    return F.concat(F.lit(INSTRUCTION + "---\n"), text, F.lit("\n---"))


def unfenced(raw: str) -> str:
    """Without Markdown fences and without back quotes at the end."""
    return "".join(part for part in _FENCE.split(raw)).strip().rstrip("`")


def extract_json(raw: str):
    """The JSON of a noisy answer: all of it, else from the first brace to the last, else the same without Markdown fences; ``ValueError`` if there is none."""
    for source in (raw, unfenced(raw)):
        for text in filter(None, (source, _braces(source))):
            try:
                return json.loads(text)
            except ValueError:
                pass
    raise ValueError("no JSON in the answer")


def _braces(text: str) -> str | None:
    found = _OBJECT.search(text)
    return found[0] if found else None


def _as_text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def parse_answer(raw: str | None) -> dict[str, str | None]:
    """One answer as an Alpaca record.

    An answer without JSON becomes the output of a record without instruction;
    JSON that is no object is marked malformed. Unknown keys stay in ``raw_json``.
    """
    if raw is None:
        return dict.fromkeys(PARSED.fieldNames()) | {"error_class": "LLMMalformedResponse"}
    try:
        value = extract_json(raw)
    except ValueError:
        return {"instruction": "", "input": "", "output": raw, "raw_json": None, "error_class": None}
    if not isinstance(value, dict):
        return dict.fromkeys(PARSED.fieldNames()) | {"raw_json": _as_text(value), "error_class": "LLMMalformedResponse"}
    return {k: _as_text(value.get(k)) for k in ("instruction", "input", "output")} | {"raw_json": json.dumps(value, ensure_ascii=False), "error_class": None}


def parse_answers(raw: Column, parser: Callable[[str | None], dict] | None = None) -> Column:
    """Answers parsed in Arrow batches, by a parser of one's own if given."""
    one = parser or parse_answer
    return F.pandas_udf(lambda s: pd.DataFrame([one(x if isinstance(x, str) else None) for x in s], columns=PARSED.fieldNames()), PARSED)(raw)


def successful(parsed: DataFrame) -> DataFrame:
    """Answers that became records: no error, and an output."""
    return parsed.where("error_class IS NULL AND output IS NOT NULL")


def alpaca(df: DataFrame, answer: str = "answer", metadata: str = "metadata", keep: Sequence[str | Column] = ()) -> DataFrame:
    """``instruction, input, output, _metadata, chunk_index, error_class`` from parsed answers and provenance, and what is to be kept beside."""
    index = F.col("chunk_index") if "chunk_index" in df.columns else F.lit(None).cast("int")
    return df.select(f"{answer}.instruction", f"{answer}.input", f"{answer}.output", metadata_map(F.col(metadata)).alias("_metadata"), index.alias("chunk_index"), f"{answer}.error_class", *keep)


def sharegpt(instruction: Column, given: Column, output: Column) -> Column:
    """A conversation of two turns; the input, if there is one, follows the instruction."""
    ask = F.when(F.coalesce(given, F.lit("")) != "", F.concat(instruction, F.lit("\n"), given)).otherwise(instruction)
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), F.coalesce(what, F.lit("")).alias("value"))
    return F.array(turn("human", ask), turn("gpt", output))


def conversations(df: DataFrame, key: str, order: str, role: str = "role", value: str = "text") -> DataFrame:
    """Turns of a table gathered to conversations in order; roles as ``human``, ``gpt`` and ``system``."""
    who = F.when(F.col(role).isin("user", "human"), "human").when(F.col(role).isin("assistant", "gpt"), "gpt").otherwise(F.col(role))
    turns = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), who.alias("from"), F.col(value).alias("value"))))
    return df.groupBy(key).agg(F.transform(turns, lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value"))).alias("conversations"))
