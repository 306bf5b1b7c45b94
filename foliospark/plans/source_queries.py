"""Queries over readers, model calls and sinks.

Readers take frames of files; here the files' contents are made from whole
tables, so that each reader meets every text. Model calls go through a real
adapter over a transport that answers by rule and without a network.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.functions import render
from foliospark.functions import text as T
from foliospark.operators import records as R
from foliospark.operators.generate import ChatAdapter, OllamaAdapter, adapter_of, answers, spread
from foliospark.plans.queries import _MD, _NW, _PARTS, _pages, _strip, _sub, query
from foliospark.plans.queries import SQL as _SQL
from foliospark.registry import adapters, readers, writers
from foliospark.sinks.writers import write_jsonl, write_parquet
from foliospark.sources.readers import as_fragments, pdf_reader, read_csv, read_docx, read_html, read_json, read_markdown, read_txt
from foliospark.storage import shared_dir, table

_S = Settings()


def _as_files(df: DataFrame, key: str, content) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("path"), content.alias("content"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_files(table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", F.col("text").cast("binary"))


def _found(df: DataFrame) -> DataFrame:
    return df.select("file_path", "section", "text")


_BUCKETS = r"""
SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(o // 200 AS VARCHAR) AS section, array_to_string(list_slice(l, o + 1, o + 200), '') AS text
FROM (SELECT doc_id, l, unnest(range(0, len(l), 200)) AS o FROM (SELECT doc_id, regexp_extract_all(regexp_replace(text, '\r\n?', chr(10), 'g'), '[^\n]*\n|[^\n]+') AS l FROM documents))"""


@query("source_txt", _BUCKETS)
def source_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(read_txt(_documents(spark, sf_dir), _S))


_PARAGRAPHS = "SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(i AS VARCHAR) AS section, p[i + 1] AS text FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM (SELECT doc_id, " + _PARTS.replace("{x}", rf"regexp_split_to_array({_sub('text', *_MD)}, '\n{{2,}}')") + " AS p FROM documents))"


@query("source_markdown", _PARAGRAPHS)
def source_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(read_markdown(_documents(spark, sf_dir), _S))


@query("source_html", f"SELECT CAST(fragment_id AS VARCHAR) AS file_path, CAST(section AS VARCHAR) AS section, text, 'P ' || fragment_id AS title FROM ({_SQL['html_extract']})")
def source_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _as_files(_pages(spark, sf_dir), "fragment_id", F.col("text").cast("binary"))
    return read_html(files, _S).select("file_path", "section", "text", F.col("extra")["title"].alias("title"))


# Cells quoted, with quotes, commas and line feeds in them; a file for each source of documents, rows in the order of their ids.
_CSV = "regexp_replace(regexp_replace(coalesce({c}, ''), '\\r\\n?', chr(10), 'g'), '\\x{{feff}}', '', 'g')"
_CELL = "CASE WHEN {x} <> '' THEN '{n}: ' || {x} END"


@query("source_csv", f"""
SELECT file_path, section, text FROM (
  SELECT CAST(source AS VARCHAR) AS file_path, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS VARCHAR) AS section, concat_ws(' | ', 'key: ' || doc_id, {_CELL.format(x=_CSV.format(c='lang'), n='lang')}, {_CELL.format(x=_CSV.format(c='text'), n='text')}) AS text
  FROM documents WHERE source IS NOT NULL)""")
def source_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each source, its documents as rows with their whole texts; a column without values is left out."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    row = F.concat_ws(",", "doc_id", quoted("lang"), quoted("text"), F.lit(""))
    d = table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "text"]).where("source IS NOT NULL").select("source", "doc_id", row.alias("row"))
    files = d.groupBy("source").agg(F.concat(F.lit("key,lang,text,none\r\n"), render.ordered_text(["doc_id"], "row", "\r\n")).alias("c"))
    return _found(read_csv(_as_files(files, "source", F.col("c").cast("binary")), _S))


@query("source_json", "SELECT CAST(user_id AS VARCHAR) AS file_path, CAST(n AS VARCHAR) AS section, (SELECT string_agg(k || ': ' || json_extract_string(props, '$.' || k), chr(10)) FROM (SELECT unnest(json_keys(props)) AS k)) AS text FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events) WHERE len(json_keys(props)) > 0")
def source_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each user: an array of the properties of their events."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "props"))), lambda e: e["props"])
    files = table(spark, sf_dir, "events", ["user_id", "event_id", "props"]).groupBy("user_id").agg(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("c"))
    return _found(read_json(_as_files(files, "user_id", F.col("c").cast("binary")), _S))


@query("source_json_stream", """
SELECT event_type AS file_path, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS VARCHAR) AS section, 'id: ' || event_id || chr(10) || 'n.list: [' || user_id || ', "x"]' || chr(10) || 'n.t: True' AS text FROM events""")
def source_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large array of nested objects for each type, decoded from a window far smaller than the file."""
    row = F.format_string('{"id": %d, "n": {"list": [%d, "x"], "t": true}}', "event_id", "user_id")
    d = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type"]).select("event_type", "event_id", row.alias("row"))
    files = d.groupBy("event_type").agg(F.concat(F.lit("["), render.ordered_text(["event_id"], "row", ",\n"), F.lit("]")).alias("c"))
    return _found(read_json(_as_files(files, "event_type", F.col("c").cast("binary")), _S.with_(stream_chunk_bytes=100)))


@query("source_pages", f"SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(i + 1 AS VARCHAR) AS section, p[i + 1] AS text FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM (SELECT doc_id, list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^[^\\S]+|[^\\S]+$', '', 'g')) AS p FROM documents)) WHERE p[i + 1] <> ''")
def source_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by an extractor that takes blank lines for page ends."""
    return _found(pdf_reader(lambda raw: iter(raw.decode().split("\n\n")))(_documents(spark, sf_dir), _S))


@query("source_ocr", f"SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(i + 1 AS VARCHAR) AS section, CASE WHEN length(p[i + 1]) < 20 THEN 'scanned ' || (i + 1) ELSE p[i + 1] END AS text FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM (SELECT doc_id, list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^[^\\S]+|[^\\S]+$', '', 'g')) AS p FROM documents))")
def source_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages; those of little text go to a recogniser."""
    return _found(pdf_reader(lambda raw: iter(raw.decode().split("\n\n")), lambda raw, n: f" scanned {n}")(_documents(spark, sf_dir), _S))


_WP = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def _docx(text: str) -> bytes:
    """A document with a paragraph for each part between blank lines, and a table of the first words."""
    run = lambda x: f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>"
    cells = "".join(f"<w:tc>{run(w)}</w:tc>" for w in text.split()[:3])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {_WP}><w:body>{''.join(map(run, text.split(chr(10) * 2)))}<w:tbl><w:tr>{cells}</w:tr></w:tbl></w:body></w:document>")
    return out.getvalue()


@query("source_docx", f"""
SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(i AS VARCHAR) AS section, p[i + 1] AS text FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM (SELECT doc_id, list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_strip("x")}) AS p FROM documents)) WHERE p[i + 1] <> ''
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'table-0', array_to_string(list_slice(regexp_extract_all(text, '{_NW}+'), 1, 3), ' | ') FROM documents""")
def source_docx(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.pandas_udf(lambda s: s.map(_docx), "binary")
    return _found(read_docx(_as_files(table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", made("text")), _S))


@query("source_fallback", r"SELECT CAST(doc_id AS VARCHAR) AS file_path, regexp_replace(text, '[^\x{00}-\x{ff}]', '?', 'g') AS text FROM documents")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents in ISO 8859-1: what is no UTF-8 is read by the next encoding of the chain."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    latin = F.encode(F.regexp_replace("text", r"[^\x{00}-\x{ff}]", "?"), "ISO-8859-1")
    pages = read_txt(_as_files(d, "doc_id", latin), _S)
    return pages.withColumn("n", F.col("section").cast("int")).groupBy("file_path").agg(render.ordered_text(["n"], "text", "").alias("text"))


@query("source_errors", "SELECT CAST(doc_id AS VARCHAR) AS file_path, 'CorruptedFile' AS error_class FROM documents WHERE NOT coalesce(json_valid(text), FALSE)")
def source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts given for JSON files: a row with an error for each that is none."""
    return read_json(_documents(spark, sf_dir), _S).where("error_class IS NOT NULL").select("file_path", "error_class")


@query("fragments_made", f"SELECT file_path AS source_path, section AS page_or_section, '2024-01-01' AS timestamp, text FROM ({_BUCKETS}) WHERE regexp_matches(text, '{_NW}')")
def fragments_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of readers as fragments with one timestamp, blank ones dropped."""
    f = as_fragments(read_txt(_documents(spark, sf_dir), _S), "2024-01-01").where(~T.is_empty(F.col("text")))
    return f.select("metadata.source_path", "metadata.page_or_section", "metadata.timestamp", "text")


class Rules:
    """A transport that answers by the prompt's number: 0 well, 1 after one rate limit, 2 never in time, 3 with a server's error, 4 with no JSON body."""

    def __init__(self, chat: bool) -> None:
        self.chat, self.seen = chat, set()

    def __call__(self, url: str, body: bytes | None, timeout: float) -> tuple[int, bytes]:
        sent = json.loads(body)
        prompt = sent["messages"][-1]["content"] if self.chat else sent["prompt"]
        kind = int(prompt.split(":", 1)[0]) % 5
        if kind == 1 and prompt not in self.seen:
            self.seen.add(prompt)
            return 429, b""
        if kind == 2:
            raise TimeoutError
        if kind == 3:
            return 500, b"down"
        if kind == 4:
            return 200, b"no JSON"
        text = hashlib.md5(prompt.encode()).hexdigest()
        return 200, json.dumps({"choices": [{"message": {"content": text}}]} if self.chat else {"response": text}).encode()


_ASKED = "doc_id || ':' || '" + R.INSTRUCTION.replace("\n", "' || chr(10) || '") + "---' || chr(10) || text || chr(10) || '---'"
_CALLS = f"""
SELECT doc_id, CASE WHEN doc_id % 5 < 2 THEN md5({_ASKED}) END AS raw, CAST(CASE doc_id % 5 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS INTEGER) AS attempts,
       CASE doc_id % 5 WHEN 2 THEN 'LLMTimeout' WHEN 3 THEN 'LLMConnection' WHEN 4 THEN 'LLMMalformedResponse' END AS error_class FROM documents"""


def _no_wait(seconds: float) -> None:
    """In place of the waits between attempts."""


def _called(spark: SparkSession, sf_dir: str, adapter) -> DataFrame:
    """Prompts around whole texts, behind the number that the rule goes by."""
    prompts = table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.concat_ws(":", "doc_id", R.prompt(F.col("text"))).alias("prompt"))
    return answers(prompts, adapter, _S, sleep=_no_wait).select("doc_id", "raw", "attempts", "error_class")


@query("model_calls_ollama", _CALLS)
def model_calls_ollama(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir, OllamaAdapter("http://local", "m", 1.0, Rules(False)))


@query("model_calls_chat", _CALLS)
def model_calls_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir, ChatAdapter("http://local", "m", 1.0, Rules(True)))


@query("model_calls_spread", _CALLS)
def model_calls_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over as many partitions as may call at once."""
    few = _S.with_(max_concurrent_llm_calls=3)
    prompts = table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.concat_ws(":", "doc_id", R.prompt(F.col("text"))).alias("prompt"))
    return answers(spread(prompts, few), ChatAdapter("http://local", "m", 1.0, Rules(True)), few, sleep=_no_wait).select("doc_id", "raw", "attempts", "error_class")


class Structured:
    """An adapter whose ``generate`` asks for structured answers of an endpoint that fences them."""

    def __init__(self, chat: bool) -> None:
        self.endpoint = (ChatAdapter if chat else OllamaAdapter)("http://local", "m", 1.0, self.reply)
        self.chat = chat

    def reply(self, url: str, body: bytes | None, timeout: float) -> tuple[int, bytes]:
        sent = json.loads(body)
        prompt, heat = (sent["messages"][-1]["content"], sent["temperature"]) if self.chat else (sent["prompt"], sent["options"]["temperature"])
        text = "```json\n" + json.dumps({"size": len(prompt), "heat": heat}) + "\n```" if prompt else "none"
        return 200, json.dumps({"choices": [{"message": {"content": text}}]} if self.chat else {"response": text}).encode()

    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str:
        got = self.endpoint.generate_structured(prompt, system)
        return f"{got['size']} {got['heat']}"


@query("model_calls_structured", "SELECT chat, fragment_id, CASE WHEN text <> '' THEN length(text) || ' 0.3' END AS raw, CASE WHEN text = '' THEN 'LLMMalformedResponse' END AS error_class FROM fragments, (VALUES (TRUE), (FALSE)) c(chat)")
def model_calls_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both backends, cooler, parsed as JSON."""
    prompts = table(spark, sf_dir, "fragments", ["fragment_id", "text"]).withColumnRenamed("text", "prompt")
    both = [answers(prompts.withColumn("chat", F.lit(chat)), Structured(chat), _S, sleep=_no_wait) for chat in (True, False)]
    return both[0].unionByName(both[1]).select("chat", "fragment_id", "raw", "error_class")


@query("model_health", "SELECT * FROM (VALUES ('ollama', 200, TRUE), ('ollama', 500, FALSE), ('openai', 200, TRUE), ('openai', 500, FALSE), ('openai', 404, TRUE)) v(backend, status, healthy)")
def model_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A server that lists its models, one that is down, and one that only completes."""

    def rows() -> list[tuple[str, int, bool]]:
        out = []
        for backend, status in (("ollama", 200), ("ollama", 500), ("openai", 200), ("openai", 500), ("openai", 404)):
            full = json.dumps({"models": [], "choices": [{"message": {"content": "x"}}]}).encode()
            adapter = adapter_of(Settings(llm_backend=backend), lambda url, body, timeout, s=status: (200 if s == 404 and body else s, full))
            out.append((backend, status, adapter.health_check()))
        return out

    return spark.createDataFrame(rows(), "backend string, status int, healthy boolean")


@query("registered", "SELECT * FROM (VALUES ('reader', '.csv', 0), ('reader', '.docx', 1), ('reader', '.htm', 2), ('reader', '.html', 3), ('reader', '.json', 4), ('reader', '.md', 5), ('reader', '.pdf', 6), ('reader', '.txt', 7), ('adapter', 'ollama', 0), ('adapter', 'openai', 1), ('writer', 'huggingface', 0), ('writer', 'jsonl', 1), ('writer', 'parquet', 2)) v(kind, key, n)")
def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is registered, in the order of its keys."""
    return spark.createDataFrame([(r.kind, k, n) for r in (readers, adapters, writers) for n, k in enumerate(r.keys())], "kind string, key string, n int")


def _sink(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


_RECORDS = "SELECT record_id, instruction, input, output FROM alpaca_records"


@query("sink_jsonl", _RECORDS)
def sink_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines and read again."""
    df = table(spark, sf_dir, "alpaca_records", ["record_id", "instruction", "input", "output"])
    out = write_jsonl(df, _sink(spark, "jsonl"), Settings(rows_per_shard=700))
    return spark.read.schema(df.schema).json(out.path)


@query("sink_parquet", _RECORDS)
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as shards and read again."""
    df = table(spark, sf_dir, "alpaca_records", ["record_id", "instruction", "input", "output"])
    out = write_parquet(df, _sink(spark, "parquet"), Settings(rows_per_shard=700))
    return spark.read.schema(df.schema).parquet(out.path)
