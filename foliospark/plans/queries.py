"""Registered queries of the engine's own operators, with the SQL each is held against.

Each runs an operator over whole tables. The TPC-H-like tables only feed the
operators on rows (rendering, anti join); the others read the pipeline's tables.
"""

from __future__ import annotations

import base64
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.functions import html as H
from foliospark.functions import render
from foliospark.functions import text as T
from foliospark.functions import tokens as K
from foliospark.functions.tokens import tokenizer_path
from foliospark.operators import records as R
from foliospark.operators import state as C
from foliospark.operators.chunk import chunked, hard_split, with_chunks
from foliospark.operators.normalize import normalized
from foliospark.plans.pipeline import per_file_counts
from foliospark.sinks.writers import shard_numbers, split_valid
from foliospark.sources.files import counts, extension, guarded, in_order, pending
from foliospark.sources.readers import sparse
from foliospark.storage import shared_dir, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

# White space of Unicode with the separators U+001C to U+001F, as the SQL engine writes it.
_W = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NW = _W.replace("[", "[^", 1)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_W}+|{_W}+$', '', 'g')"


def _sub(x: str, *rules: tuple[str, str]) -> str:
    for pattern, to in rules:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


_TAG, _LINK, _URL = (r"<[^>]+>", " "), (r"\[([^\]]+)\]\([^\)]+\)", r"\1"), (rf"https?://{_NW}+", "")
_CONTROL = (r"[\x{00}-\x{08}\x{0b}-\x{1f}\x{7f}-\x{9f}\p{Cf}\p{Co}\p{Cs}]", "")
_PDF = ((rf"(?i)page{_W}+\p{{Nd}}+{_W}*(of{_W}+\p{{Nd}}+)?", ""), (rf"(?m)^{_W}*\p{{Nd}}{{1,4}}{_W}*$", ""))
_BLANKS = (_W.replace(r"\s", r"\t\f\r ", 1) + "+", " ")
_FEEDS = (r"\n{3,}", r"' || chr(10) || chr(10) || '")
_MD = (
    (r"!\[([^\]]*)\]\([^\)]+\)", r"\1"), (r"\[([^\]]+)\]\([^\)]+\)", r"\1"), (rf"#{{1,6}}{_W}*", ""), (r"[*_]{1,3}([^*_]+)[*_]{1,3}", r"\1"), (r"`{1,3}[^`]*`{1,3}", ""),
    (rf"(?m)^>{_W}?", ""), (rf"(?m)^[-*+]{_W}", ""), (rf"(?m)^\p{{Nd}}+\.{_W}", ""), (r"(?m)^---+$", ""),
)
# The entities that the test tables hold; the operator knows them all.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&euro;", "€"), ("&mdash;", "—"), ("&ndash;", "–"), ("&eacute;", "é"), ("&amp;", "&"))


# What the numeric references 128 to 159 stand for.
_CP1252 = ", ".join(f"WHEN {b} THEN {ord(bytes([b]).decode('cp1252', 'ignore') or chr(b))}" for b in range(128, 160)).replace(", ", " ")


def _unescape(x: str) -> str:
    x = rf"list_reduce(list_prepend({x}, list_distinct(regexp_extract_all({x}, '&#([0-9]{{1,6}});', 1))), lambda t, n: replace(t, '&#' || n || ';', chr(CAST(CASE CAST(n AS INTEGER) {_CP1252} ELSE CAST(n AS INTEGER) END AS INTEGER))))"
    for name, sign in _ENTITIES:
        x = f"replace({x}, '{name}', '{sign}')"
    return x


_FULL = _strip(_sub(_unescape("text"), _TAG, _LINK, _URL, _CONTROL, *_PDF, _BLANKS, _FEEDS))


def _tokens(x: str) -> str:
    return f"CAST(floor(len(regexp_extract_all({x}, '{_NW}+')) * 1.3::DOUBLE) AS INTEGER)"




def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fragments", ["fragment_id", "text"])


def _text_query(name: str, f, sql: str) -> None:
    """A transform over all texts of ``fragments``."""
    query(name, f"SELECT fragment_id, {sql} AS text FROM fragments")(lambda spark, sf_dir: _fragments(spark, sf_dir).select("fragment_id", f(F.col("text")).alias("text")))


_text_query("norm_entities", T.strip_html_entities, _unescape("text"))
_text_query("norm_tags", T.strip_html_tags, _sub("text", _TAG))
_text_query("norm_links", T.strip_markdown_links, _sub("text", _LINK))
_text_query("norm_urls", T.strip_urls, _sub("text", _URL))
_text_query("norm_control", T.strip_control_chars, _sub("text", _CONTROL))
_text_query("norm_pdf", T.strip_pdf_artefacts, _sub("text", *_PDF))
_text_query("norm_ws", T.collapse_whitespace, _strip(_sub("text", _BLANKS, _FEEDS)))
_text_query("md_strip", T.strip_markdown, _sub("text", *_MD))
_text_query("prompt_build", R.prompt, "'" + R.INSTRUCTION.replace("\n", "' || chr(10) || '") + "---' || chr(10) || text || chr(10) || '---'")


@query("normalize_documents", f"SELECT * FROM (SELECT doc_id, {_FULL} AS text FROM documents) WHERE regexp_matches(text, '{_NW}')")
def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("normalize_fragments", f"SELECT * FROM (SELECT fragment_id, {_FULL} AS text FROM fragments) WHERE regexp_matches(text, '{_NW}')")
def normalize_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(_fragments(spark, sf_dir))


@query("nonblank_fragments", f"SELECT fragment_id FROM fragments WHERE regexp_matches(text, '{_NW}')")
def nonblank_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fragments(spark, sf_dir).where(~T.is_empty(F.col("text"))).select("fragment_id")


_PARTS = "list_filter(list_transform({x}, lambda p: " + _strip("p") + "), lambda p: p <> '')"
_CUTS = _PARTS.replace("{x}", rf"string_split(regexp_replace(text, '([.!?]){_W}+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1))")


@query("paragraph_split", "SELECT doc_id, CAST(i AS INTEGER) AS section, p[i + 1] AS text FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM (SELECT doc_id, " + _PARTS.replace("{x}", r"regexp_split_to_array(text, '\n{2,}')") + " AS p FROM documents))")
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("section", "text"))


@query("sentence_split", f"SELECT doc_id, CAST(i AS INTEGER) AS n, s[i + 1] AS sentence FROM (SELECT doc_id, s, unnest(range(len(s))) AS i FROM (SELECT doc_id, {_CUTS} AS s FROM documents))")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("n", "sentence"))


@query("token_count", f"SELECT fragment_id, {_tokens('text')} AS tokens FROM fragments")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fragments(spark, sf_dir).select("fragment_id", K.estimated(F.col("text")).alias("tokens"))


def _chunk_sql(budget: int, overlap: int, source: str = "SELECT doc_id, text FROM documents", size: str | None = None, word: str = "1") -> str:
    """The packing as a recursive table, a sentence a step: bounds of the open run and of the runs that are done. Words of long sentences likewise.

    ``size`` is the cost of a text ``x``, ``word`` that of a word ``x`` on its own.
    """
    size = size or _tokens("x")
    return f"""
WITH RECURSIVE src AS ({source}),
d AS (SELECT doc_id, text, {size.replace("x", "text") if size == "strlen(x)" else _tokens("text")} AS total, {_CUTS} AS s FROM src),
big AS (SELECT doc_id, s, list_transform(s, lambda x: {size}) AS k FROM d WHERE total > {budget}),
step AS (
  SELECT doc_id, s, k, 1 AS i, 1 AS a, 0 AS n, CAST([] AS STRUCT(a BIGINT, b BIGINT, hard BOOLEAN)[]) AS done FROM big
  UNION ALL
  SELECT doc_id, s, k, i + 1,
         CASE WHEN k[i] > {budget} THEN i + 1 WHEN n + k[i] > {budget} THEN i - keep ELSE a END,
         CASE WHEN k[i] > {budget} THEN 0 WHEN n + k[i] > {budget} THEN coalesce(list_sum(list_slice(k, i - keep, i - 1)), 0) + k[i] ELSE n + k[i] END,
         CASE WHEN k[i] > {budget} OR n + k[i] > {budget} THEN list_concat(done, CASE WHEN a < i THEN [{{'a': a, 'b': i - 1, 'hard': FALSE}}] ELSE [] END, CASE WHEN k[i] > {budget} THEN [{{'a': i, 'b': i, 'hard': TRUE}}] ELSE [] END) ELSE done END
  FROM (SELECT *, len(list_filter(range(a, i), lambda y: list_sum(list_slice(k, y, i - 1)) <= {overlap})) AS keep FROM step) WHERE i <= len(s)),
runs AS (SELECT doc_id, s, CASE WHEN a <= len(s) THEN list_append(done, {{'a': a, 'b': len(s), 'hard': FALSE}}) ELSE done END AS r FROM step WHERE i = len(s) + 1),
long AS (SELECT DISTINCT t, regexp_extract_all(t, '{_NW}+') AS w FROM (SELECT s[x.a] AS t FROM (SELECT s, unnest(r) AS x FROM runs) WHERE x.hard)),
words AS (
  SELECT t, w, 1 AS i, 0 AS n, CAST([] AS BIGINT[]) AS starts FROM long
  UNION ALL
  SELECT t, w, i + 1, CASE WHEN starts = [] OR n + c > {budget} THEN c ELSE n + c END, CASE WHEN starts = [] OR n + c > {budget} THEN list_append(starts, i) ELSE starts END FROM (SELECT *, w[i] AS x, CAST({word.replace("x", "w[i]")} AS BIGINT) AS c FROM words) WHERE i <= len(w)),
parts AS (SELECT t, list_transform(starts, lambda b, j: array_to_string(list_slice(w, b, coalesce(starts[j + 1] - 1, len(w))), ' ')) AS p FROM words WHERE i = len(w) + 1),
pieces AS (SELECT doc_id, j, CASE WHEN x.hard THEN p ELSE [array_to_string(list_slice(s, x.a, x.b), ' ')] END AS c FROM (SELECT doc_id, s, unnest(r) AS x, unnest(range(len(r))) AS j FROM runs) LEFT JOIN parts ON x.hard AND t = s[x.a]),
cut AS (SELECT doc_id, flatten(list(c ORDER BY j)) AS c FROM pieces GROUP BY doc_id
        UNION ALL SELECT doc_id, [text] FROM d WHERE total <= {budget})
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, c[i + 1] AS text FROM (SELECT doc_id, c, unnest(range(len(c))) AS i FROM cut)
"""


@query("chunk_default_budget", _chunk_sql(3584, 128))
def chunk_default_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked(table(spark, sf_dir, "documents", ["doc_id", "text"]), 3584, 128)


@query("chunk_small_budget", _chunk_sql(100, 24))
def chunk_small_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked(table(spark, sf_dir, "documents", ["doc_id", "text"]), 100, 24)


@query("chunk_tiny_budget", _chunk_sql(12, 5))
def chunk_tiny_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """So small that many sentences are split by words."""
    return chunked(table(spark, sf_dir, "documents", ["doc_id", "text"]), 12, 5)


_NORMALIZED = f"SELECT * FROM (SELECT doc_id, {_FULL} AS text FROM documents) WHERE regexp_matches(text, '{_NW}')"


@query("chunk_documents", f"SELECT *, {_tokens('text')} AS tokens FROM ({_chunk_sql(1024, 96, _NORMALIZED)})")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic core from end to end: normalised, blank ones dropped, chunked, counted."""
    clean = normalized(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return chunked(clean, 1024, 96).withColumn("tokens", K.estimated(F.col("text")))


def _byte_vocabulary(spark: SparkSession) -> str:
    """A vocabulary of single bytes in the shared folder, whose counts SQL can tell: a text has as many tokens as bytes."""
    folder = "/" + f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}/bytes-{uuid.uuid4().hex}".removeprefix("file:").lstrip("/")
    os.makedirs(folder)
    with open(f"{folder}/bytes.tiktoken", "w") as f:
        f.writelines(f"{base64.b64encode(bytes([b])).decode()} {b}\n" for b in range(256))
    return tokenizer_path("bytes", folder)


@query("token_count_exact", "SELECT fragment_id, CAST(strlen(text) AS INTEGER) AS tokens FROM fragments")
def token_count_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fragments(spark, sf_dir).select("fragment_id", K.counted(F.col("text"), _byte_vocabulary(spark)).alias("tokens"))


@query("chunk_exact_tokens", _chunk_sql(2000, 300, size="strlen(x)", word="strlen(x)"))
def chunk_exact_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose sizes a tokenizer counts."""
    return chunked(table(spark, sf_dir, "documents", ["doc_id", "text"]), 2000, 300, tokenizer=_byte_vocabulary(spark))


@query("chunk_counts", f"SELECT doc_id, CAST({_tokens('text')} <= 1024 AS BOOLEAN) AS fits FROM documents")
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a text is its only chunk."""
    d = with_chunks(table(spark, sf_dir, "documents", ["doc_id", "text"]), 1024, 96)
    return d.select("doc_id", ((F.size("chunks") == 1) & (F.col("chunks")[0] == F.col("text"))).alias("fits"))


_PIECES = f"regexp_extract_all(text, '{_NW}+')"


@query("hard_split", f"SELECT doc_id, CAST(o // 50 AS INTEGER) AS part, array_to_string(list_slice(w, o + 1, o + 50), ' ') AS text FROM (SELECT doc_id, w, unnest(range(0, len(w), 50)) AS o FROM (SELECT doc_id, {_PIECES} AS w FROM documents))")
def hard_split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", ["doc_id", "text"]).where(~T.is_empty(F.col("text"))).select("doc_id", F.posexplode(hard_split(F.col("text"), 50)).alias("part", "text"))


_LINES = r"regexp_extract_all(regexp_replace(text, '\r\n?', chr(10), 'g'), '[^\n]*\n|[^\n]+')"


@query("line_buckets", f"SELECT doc_id, CAST(o // 20 AS INTEGER) AS section, array_to_string(list_slice(l, o + 1, o + 20), '') AS text FROM (SELECT doc_id, l, unnest(range(0, len(l), 20)) AS o FROM (SELECT doc_id, {_LINES} AS l FROM documents))")
def line_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of 20 lines, for few of these texts have 200."""
    return table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.posexplode(T.line_buckets(F.col("text"), 20)).alias("section", "text"))


# Pages whose text is known, for it went in escaped: around it everything that a parser has to see through.
_ESCAPED = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))
_HEAD = "<!DOCTYPE html><html><head><title>P ", "</title><script>if (a<b) x('</p>')</script><style>p > q {}</style></head><body><header>h<header>inner</header> tail</header><nav>menu <b>m</b></nav><div title=\"x>y\"><p class='a>b'>"
_TAIL = "</p>\n\n<!-- c <p> --><div>end &amp; <b>out</b></div><div><aside>left open</div><NOSCRIPT>n</NOSCRIPT></div><footer>f</footer></body></html>"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = F.col("text")
    for sign, reference in _ESCAPED:
        escaped = F.replace(escaped, F.lit(sign), F.lit(reference))
    page = F.concat(F.lit(_HEAD[0]), F.col("fragment_id"), F.lit(_HEAD[1]), escaped, F.lit(_TAIL))
    return _fragments(spark, sf_dir).where("text IS NOT NULL").select("fragment_id", page.alias("text"))


# What a reader of such a page sees: its title, the text, and the end.
_SEEN = "'P ' || fragment_id || chr(10) || CASE WHEN text = '' THEN '' ELSE text || chr(10) END || chr(10) || chr(10) || chr(10) || 'end & ' || chr(10) || 'out'"
_SEEN_PARTS = "SELECT fragment_id, " + _PARTS.replace("{x}", rf"string_split(regexp_replace({_SEEN}, '\n{{3,}}', chr(10) || chr(10), 'g'), chr(10) || chr(10))") + " AS t FROM fragments WHERE text IS NOT NULL"


@query("html_extract", f"SELECT fragment_id, CAST(i AS INTEGER) AS section, t[i + 1] AS text FROM (SELECT fragment_id, t, unnest(range(len(t))) AS i FROM ({_SEEN_PARTS}))")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of pages built around each fragment's text."""
    return _pages(spark, sf_dir).select("fragment_id", F.posexplode(H.html_paragraphs(F.col("text"))).alias("section", "text"))


@query("html_title", "SELECT fragment_id, 'P ' || fragment_id AS title FROM fragments WHERE text IS NOT NULL")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("fragment_id", H.html_title(F.col("text")).alias("title"))


@query("json_flatten", "SELECT event_id, (SELECT string_agg(k || ': ' || json_extract_string(props, '$.' || k), chr(10)) FROM (SELECT unnest(json_keys(props)) AS k)) AS text FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", ["event_id", "props"]).select("event_id", render.flatten_json(F.col("props")).alias("text"))


@query("csv_render", "SELECT c_custkey, 'c_custkey: ' || c_custkey || ' | c_name: ' || c_name || ' | c_nationkey: ' || c_nationkey || ' | c_mktsegment: ' || c_mktsegment AS text FROM customer")
def csv_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return table(spark, sf_dir, "customer", cols).select("c_custkey", render.row_text(cols).alias("text"))


@query("table_render", "SELECT n_regionkey, string_agg(n_nationkey || ' | ' || trim(n_name), chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY n_regionkey")
def table_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    cells = F.transform(rows, lambda r: F.array(r["n_nationkey"].cast("string"), r["n_name"]))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(render.table_text(cells).alias("text"))


@query("metadata_flatten", """
SELECT fragment_id, m['source_path'] AS source_path, m['page_or_section'] AS page_or_section, m['style'] AS style, CAST(3 + coalesce(cardinality(metadata.extra), 0) AS INTEGER) AS keys
FROM (SELECT fragment_id, metadata, map_concat(MAP {'source_path': metadata.source_path, 'page_or_section': metadata.page_or_section, 'timestamp': metadata.timestamp}, coalesce(metadata.extra, MAP {})) AS m FROM fragments)""")
def metadata_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "fragments", ["fragment_id", "metadata"]).withColumn("m", render.metadata_map(F.col("metadata")))
    return m.select("fragment_id", *[F.col("m")[k].alias(k) for k in ("source_path", "page_or_section", "style")], F.size("m").alias("keys"))


def _noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as models give them, made of the records: bare, fenced, with chatter, without JSON, an array."""
    r = table(spark, sf_dir, "alpaca_records", ["record_id", "instruction", "input", "output"])
    made = F.to_json(F.struct("instruction", "input", "output"), {"ignoreNullFields": "false"})
    kind = F.pmod("record_id", F.lit(5))
    raw = F.when(kind == 0, made).when(kind == 1, F.concat(F.lit("```json\n"), made, F.lit("\n```"))).when(kind == 2, F.concat(F.lit("Sure! "), made, F.lit(" Anything else?"))).when(kind == 3, F.lit("no JSON here")).otherwise(F.lit("[1, 2]"))
    return r.select("record_id", raw.alias("raw"))


_ANSWERS = """
SELECT record_id, CASE WHEN record_id % 5 < 3 THEN instruction WHEN record_id % 5 = 3 THEN '' END AS instruction, CASE WHEN record_id % 5 < 3 THEN input WHEN record_id % 5 = 3 THEN '' END AS input,
       CASE WHEN record_id % 5 < 3 THEN output WHEN record_id % 5 = 3 THEN 'no JSON here' END AS output, CASE WHEN record_id % 5 = 4 THEN 'LLMMalformedResponse' END AS error_class FROM alpaca_records"""


@query("answer_parse", _ANSWERS)
def answer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _noisy(spark, sf_dir).withColumn("a", R.parse_answers(F.col("raw")))
    return parsed.select("record_id", "a.instruction", "a.input", "a.output", "a.error_class")


@query("success_filter", f"SELECT record_id FROM ({_ANSWERS}) WHERE error_class IS NULL AND output IS NOT NULL")
def success_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.successful(answer_parse(spark, sf_dir)).select("record_id")


@query("sharegpt_records", """
SELECT record_id, 'human' AS from_0, CASE WHEN coalesce(input, '') <> '' THEN instruction || chr(10) || input ELSE coalesce(instruction, '') END AS value_0, 'gpt' AS from_1, coalesce(output, '') AS value_1 FROM alpaca_records""")
def sharegpt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "alpaca_records", ["record_id", "instruction", "input", "output"])
    c = r.select("record_id", R.sharegpt(F.col("instruction"), F.col("input"), F.col("output")).alias("c"))
    return c.select("record_id", F.col("c")[0]["from"].alias("from_0"), F.col("c")[0]["value"].alias("value_0"), F.col("c")[1]["from"].alias("from_1"), F.col("c")[1]["value"].alias("value_1"))


@query("conversations", "SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS turns FROM events GROUP BY user_id")
def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns gathered in order; a user's events stand for the turns."""
    turns = table(spark, sf_dir, "events", ["user_id", "event_id", "event_type"])
    made = R.conversations(turns, "user_id", "event_id", "event_type", "event_type")
    return made.select("user_id", F.array_join(F.transform("conversations", lambda t: t["value"]), ",").alias("turns"))


@query("schema_validate", "SELECT record_id, instruction IS NOT NULL AS ok FROM alpaca_records")
def schema_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, bad = split_valid(table(spark, sf_dir, "alpaca_records", ["record_id", "instruction"]), "alpaca")
    return ok.select("record_id", F.lit(True).alias("ok")).unionByName(bad.select("record_id", F.lit(False).alias("ok")))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "source_files", ["file_path", "ext", "size_bytes"]).withColumnsRenamed({"file_path": "path", "size_bytes": "length"})


@query("resume_anti_join", "SELECT file_path AS path FROM source_files WHERE file_path NOT IN (SELECT file_path FROM checkpoints WHERE status = 'complete')")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending(_files(spark, sf_dir), C.completed(table(spark, sf_dir, "checkpoints"))).select("path")


@query("file_counts", "SELECT count(*) AS discovered, count(c.file_path) AS done, count(*) - count(c.file_path) AS pending FROM source_files LEFT JOIN (SELECT file_path FROM checkpoints WHERE status = 'complete') c USING (file_path)")
def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(_files(spark, sf_dir), C.completed(table(spark, sf_dir, "checkpoints")))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's state, and a later run that fails the complete ones of even size and completes the failed."""
    now = table(spark, sf_dir, "checkpoints").withColumn("seq", F.lit(1).cast("long"))
    even = F.pmod(F.length("file_path"), F.lit(2)) == 0
    fails = now.where((F.col("status") == "complete") & even).select("file_path", F.lit("failed").alias("status"), F.lit(None).cast("int").alias("num_chunks"), F.lit(None).cast("int").alias("num_records"), F.lit("2030").alias("finished_at"), F.lit("again").alias("error_msg"), F.lit(2).cast("long").alias("seq"))
    heals = now.where(F.col("status") == "failed").select("file_path", F.lit("complete").alias("status"), F.lit(7).alias("num_chunks"), F.lit(6).alias("num_records"), F.lit("2031").alias("finished_at"), F.lit(None).cast("string").alias("error_msg"), F.lit(2).cast("long").alias("seq"))
    return now.unionByName(fails).unionByName(heals)


_STATE = """
WITH l AS (SELECT *, status = 'complete' AND length(file_path) % 2 = 0 AS f, status = 'failed' AS h FROM checkpoints)
SELECT file_path, CASE WHEN f THEN 'failed' WHEN h THEN 'complete' ELSE status END AS status, {chunks} AS num_chunks, {records} AS num_records,
       CASE WHEN f THEN '2030' WHEN h THEN '2031' ELSE finished_at END AS finished_at, {error} AS error_msg FROM l"""


@query("checkpoint_latest", _STATE.format(chunks="CAST(CASE WHEN f THEN NULL WHEN h THEN 7 ELSE num_chunks END AS INTEGER)", records="CAST(CASE WHEN f THEN NULL WHEN h THEN 6 ELSE num_records END AS INTEGER)", error="CASE WHEN f THEN 'again' WHEN h THEN NULL ELSE error_msg END"))
def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest(_log(spark, sf_dir))


@query("checkpoint_upsert", _STATE.format(chunks="CAST(CASE WHEN h THEN 7 ELSE num_chunks END AS INTEGER)", records="CAST(CASE WHEN h THEN 6 ELSE num_records END AS INTEGER)", error="CASE WHEN f THEN 'again' WHEN h THEN error_msg END"))
def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an upsert would hold: old counts of a failed file, the old error of a complete one."""
    return C.latest(_log(spark, sf_dir), sticky=True)


@query("checkpoint_stats", "SELECT count(*) AS total, count(*) FILTER (WHERE status = 'complete') AS complete, count(*) FILTER (WHERE status = 'failed') AS failed FROM checkpoints")
def checkpoint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stats(table(spark, sf_dir, "checkpoints"))


@query("failed_files", "SELECT file_path, error_msg FROM checkpoints WHERE status = 'failed'")
def failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "checkpoints").where(F.col("status") == C.FAILED).select("file_path", "error_msg")


@query("per_file_counts", "SELECT metadata.source_path AS file_path, CAST(count(*) AS INTEGER) AS num_chunks, CAST(count(text) AS INTEGER) AS num_records FROM fragments GROUP BY 1")
def per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_file_counts(table(spark, sf_dir, "fragments", ["metadata", "text"]).withColumn("file_path", F.col("metadata.source_path")), F.col("text"))


@query("ordered_concat", "SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey")
def ordered_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = render.ordered_text(["l_linenumber", "l_partkey", "l_suppkey"], "l_returnflag", "")
    return table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]).groupBy("l_orderkey").agg(flags.alias("flags"))


@query("discover_sort", "SELECT file_path AS path, row_number() OVER (ORDER BY file_path) - 1 AS n FROM source_files")
def discover_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in their order; the ordinal is counted off by shards of one row."""
    return shard_numbers(in_order(_files(spark, sf_dir).select("path")), ["path"], 1).select("path", F.col("shard").cast("long").alias("n"))


@query("ext_filter", r"SELECT file_path AS path, lower(regexp_extract(file_path, '[^/](\.[^./]+)$', 1)) AS ext FROM source_files WHERE lower(regexp_extract(file_path, '[^/](\.[^./]+)$', 1)) IN ('.txt', '.md', '.csv')")
def ext_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).select("path", extension(F.col("path")).alias("ext")).where(F.col("ext").isin(".txt", ".md", ".csv"))


@query("size_ceiling", "SELECT file_path AS path, size_bytes <= 4000 AS passes FROM source_files WHERE size_bytes IS NOT NULL")
def size_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, over = guarded(_files(spark, sf_dir), Settings(max_file_bytes=4000))
    return ok.select("path", F.lit(True).alias("passes")).unionByName(over.select(F.col("file_path").alias("path"), F.lit(False).alias("passes")))


@query("sparse_pages", f"SELECT fragment_id, length({_strip('text')}) < 20 AS sparse FROM fragments WHERE text IS NOT NULL AND lower(metadata.source_path) LIKE '%.pdf'")
def sparse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "fragments", ["fragment_id", "text", "metadata"]).where("text IS NOT NULL AND lower(metadata.source_path) LIKE '%.pdf'")
    return f.select("fragment_id", sparse(F.col("text")).alias("sparse"))


@query("shard_assign", "SELECT record_id, CAST((row_number() OVER (ORDER BY record_id) - 1) // 700 AS INTEGER) AS shard FROM alpaca_records")
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_numbers(table(spark, sf_dir, "alpaca_records", ["record_id"]), ["record_id"], 700)


@query("union_texts", "SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'f', fragment_id, text FROM fragments")
def union_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", ["doc_id", "text"]).select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    return d.unionByName(_fragments(spark, sf_dir).select(F.lit("f").alias("kind"), F.col("fragment_id").alias("id"), "text"))


@query("files_without_fragments", "SELECT file_path FROM source_files EXCEPT SELECT metadata.source_path FROM fragments")
def files_without_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set difference."""
    read = table(spark, sf_dir, "fragments", ["metadata"]).select(F.col("metadata.source_path").alias("file_path"))
    return pending(_files(spark, sf_dir), read).select(F.col("path").alias("file_path"))


@query("settings_latest", "SELECT key, value FROM run_metadata")
def settings_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of each key of a log that holds an older one too."""
    kv = table(spark, sf_dir, "run_metadata")
    log = kv.withColumn("seq", F.lit(2)).unionByName(kv.select("key", F.lit("old").alias("value"), F.lit(1).alias("seq")))
    return C.last_values(log)


@query("checkpoint_compacted", SQL["checkpoint_upsert"])
def checkpoint_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert view of a log compacted twice, with a run in between."""
    log = _log(spark, sf_dir)
    once = C.compacted(log.where("seq = 1"))
    return C.latest(C.compacted(once.unionByName(C.carried(log.where("seq = 2")).select(once.columns))), sticky=True)


@query("checkpoint_compacted_latest", SQL["checkpoint_latest"])
def checkpoint_compacted_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest(C.compacted(C.compacted(_log(spark, sf_dir))))


@query("json_flatten_nested", """
SELECT event_id, 'id: ' || event_id || chr(10) || 'n.type: ' || event_type || chr(10) || 'n.list: [' || user_id || ', "é", [1]]' || chr(10) || 'n.deep.t: True' || chr(10) || 'n.deep.o: None' || chr(10) || chr(10) || 'last: 1.0' AS text FROM events""")
def json_flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.format_string('{"id":%d,"n":{"type":"%s","list":[%d,"é",[1]],"deep":{"t":true,"o":null},"none":{}},"last":1.0}', "event_id", "event_type", "user_id")
    return table(spark, sf_dir, "events", ["event_id", "event_type", "user_id"]).select("event_id", render.flatten_json(raw).alias("text"))


_text_query("norm_control_exact", T.strip_control_chars_exact, _sub("text", _CONTROL))
_text_query("custom_transforms", lambda c: T.normalize(c, (T.strip_urls, T.as_transform(lambda t: t.replace("e", "E"), python=True), T.strip)), _strip(f"replace({_sub('text', _URL)}, 'e', 'E')"))
