"""Queries over whole runs: folders of files, discovery, dispatch, state, sinks and the stream.

Each document becomes a file below the shared folder, text or Markdown by its
number, in one of some folders; then the engine's own entry points are called.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.operators.state import StateLog, has_status
from foliospark.plans.pipeline import Pipeline
from foliospark.plans.queries import _FULL, _NW, query
from foliospark.plans.source_queries import _BUCKETS, _PARAGRAPHS, _sink
from foliospark.sinks.writers import output_folder, write_jsonl
from foliospark.sources import files as S
from foliospark.sources.readers import read_all, text_stream
from foliospark.storage import shared_dir, table
from foliospark.streaming.ingest import chunk_stream

#: Suffixes by the number of a document; case does not matter to the engine.
SUFFIXES = (".txt", ".md", ".TXT")


def _folder(spark: SparkSession, sf_dir: str) -> str:
    """The documents as files, every fiftieth beside a link that leads out of the folder."""
    root = f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"
    local = "/" + root.removeprefix("file:").lstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = f"{local}/d{doc % 7}/e{doc % 3}"
                os.makedirs(at, exist_ok=True)
                with open(f"{at}/{doc}{SUFFIXES[doc % 3]}", "wb") as f:
                    f.write((text or "").encode())
                if doc % 50 == 0:
                    os.symlink("/etc/hostname", f"{at}/{doc}-link.txt")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    table(spark, sf_dir, "documents", ["doc_id", "text"]).mapInArrow(run, "n long").agg(F.sum("n")).first()
    os.makedirs(local, exist_ok=True)
    return local


def _name() -> Column:
    return F.regexp_extract("path", r"([^/]+)$", 1)


_SQL_NAME = "doc_id || CASE doc_id % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.md' ELSE '.TXT' END"


@query("files_listed", f"SELECT {_SQL_NAME} AS name, CAST(strlen(text) AS BIGINT) AS length, '.' || CASE WHEN doc_id % 3 = 1 THEN 'md' ELSE 'txt' END AS ext FROM documents")
def files_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, sizes and suffixes of the files of a tree, as discovery finds them; links that lead out are left out by the guard."""
    settings = Settings(input_dir=_folder(spark, sf_dir))
    return S.guarded(S.listed(spark, settings), settings)[0].select(_name().alias("name"), "length", S.extension(F.col("path")).alias("ext"))


@query("path_guard", "SELECT doc_id || '-link.txt' AS name, 'PathTraversal' AS error_class FROM documents WHERE doc_id % 50 = 0")
def path_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = Settings(input_dir=_folder(spark, sf_dir))
    refused = S.guarded(S.listed(spark, settings), settings)[1]
    return refused.withColumnRenamed("file_path", "path").select(_name().alias("name"), "error_class")


_READ = f"SELECT * FROM ({_BUCKETS}) WHERE CAST(file_path AS BIGINT) % 3 <> 1 UNION ALL SELECT * FROM ({_PARAGRAPHS}) WHERE CAST(file_path AS BIGINT) % 3 = 1"


@query("source_dispatch", f"SELECT CAST(file_path AS BIGINT) AS doc_id, section, text FROM ({_READ})")
def source_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file opened in a task and read by the reader of its suffix."""
    settings = Settings(input_dir=_folder(spark, sf_dir))
    read = read_all(S.guarded(S.listed(spark, settings), settings)[0], settings)
    return read.select(F.regexp_extract("file_path", r"(\d+)\.\w+$", 1).cast("long").alias("doc_id"), "section", "text")


@query("line_stream", r"SELECT doc_id, CAST(len(regexp_extract_all(regexp_replace(text, '\r\n?', chr(10), 'g'), '[^\n]*\n|[^\n]+')) AS INTEGER) AS lines, md5(regexp_replace(text, '\r\n?', chr(10), 'g')) AS hash FROM documents")
def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of files read a block at a time: their number and the hash of all of them."""
    settings = Settings(input_dir=_folder(spark, sf_dir), stream_chunk_bytes=512)
    files = S.guarded(S.listed(spark, settings), settings)[0].select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                with S.open_binary(path, settings.stream_chunk_bytes) as f:
                    n, h = 0, hashlib.md5()
                    for line in text_stream(f, settings):
                        n += 1
                        h.update(line.encode())
                    rows.append((int(os.path.basename(path).split(".")[0]), n, h.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int32(), pa.string()))], names=["doc_id", "lines", "hash"])

    return files.mapInArrow(run, "doc_id long, lines int, hash string")


class Echo:
    """An adapter that answers with a record."""

    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str:
        return '{"instruction": "i", "input": "", "output": "o"}'


_CLEAN = f"SELECT file_path, section, text FROM (SELECT file_path, section, {_FULL} AS text FROM ({_READ})) WHERE regexp_matches(text, '{_NW}')"
_COUNTS = f"""
WITH c AS (SELECT CAST(file_path AS BIGINT) AS doc_id, CAST(count(*) AS INTEGER) AS n FROM ({_CLEAN}) GROUP BY 1),
r AS (SELECT DISTINCT CAST(file_path AS BIGINT) AS doc_id FROM ({_READ}))
SELECT doc_id, CASE WHEN n > 0 THEN 'complete' ELSE 'failed' END AS status, n AS num_chunks, n AS num_records,
       CASE WHEN n > 0 THEN NULL WHEN r.doc_id IS NULL THEN 'No content extracted' ELSE 'Empty after normalisation' END AS error_msg
FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id)"""


def _whole(spark: SparkSession, sf_dir: str) -> Settings:
    """Settings of a run whose budget holds any text, so that SQL can tell the number of chunks."""
    at = _sink(spark, "run")
    return Settings(input_dir=_folder(spark, sf_dir), output_path=f"{at}/train.jsonl", checkpoint_dir=f"{at}/state", max_context_tokens=10_000_000)


@query("pipeline_states", _COUNTS)
def pipeline_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run from files to records, and the state that it leaves of each file; then a second run, which finds nothing new."""
    settings = _whole(spark, sf_dir)
    for now in ("1", "2"):
        Pipeline(spark, settings, Echo()).run(now)
    states = StateLog(spark, settings.checkpoint_dir).states().where("NOT file_path LIKE '%-link.txt'")
    return states.select(F.regexp_extract("file_path", r"(\d+)\.\w+$", 1).cast("long").alias("doc_id"), "status", "num_chunks", "num_records", "error_msg")


@query("pipeline_records", f"SELECT count(*) AS records, 'i' AS instruction, 'o' AS output, CAST(0 AS INTEGER) AS chunk_index FROM ({_CLEAN})")
def pipeline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of such a run, with the index of their chunk."""
    settings = _whole(spark, sf_dir)
    Pipeline(spark, settings, Echo()).run("1")
    found = spark.read.schema("instruction string, output string, chunk_index int").json(settings.output_path)
    return found.groupBy("instruction", "output", "chunk_index").agg(F.count("*").alias("records"))


@query("stream_chunks", f"SELECT CAST(file_path AS BIGINT) AS doc_id, section, text FROM ({_CLEAN})")
def stream_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a stream: chunks as they were written."""
    settings = _whole(spark, sf_dir)
    at = settings.checkpoint_dir.removesuffix("/state")
    chunk_stream(spark, settings.with_(allowed_extensions=(".txt", ".md"), max_file_bytes=400_000_000), f"{at}/chunks", f"{at}/stream", "t").awaitTermination()
    found = spark.read.parquet(f"{at}/chunks").where("NOT metadata.source_path LIKE '%-link.txt'")
    return found.select(F.regexp_extract("metadata.source_path", r"(\d+)\.\w+$", 1).cast("long").alias("doc_id"), F.col("metadata.page_or_section").alias("section"), "text")


@query("checkpoint_batch", "SELECT file_path, status, CASE WHEN status = 'complete' THEN num_chunks END AS num_chunks, 't' AS finished_at, CASE WHEN status = 'failed' THEN coalesce(error_msg, 'unknown') END AS error_msg FROM checkpoints")
def checkpoint_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files' states put into a log in one commit, compacted, and read again."""
    rows = table(spark, sf_dir, "checkpoints")
    log = StateLog(spark, _sink(spark, "state"))
    log.mark(rows.withColumn("error_msg", F.when(F.col("status") == "failed", F.coalesce("error_msg", F.lit("unknown")))), "t")
    log.compact()
    return log.states().select("file_path", "status", "num_chunks", "finished_at", "error_msg")


@query("settings_put_get", "SELECT key, value FROM run_metadata WHERE key <> 'tokenizer_name' UNION ALL SELECT 'tokenizer_name', 'other'")
def settings_put_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings put into the log, one of them twice."""
    log = StateLog(spark, _sink(spark, "state"))
    log.put_all(table(spark, sf_dir, "run_metadata"))
    log.put("tokenizer_name", "other")
    return log.values()


@query("checkpoint_reset", "SELECT CAST(0 AS BIGINT) AS states, CAST(0 AS BIGINT) AS keys")
def checkpoint_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = StateLog(spark, _sink(spark, "state"))
    log.append(table(spark, sf_dir, "checkpoints"))
    log.put("k", "v")
    log.reset()
    return spark.createDataFrame([(log.states().count(), log.values().count())], "states long, keys long")


@query("status_lookup", "SELECT max(CASE WHEN status = 'complete' THEN file_path END) AS file_path, TRUE AS complete, FALSE AS failed FROM checkpoints UNION ALL SELECT max(CASE WHEN status = 'failed' THEN file_path END), FALSE, TRUE FROM checkpoints UNION ALL SELECT 'none', FALSE, FALSE")
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookups: a complete file, a failed one, and one that is not there."""
    states = table(spark, sf_dir, "checkpoints")
    ends = states.groupBy("status").agg(F.max("file_path").alias("f"))  # a row for each status
    paths = [r["f"] for r in ends.collect()] + ["none"]
    return spark.createDataFrame([(p, has_status(states, p, "complete"), has_status(states, p, "failed")) for p in paths], "file_path string, complete boolean, failed boolean")


@query("sink_counts", "SELECT count(*) AS written, count(*) AS found, 'train' AS folder FROM alpaca_records")
def sink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records a sink says it wrote, how many are there, and the folder that a file's name gives."""
    at = _sink(spark, "counted")
    out = write_jsonl(table(spark, sf_dir, "alpaca_records", ["instruction", "output"]), at, Settings())
    found = spark.read.schema("instruction string").json(at).agg(F.count("*").alias("found"))
    return found.select(F.lit(out.records).alias("written"), "found", F.lit(os.path.basename(output_folder(f"{at}/train.jsonl"))).alias("folder"))
