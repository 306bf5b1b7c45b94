"""A whole run: files -> fragments -> clean -> chunks -> answers -> records, with resume.

Every stage is one lazy frame. The driver commits in this order: what was read
and what was answered to the shared folder, records to the sink, then the
states of their files. A run that dies before the last step does its files
again. What it put into the shared folder goes when the run ends.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.functions.text import Transform
from foliospark.functions.tokens import tokenizer_path
from foliospark.operators import records as R
from foliospark.operators.chunk import chunked
from foliospark.operators.generate import Adapter, adapter_of, answers, spread
from foliospark.operators.normalize import normalized
from foliospark.operators.state import StateLog, completed
from foliospark.registry import readers, writers
from foliospark.sinks.writers import Written, split_valid
from foliospark.sources import files as S
from foliospark.sources.readers import as_fragments, read_all
from foliospark.storage import scratch, written

#: Bytes of files that a task opens.
TASK_BYTES = 256 * 1024 * 1024


@dataclass
class Outcome:
    records: int
    rejects: int
    completed_files: int
    failed_files: int


class Pipeline:
    def __init__(
        self,
        spark: SparkSession,
        settings: Settings | None = None,
        adapter: Adapter | None = None,
        prompt: Callable[[Column], Column] = R.prompt,
        parser: Callable[[str | None], dict] | None = None,
        transforms: tuple[Transform, ...] | None = None,
        writer: Callable[[DataFrame, str, Settings], Written] | None = None,
    ) -> None:
        self.spark, self.settings = spark, settings or Settings()
        self.adapter, self.prompt, self.parser, self.transforms, self.writer = adapter, prompt, parser, transforms, writer
        self.state = StateLog(spark, self.settings.checkpoint_dir)

    def pending(self) -> DataFrame:
        """Paths and sizes of the files still to do; their content is not read for this."""
        return S.pending(S.listed(self.spark, self.settings), completed(self.state.states()))

    def read(self, pending: DataFrame) -> DataFrame:
        """What the readers find in the pending files, and the errors of those that may not be read.

        The list of paths is spread over tasks by the bytes behind it; each task opens its files.
        """
        total, bytes_ = pending.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        tasks = min(total, max(self.spark.sparkContext.defaultParallelism, -(-bytes_ // TASK_BYTES))) or 1
        ok, refused = S.guarded(pending.repartition(tasks, F.xxhash64("path")), self.settings)
        none = [F.lit(None).cast(t).alias(n) for n, t in (("section", "string"), ("text", "string"), ("extra", "map<string,string>"))]
        return read_all(ok, self.settings).unionByName(refused.select("file_path", *none, "error_class", "error_msg"))

    def chunks(self, fragments: DataFrame) -> DataFrame:
        s = self.settings
        return chunked(normalized(fragments, self.transforms), s.chunk_budget, s.chunk_overlap_tokens, tokenizer=tokenizer_path(s.tokenizer_name, s.tokenizer_files))

    def run(self, now: str | None = None) -> Outcome:
        """One run over all that is pending; a second one finds only failed and new files."""
        with scratch(self.spark):
            return self._run(now or datetime.now(timezone.utc).isoformat())

    def _run(self, now: str) -> Outcome:
        s = self.settings
        pending = written(self.pending(), "pending")
        if pending.isEmpty():
            return Outcome(0, 0, 0, 0)
        read = written(self.read(pending), "read")
        asked = self.chunks(as_fragments(read, now)).withColumn("prompt", self.prompt(F.col("text"))).drop("text")
        # Calls are made once and kept with what was parsed of them; prompts are not.
        raw = answers(spread(asked, s), self.adapter or adapter_of(s), s).drop("prompt")
        made = R.alpaca(raw.withColumnRenamed("error_class", "_call").withColumn("answer", R.parse_answers(F.col("raw"), self.parser)), keep=["_call", F.col("metadata.source_path").alias("_path")])
        made = written(made, "records")
        done = made.where("_call IS NULL")
        ok, bad = split_valid(done.where("error_class IS NULL").drop("error_class", "_call", "_path"), "alpaca")
        rejects = bad.count() + done.where("error_class IS NOT NULL").count()
        if s.jsonl_schema == "sharegpt":
            ok = ok.select(R.sharegpt(F.col("instruction"), F.col("input"), F.col("output")).alias("conversations"), "_metadata", "chunk_index")
        out = (self.writer or writers.get(s.output_format))(ok, s.output_path, s)
        states = written(self._states(pending, read, made), "states")
        self.state.mark(states, now)
        n = states.agg(F.count_if(F.col("error_msg").isNull()).alias("c"), F.count_if(F.col("error_msg").isNotNull()).alias("f")).first()
        return Outcome(out.records, rejects, n["c"], n["f"])

    def _states(self, pending: DataFrame, read: DataFrame, made: DataFrame) -> DataFrame:
        """Per pending file its counts, or why it failed."""
        seen = read.groupBy(F.col("file_path").alias("path")).agg(F.count_if(F.col("error_class").isNull()).alias("found"), F.max(F.concat_ws(": ", "error_class", "error_msg")).alias("error"))
        record = F.when(F.col("_call").isNull() & F.col("error_class").isNull(), F.lit(1))
        counts = per_file_counts(made.withColumnRenamed("_path", "file_path"), record).withColumnRenamed("file_path", "path")
        unknown = ~S.extension(F.col("path")).isin(*readers.keys())
        all_ = pending.join(seen, "path", "left").join(counts, "path", "left")
        why = (
            F.when(unknown, F.concat(F.lit("Unsupported extension: "), S.extension(F.col("path"))))
            .when(F.coalesce("found", F.lit(0)) == 0, F.coalesce(F.nullif("error", F.lit("")), F.lit("No content extracted")))
            .when(F.col("num_chunks").isNull(), F.lit("Empty after normalisation"))
        )
        return all_.select(F.col("path").alias("file_path"), F.coalesce("num_chunks", F.lit(0)).alias("num_chunks"), F.coalesce("num_records", F.lit(0)).alias("num_records"), why.alias("error_msg"))


def per_file_counts(chunks: DataFrame, record: Column) -> DataFrame:
    """``file_path, num_chunks, num_records`` of chunks with their results side by side."""
    return chunks.groupBy("file_path").agg(F.count("*").cast("int").alias("num_chunks"), F.count_if(record.isNotNull()).cast("int").alias("num_records"))
