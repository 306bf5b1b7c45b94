"""The resume contract as a stream: each file once, output and states together per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliospark.config import Settings
from foliospark.functions.tokens import tokenizer_path
from foliospark.operators.chunk import chunked
from foliospark.operators.normalize import normalized
from foliospark.operators.state import StateLog
from foliospark.schema import FILE
from foliospark.sources.files import any_case, guarded
from foliospark.sources.readers import as_fragments, read_all
from foliospark.storage import scratch, written


def chunk_stream(spark: SparkSession, settings: Settings, output: str, checkpoint: str, run_timestamp: str) -> StreamingQuery:
    """Read new files of all formats as they come, write their chunks as Parquet, note their states; stops when nothing is new.

    A file source offers a file once. Files that failed are found in the log of
    states, which stays the source of truth for another run. Suffixes are taken
    in any case; files above the size limit are noted and not read.
    """
    log = StateLog(spark, settings.checkpoint_dir)
    globs = ",".join(any_case(e) for e in settings.allowed_extensions)
    source = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true").option("pathGlobFilter", f"{{{globs}}}").load(settings.input_dir)
    tokenizer = tokenizer_path(settings.tokenizer_name, settings.tokenizer_files)

    def batch(files: DataFrame, number: int) -> None:
        # Columns are pruned at the scan, so states do not read contents; what the readers find is read once and kept.
        with scratch(spark):
            ok, refused = guarded(files, settings)
            read = written(read_all(ok.select("path", "content"), settings), "read")
            chunks = chunked(normalized(as_fragments(read, run_timestamp)), settings.chunk_budget, settings.chunk_overlap_tokens, tokenizer=tokenizer)
            # The batch number names the folder: a batch that is run again replaces what it left.
            chunks.write.mode("overwrite").parquet(f"{output}/batch={number}")
            done = spark.read.parquet(f"{output}/batch={number}").groupBy(F.col("metadata.source_path").alias("file_path")).agg(F.count("*").cast("int").alias("num_chunks"))
            errors = refused.unionByName(read.where("error_class IS NOT NULL").select("file_path", "error_class", "error_msg"))
            why = errors.groupBy("file_path").agg(F.max(F.concat_ws(": ", "error_class", "error_msg")).alias("why"))
            states = files.select(F.col("path").alias("file_path")).join(done, "file_path", "left").join(why, "file_path", "left")
            failed = F.when(F.col("num_chunks").isNull(), F.coalesce("why", F.lit("No content extracted")))
            log.mark(states.select("file_path", "num_chunks", F.lit(0).alias("num_records"), failed.alias("error_msg")), run_timestamp)

    return source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
