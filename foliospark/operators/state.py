"""What was processed: an append-only log of states, and its latest view.

Spark has no MERGE on plain Parquet. Each run appends one row per file and the
view takes the last of each file. A row also carries the last completion and the
last failure with their numbers, so that one row per file, which is what
compaction leaves, answers both views as the whole log did.

On disk the log is a row of generations: ``checkpoints/<n>/base``, what the last
compaction wrote, and ``checkpoints/<n>/tail``, what was appended since. The
highest ``<n>.ready`` names the one in use; the file is made after all of its
base is there, so a crash at any moment leaves one generation whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.schema import CHECKPOINT, KEY_VALUE

COMPLETE, FAILED = "complete", "failed"
_NAMED = ("status", "num_chunks", "num_records", "finished_at", "error_msg")


def carried(log: DataFrame) -> DataFrame:
    """The log with ``completion`` and ``failure``, made from the row itself where the log has none."""
    made = {
        "completion": F.when(F.col("status") == COMPLETE, F.struct("seq", "num_chunks", "num_records")),
        "failure": F.when(F.col("status") == FAILED, F.struct("seq", "error_msg")),
    }
    return log.withColumns({k: v for k, v in made.items() if k not in log.columns})


def _merged(log: DataFrame) -> DataFrame:
    """One row per file that stands for all of its rows."""
    last: Column = F.max_by(F.struct(*_NAMED), F.col("seq")).alias("s")
    return carried(log).groupBy("file_path").agg(last, F.max("seq").alias("seq"), F.max_by("completion", "completion.seq").alias("completion"), F.max_by("failure", "failure.seq").alias("failure"))


def latest(log: DataFrame, sticky: bool = False) -> DataFrame:
    """One row per file, the last by ``seq``.

    ``sticky`` keeps what an upsert would: the last error although the file is
    complete by now, and the counts of the last completion although it failed.
    """
    if not sticky:
        return log.groupBy("file_path").agg(F.max_by(F.struct(*_NAMED), F.col("seq")).alias("s")).select("file_path", "s.*")
    kept = (F.col("completion.num_chunks"), F.col("completion.num_records"), F.col("s.finished_at"), F.col("failure.error_msg"))
    return _merged(log).select("file_path", "s.status", *[c.alias(n) for c, n in zip(kept, _NAMED[1:])])


def compacted(log: DataFrame) -> DataFrame:
    """A log of one row per file with the same two views."""
    return _merged(log).select("file_path", "s.*", "seq", "completion", "failure")


def completed(states: DataFrame) -> DataFrame:
    return states.where(F.col("status") == COMPLETE).select("file_path")


def stats(states: DataFrame) -> DataFrame:
    """``total, complete, failed`` in one pass."""
    return states.agg(F.count("*").alias("total"), F.count_if(F.col("status") == COMPLETE).alias("complete"), F.count_if(F.col("status") == FAILED).alias("failed"))


def has_status(states: DataFrame, file_path: str, status: str) -> bool:
    """A point lookup that reads no further than the first hit."""
    return not states.where((F.col("file_path") == file_path) & (F.col("status") == status)).limit(1).isEmpty()


def last_values(kv: DataFrame) -> DataFrame:
    """``key, value``: of each key its last value by ``seq``, null if that was null."""
    return kv.groupBy("key").agg(F.max_by(F.struct("value"), "seq").alias("v")).select("key", "v.value")


class StateLog:
    """The log in a folder. One driver appends at a time; a batch is one atomic commit."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, path: str, schema) -> DataFrame:
        hadoop, fs = self._fs(path)
        return self.spark.read.schema(schema).parquet(path) if fs.exists(hadoop) else self.spark.createDataFrame([], schema)

    def generation(self) -> int:
        """The one in use; 0 has no base."""
        hadoop, fs = self._fs(f"{self.folder}/checkpoints")
        if not fs.exists(hadoop):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
        return max((int(n.removesuffix(".ready")) for n in names if n.endswith(".ready")), default=0)

    def log(self) -> DataFrame:
        at = f"{self.folder}/checkpoints/{self.generation()}"
        return self._read(f"{at}/base", CHECKPOINT).unionByName(self._read(f"{at}/tail", CHECKPOINT))

    def states(self, sticky: bool = False) -> DataFrame:
        return latest(self.log(), sticky)

    def _next(self, log: DataFrame) -> int:
        return (log.agg(F.max("seq")).first()[0] or 0) + 1

    def append(self, rows: DataFrame) -> None:
        """Rows with the columns of the log that a state has: one atomic commit for the batch."""
        numbered = carried(rows.withColumn("seq", F.lit(self._next(self.log())).cast("long")))
        numbered.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CHECKPOINT.fields]).write.mode("append").parquet(f"{self.folder}/checkpoints/{self.generation()}/tail")

    def mark_complete(self, rows: DataFrame, finished_at: str) -> None:
        """``file_path, num_chunks, num_records`` of files that are done, many at once."""
        self.append(rows.select("file_path", F.lit(COMPLETE).alias("status"), "num_chunks", "num_records", F.lit(finished_at).alias("finished_at"), F.lit(None).cast("string").alias("error_msg")))

    def mark_failed(self, rows: DataFrame, finished_at: str) -> None:
        """``file_path, error_msg`` of files that failed; the next run tries them again."""
        none = F.lit(None).cast("int")
        self.append(rows.select("file_path", F.lit(FAILED).alias("status"), none.alias("num_chunks"), none.alias("num_records"), F.lit(finished_at).alias("finished_at"), "error_msg"))

    def mark(self, rows: DataFrame, finished_at: str) -> None:
        """``file_path, num_chunks, num_records, error_msg`` of complete and failed files in one commit: failed are those with a message."""
        failed = F.col("error_msg").isNotNull()
        counts = [F.when(~failed, F.col(c)).alias(c) for c in ("num_chunks", "num_records")]
        self.append(rows.select("file_path", F.when(failed, FAILED).otherwise(COMPLETE).alias("status"), *counts, F.lit(finished_at).alias("finished_at"), "error_msg"))

    def is_complete(self, file_path: str) -> bool:
        return has_status(self.states(), file_path, COMPLETE)

    def is_failed(self, file_path: str) -> bool:
        return has_status(self.states(), file_path, FAILED)

    def compact(self) -> None:
        """Write the log as one row per file into a new generation, then name that the one in use.

        The generation before stays for those who still read it and goes with
        the next compaction; what a crash left of an unready one is replaced.
        """
        now = self.generation()
        fresh = f"{self.folder}/checkpoints/{now + 1}"
        compacted(self.log()).write.mode("overwrite").parquet(f"{fresh}/base")
        hadoop, fs = self._fs(f"{self.folder}/checkpoints/{now + 1}.ready")
        fs.create(hadoop, True).close()
        for old in (f"{now - 1}.ready", f"{now - 1}"):
            hadoop, fs = self._fs(f"{self.folder}/checkpoints/{old}")
            fs.delete(hadoop, True)

    def put(self, key: str, value: str | None) -> None:
        kv = self._read(f"{self.folder}/run_metadata", KEY_VALUE)
        self.put_all(self.spark.createDataFrame([(key, value)], "key string, value string"), kv)

    def put_all(self, rows: DataFrame, kv: DataFrame | None = None) -> None:
        """``key, value`` of many settings in one commit."""
        at = self._next(self._read(f"{self.folder}/run_metadata", KEY_VALUE) if kv is None else kv)
        rows.select("key", "value", F.lit(at).cast("long").alias("seq")).write.mode("append").parquet(f"{self.folder}/run_metadata")

    def values(self) -> DataFrame:
        return last_values(self._read(f"{self.folder}/run_metadata", KEY_VALUE))

    def get(self, key: str) -> str | None:
        row = self.values().where(F.col("key") == key).first()
        return row["value"] if row else None

    def reset(self) -> None:
        """Forget everything."""
        for name in ("checkpoints", "run_metadata"):
            hadoop, fs = self._fs(f"{self.folder}/{name}")
            fs.delete(hadoop, True)
