"""Records out: JSONL or Parquet shards; records that fail the schema go to a folder of rejects."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.registry import register_writer
from foliospark.storage import written

#: The key a record of a schema must have.
REQUIRED = {"alpaca": "instruction", "sharegpt": "conversations"}


def valid(df: DataFrame, schema: str) -> Column:
    """Whether a record has its schema's key."""
    if schema not in REQUIRED:
        raise ValueError(f"unknown schema {schema!r}")
    return F.col(REQUIRED[schema]).isNotNull() if REQUIRED[schema] in df.columns else F.lit(False)


def split_valid(df: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    ok = valid(df, schema)
    return df.where(ok), df.where(~ok)


def output_folder(path: str) -> str:
    """``train.jsonl`` -> ``train``: shards lie in a folder named after the file."""
    head, _, name = path.rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name.strip(".") else name
    return f"{head}/{stem}" if head else stem


def shard_numbers(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """``shard`` of every row when rows are counted off in an order.

    No window over the whole table: rows are range-partitioned once, kept, and
    numbered within their partition behind the counts of the partitions before.
    """
    spread = written(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    counts = spread.groupBy("_p").agg(F.count("*").alias("n"))  # a row for each partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    numbered = spread.join(F.broadcast(counts.select("_p", before.alias("_before"))), "_p").withColumn("_n", within + F.col("_before"))
    return numbered.withColumn("shard", F.floor((F.col("_n") - 1) / rows).cast("int")).drop("_p", "_before", "_n")


@dataclass
class Written:
    """What a write came to."""

    path: str
    observation: Observation = field(default_factory=Observation)

    @property
    def records(self) -> int:
        return self.observation.get["records"]


def _counted(df: DataFrame, out: Written) -> DataFrame:
    return df.observe(out.observation, F.count(F.lit(1)).alias("records"))


@register_writer("jsonl")
def write_jsonl(df: DataFrame, path: str, settings: Settings) -> Written:
    """Append JSON lines, nulls written, other scripts unescaped; a job's files appear together or not at all."""
    out = Written(path)
    _counted(df, out).write.mode("append").option("ignoreNullFields", "false").option("maxRecordsPerFile", settings.rows_per_shard).json(path)
    return out


@register_writer("parquet", "huggingface")
def write_parquet(df: DataFrame, path: str, settings: Settings) -> Written:
    """Append Parquet shards of bounded length; names are unique, so a later run replaces nothing."""
    out = Written(output_folder(path))
    _counted(df, out).write.mode("append").option("maxRecordsPerFile", settings.rows_per_shard).parquet(out.path)
    return out
