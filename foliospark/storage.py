"""Reading tables and cutting lineage in storage that every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table of the data directory, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh local one only where that is unset and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="foliospark-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        named = "file://" + local
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Later stages restart from these files when an executor is lost, and what
    made them is not computed again. They stay until ``clean``, for results
    are lazy and may still read them.
    """
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for kept in _KEPT:
        kept.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is ``written`` within goes at the end: for work whose results are complete by then."""
    mine: list[str] = []
    _KEPT.append(mine)
    try:
        yield
    finally:
        _KEPT.remove(mine)
        for path in mine:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clean(spark: SparkSession) -> None:
    """Delete what ``written`` left in this application; call it when no result is to be read any more."""
    _delete(spark, _own_dir(spark))


def once(c: Column) -> Column:
    """``c``, computed where it stands: a filter on it is not pushed below, which would compute a costly expression twice.

    Catalyst moves no predicate through a projection with a value that it takes
    for one that changes; the partition's number is the cheapest of those.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no further than that."""
    return df.limit(rows + 1).count() <= rows
