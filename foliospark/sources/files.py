"""Which files there are, and which of them may be read."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.errors import CorruptedFile, FileTooLarge, PathTraversal
from foliospark.storage import written


def extension(path: Column) -> Column:
    """Lower-case suffix of the file's name with its dot; empty if it has none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def any_case(ext: str) -> str:
    """A glob for files of this suffix in any case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def root_of(settings: Settings) -> str:
    """The input folder as a URI without a slash at its end; one that is not there is refused."""
    if "://" in settings.input_dir:
        return settings.input_dir.rstrip("/")
    if not os.path.isdir(settings.input_dir):
        raise NotADirectoryError(settings.input_dir)
    return "file:" + settings.resolved_input_dir


def _local(path: str) -> str | None:
    """``file:/a``, ``file:///a`` and ``/a`` as ``/a``; None for other file systems."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path if "://" not in path else None


def open_binary(path: str, block: int):
    """A file of any file system as a seekable binary stream, read in blocks."""
    local = _local(path)
    if local is not None:
        return open(local, "rb", buffering=max(block, 2))
    found, inner = pafs.FileSystem.from_uri(path)
    return found.open_input_file(inner)


def _entries(folder: str, root: str) -> Iterator[tuple[str, bool, int, bool]]:
    """(path, whether a folder, bytes, whether outside the root) of what is in a folder; linked folders are not entered."""
    local = _local(folder)
    if local is None:
        found, inner = pafs.FileSystem.from_uri(folder)
        for e in found.get_file_info(pafs.FileSelector(inner)):
            yield f"{folder}/{e.base_name}", e.type == pafs.FileType.Directory, e.size or 0, False
        return
    base = _local(root)
    with os.scandir(local) as it:
        for e in it:
            try:
                if e.is_dir():
                    if not e.is_symlink():
                        yield f"file:{e.path}", True, 0, False
                elif e.is_file():
                    yield f"file:{e.path}", False, e.stat().st_size, e.is_symlink() and not inside(base, e.path)
            except OSError:  # gone since it was listed
                continue


_LISTED = "path string, folder boolean, length long, outside boolean"


def listed(spark: SparkSession, settings: Settings) -> DataFrame:
    """``path, length, outside`` of the files below the input folder with an allowed extension.

    Folders are listed in tasks, a level of the tree at a time; names go from
    there to the shared folder and never through the driver. ``outside`` marks
    links that lead out of the input folder.
    """
    root = root_of(settings)
    allowed = tuple(e.lower() for e in settings.allowed_extensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder in b.column(0).to_pylist():
                entries = ((p, d, n, o) for p, d, n, o in _entries(folder, root) if d or os.path.splitext(p)[1].lower() in allowed)
                while rows := list(islice(entries, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.bool_(), pa.int64(), pa.bool_()))], names=["path", "folder", "length", "outside"])

    level, found = spark.createDataFrame([(root,)], "path string"), []
    while True:
        # A given number of partitions, so that a level of few folders is not put into one task.
        seen = written(level.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(run, _LISTED), "listing")
        found.append(seen.where("NOT folder").select("path", "length", "outside"))
        level = seen.where("folder").select("path")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def contents(files: DataFrame, settings: Settings) -> DataFrame:
    """``path, content, error_class, error_msg``: each file opened and read in the task that has its path, so no content is shuffled."""
    block = settings.stream_chunk_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                raw = kind = why = None
                try:
                    with open_binary(path, block) as f:
                        raw = f.read()
                except OSError as e:
                    kind, why = CorruptedFile.__name__, str(e)[:500]
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([raw], pa.binary()), pa.array([kind], pa.string()), pa.array([why], pa.string())], names=["path", "content", "error_class", "error_msg"])

    return files.select("path").mapInArrow(run, "path string, content binary, error_class string, error_msg string")


def guarded(files: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(files that may be read, errors of the others): a file of exactly the limit passes, a link out of the input folder does not."""
    left = F.col("outside") if "outside" in files.columns else F.lit(False)
    over = F.coalesce(F.col("length") > settings.max_file_bytes, F.lit(False))
    kind = F.when(left, PathTraversal.__name__).otherwise(FileTooLarge.__name__)
    why = F.when(left, "leads out of the input folder").otherwise(F.format_string("%d bytes exceed the limit", "length"))
    errors = files.where(left | over).select(F.col("path").alias("file_path"), kind.alias("error_class"), why.alias("error_msg"))
    return files.where(~left & ~over), errors


def pending(files: DataFrame, completed: DataFrame) -> DataFrame:
    """Files that no run has completed: a left anti join on the path."""
    return files.join(completed.select(F.col("file_path").alias("path")).distinct(), "path", "left_anti")


def counts(files: DataFrame, completed: DataFrame) -> DataFrame:
    """``discovered, done, pending`` of a listing: one row."""
    done = completed.select(F.col("file_path").alias("path")).distinct().withColumn("_done", F.lit(1))
    return files.join(done, "path", "left").agg(F.count("*").alias("discovered"), F.count("_done").alias("done"), (F.count("*") - F.count("_done")).alias("pending"))


def in_order(files: DataFrame) -> DataFrame:
    """By path, as bytes."""
    return files.orderBy("path")


def inside(root: str, path: str) -> bool:
    base = os.path.realpath(root)
    return os.path.commonpath([base, os.path.realpath(path)]) == base


def safe_resolve(raw: str, settings: Settings) -> str:
    """A path given from outside, below the input folder with all links followed; else ``PathTraversal``."""
    path = os.path.realpath(os.path.join(settings.resolved_input_dir, raw))
    if not inside(settings.resolved_input_dir, path):
        raise PathTraversal(raw)
    return path


def validate_path(path: str, settings: Settings) -> str:
    """A local file: there, regular, below the input folder, within the size limit."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    if not os.path.isfile(path):
        raise IsADirectoryError(path)
    if not inside(settings.resolved_input_dir, path):
        raise PathTraversal(path)
    if os.path.getsize(path) > settings.max_file_bytes:
        raise FileTooLarge(path)
    return os.path.realpath(path)


def binary_chunks(path: str, size: int = 65_536) -> Iterator[bytes]:
    """A local file in blocks, for hashing on the driver; on data frames ``sha2(content, 256)`` does it."""
    with open(path, "rb") as f:
        while block := f.read(size):
            yield block


def line_stream(path: str, settings: Settings) -> Iterator[str]:
    """Lines of a text file without their ends, decoded by the fallback chain, a block at a time."""
    from foliospark.sources.readers import text_stream

    with open_binary(path, settings.stream_chunk_bytes) as f:
        for line in text_stream(f, settings):
            yield line.removesuffix("\n")
