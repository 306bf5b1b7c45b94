"""Row types shared by all stages."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType

METADATA = StructType(
    [
        StructField("source_path", StringType()),
        StructField("page_or_section", StringType()),
        StructField("timestamp", StringType()),
        StructField("extra", MapType(StringType(), StringType())),
    ]
)
FRAGMENT = StructType([StructField("text", StringType()), StructField("metadata", METADATA), StructField("chunk_index", IntegerType())])
#: What a reader of files emits: a fragment, or an error of its file.
READ = StructType(
    [
        StructField("file_path", StringType()),
        StructField("section", StringType()),
        StructField("text", StringType()),
        StructField("extra", MapType(StringType(), StringType())),
        StructField("error_class", StringType()),
        StructField("error_msg", StringType()),
    ]
)
FILE = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()), StructField("length", LongType()), StructField("content", BinaryType())])
ALPACA = StructType([StructField("instruction", StringType()), StructField("input", StringType()), StructField("output", StringType())])
SHAREGPT = StructType([StructField("conversations", ArrayType(StructType([StructField("from", StringType()), StructField("value", StringType())])))])
CHECKPOINT = StructType(
    [
        StructField("file_path", StringType()),
        StructField("status", StringType()),
        StructField("num_chunks", IntegerType()),
        StructField("num_records", IntegerType()),
        StructField("finished_at", StringType()),
        StructField("error_msg", StringType()),
        StructField("seq", LongType()),
        # The last completion and the last failure up to this row.
        StructField("completion", StructType([StructField("seq", LongType()), StructField("num_chunks", IntegerType()), StructField("num_records", IntegerType())])),
        StructField("failure", StructType([StructField("seq", LongType()), StructField("error_msg", StringType())])),
    ]
)
KEY_VALUE = StructType([StructField("key", StringType()), StructField("value", StringType()), StructField("seq", LongType())])
