"""Shared files, sizes and the guard against double evaluation."""

import os

from pyspark.sql import functions as F

from foliospark.storage import clean, once, shared_dir, small_enough, written


def test_written_is_read_back_and_cleaned(spark):
    df = written(spark.range(10).withColumn("s", F.lit(None).cast("string")), "numbers")
    assert df.count() == 10 and df.dtypes == [("id", "bigint"), ("s", "string")] and "Range" not in df._jdf.queryExecution().toString()
    own = f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}".removeprefix("file://")
    assert any(x.startswith("numbers-") for x in os.listdir(own))
    clean(spark)
    assert not os.path.exists(own)
    assert written(spark.range(0), "none").count() == 0


def test_small_enough(spark):
    assert small_enough(spark.range(5), 5) and not small_enough(spark.range(6), 5) and small_enough(spark.range(0), 0)


def test_once_keeps_a_filter_above(spark):
    costly = F.regexp_replace(F.col("id").cast("string"), "[13579]", "")
    plain = spark.range(9).withColumn("x", costly).where("x <> ''")
    held = spark.range(9).withColumn("x", once(costly)).where("x <> ''")
    uses = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")
    assert uses(plain) == 2 and uses(held) == 1 and sorted(plain.collect()) == sorted(held.collect())
