"""Lake tables: versions, atomic overwrite, appends, reading while rewriting."""

import pytest
from pyspark.sql import functions as F

from farelake.sources.lake import Lake


def test_failed_overwrite_keeps_previous_version(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    lake.write(spark.range(5), "t")
    bad = spark.range(5).select(F.col("id"), F.assert_true(F.col("id") < 3).alias("boom"))
    with pytest.raises(Exception):
        lake.write(bad, "t")
    assert sorted(r.id for r in lake.read("t").collect()) == [0, 1, 2, 3, 4]
    # a fresh instance (another process) sees the same committed version
    assert Lake(spark, scratch + "/lake").read("t").count() == 5


def test_rewrite_from_itself_and_append(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    lake.write(spark.range(3), "t")
    lake.write(lake.read("t").withColumn("id", F.col("id") * 10), "t")   # reads v1, writes v2
    assert sorted(r.id for r in lake.read("t").collect()) == [0, 10, 20]
    lake.write(spark.range(2).withColumn("id", F.col("id") + 100), "t", mode="append")
    assert sorted(r.id for r in lake.read("t").collect()) == [0, 10, 20, 100, 101]
