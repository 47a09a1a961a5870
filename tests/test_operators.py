"""Distributed helpers: ids, exact median, key-only scans, pipeline invariants."""

import random
import statistics
from decimal import Decimal

from pyspark.sql import functions as F

from farelake.functions.money import exact_median
from farelake.operators import silver
from farelake.operators.ids import assign_ids, with_positions
from farelake.sources.fixture import fixture_bronze
from tests.conftest import SF_SMALL


def test_assign_ids_dense_in_scan_order(spark, scratch):
    n = 5000
    spark.range(n).repartition(7).sortWithinPartitions("id").write.parquet(scratch + "/r")
    with_positions(spark.read.parquet(scratch + "/r").withColumnRenamed("id", "v")).write.parquet(scratch + "/p")
    out = assign_ids(spark.read.parquet(scratch + "/p"), start=100).select("id", F.spark_partition_id().alias("p"), "v")
    ids = [r.id for r in out.collect()]
    assert sorted(ids) == list(range(101, 101 + n))
    # ids increase along each partition's scan order
    for p in {r.p for r in out.select("p").distinct().collect()}:
        part = [r.id for r in out.where(F.col("p") == p).collect()]
        assert part == sorted(part)


def test_exact_median_matches_python(spark):
    rnd = random.Random(7)
    rows = [(k, Decimal(rnd.randint(0, 400)) / 4) for k in "abc" for _ in range(rnd.randint(1, 60))]
    df = spark.createDataFrame(rows, "k string, v decimal(18,6)")
    got = {r.k: float(r.median) for r in exact_median(df, ["k"], "v").collect()}
    for k in "abc":
        assert got[k] == float(statistics.median([v for kk, v in rows if kk == k]))


def test_exact_median_with_all_values_close_together_and_null_keys(spark):
    rnd = random.Random(8)
    rows = [("a", Decimal(rnd.randint(0, 99999)) / 1000 + 5000) for _ in range(3000)]
    df = spark.createDataFrame(rows + [(None, Decimal(1))], "k string, v decimal(18,6)")
    got = {r.k: float(r.median) for r in exact_median(df, ["k"], "v").collect()}
    assert got == {"a": float(statistics.median(v for _, v in rows)), None: 1.0}


def test_ids_of_a_selection_are_dense(spark, scratch):
    with_positions(spark.range(0, 1000, 1, 5).withColumnRenamed("id", "v")).write.parquet(scratch + "/p")
    some = spark.read.parquet(scratch + "/p").where(F.col("v") % 7 == 0)
    rows = assign_ids(some, start=10, all_rows=False).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(11, 11 + 143))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_stg_and_rejections_within_bronze(spark):
    bronze = fixture_bronze(spark, SF_SMALL)
    ids = bronze.select(F.col("id").alias("bronze_id"))
    stg = silver.stg_bookings(bronze).select("bronze_id")
    failed = silver.validation_failures(bronze).select("bronze_id")
    assert stg.union(failed).join(ids, "bronze_id", "left_anti").count() == 0
    assert stg.join(failed, "bronze_id").count() == 0


def test_assign_ids_follow_line_order_of_a_split_file(spark, scratch):
    n = 20000
    path = scratch + "/lines.csv"
    with open(path, "w") as f:
        f.write("seq,pad\n")
        for i in range(n):
            f.write(f"{i},{'x' * 40}\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "65536")          # about a dozen splits of one file
    try:
        df = spark.read.option("header", True).csv(path)
        assert df.rdd.getNumPartitions() > 4
        with_positions(df).write.parquet(scratch + "/positions")
        out = assign_ids(spark.read.parquet(scratch + "/positions"), start=0).select("id", F.col("seq").cast("long").alias("seq"))
        assert out.where(F.col("id") != F.col("seq") + 1).count() == 0
        assert out.count() == n
    finally:
        spark.conf.set(key, old)


def test_new_rows_by_each_way(spark, scratch, monkeypatch):
    """Few new keys, few known ones, or many of both: the same rows; where either is few, no whole row is shuffled."""
    from farelake.operators import changes
    rows = [(i, f"h{i % 40}" if i % 7 else None) for i in range(100)]
    spark.createDataFrame(rows, "n long, row_hash string").write.parquet(scratch + "/b")
    batch = spark.read.parquet(scratch + "/b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for known, limit, how in ((range(38), 5, "LeftSemi"), (range(2), 5, "LeftAnti"), (range(20), 5, None), ((), 5, "LeftAnti"), (range(40), 0, None)):
            path = f"{scratch}/t{len(known)}-{limit}"
            spark.createDataFrame([(f"h{k}",) for k in known] * 2 + [(None,)], "row_hash string").write.parquet(path)
            monkeypatch.setattr(changes, "BROADCAST_KEYS", limit)
            q = changes.new_rows(batch, spark.read.parquet(path))
            want = [n for n, h in rows if h is None or int(h[1:]) not in known]
            assert sorted(r.n for r in q.collect()) == want, (known, limit)
            text = q._jdf.queryExecution().executedPlan().toString()
            assert how is None or ("SortMergeJoin" not in text and f"{how}, BuildRight" in text), (known, limit)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_hashes_that_are_no_digests(spark):
    from farelake.operators import bronze as B
    texts = ["ab" * 16, "AB" * 16, "ab" * 16, None, "", " ", "x", "61" * 16, "a" * 16, "a" * 16]
    row = B.duplicate_hash_metric(spark.createDataFrame([(t,) for t in texts], "row_hash string")).first()
    assert (row.total_rows, row.distinct_hashes, row.duplicate_rows) == (10, 7, 3)


def test_fact_of_some_columns(spark):
    from farelake.operators import dims, silver
    from farelake.operators.fact import fact_bookings
    from tests.helpers import booking, bronze_df
    stg = silver.stg_bookings(bronze_df(spark, [booking(1), booking(2, airline="Air Two", base_fare_bdt="50")]))
    columns = ("booking_id", "airline_key", "tax_percentage")
    some = fact_bookings(stg.select("bronze_id", "airline", "source_code", "destination_code", "base_fare_bdt", "tax_surcharge_bdt"),
                         dims.dim_route(stg), columns=columns)
    assert set(some.columns) == set(columns)
    assert sorted(some.select(*columns).collect()) == sorted(fact_bookings(stg).select(*columns).collect())
