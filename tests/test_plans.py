"""Physical-plan shape: pushdown, pruning, rank-limit, no cartesian products."""

from farelake.operators import bronze as B
from farelake.operators import changes, silver
from farelake.plans import queries as Q
from farelake.sources.fixture import fixture_bronze
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_is_rank_limited_before_shuffle(spark, scratch):
    fixture_bronze(spark, SF_SMALL).write.parquet(scratch + "/b")
    bronze = spark.read.parquet(scratch + "/b")
    text = silver.stg_bookings(bronze)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "PushedFilters: [IsNotNull(airline), IsNotNull(source_code), IsNotNull(destination_code)" in text


def test_key_only_scan_of_target(spark, scratch):
    B.with_row_hash(fixture_bronze(spark, SF_SMALL)).write.parquet(scratch + "/t")
    target = spark.read.parquet(scratch + "/t")
    batch = target.limit(10)
    text = changes.new_rows(batch, target)._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<row_hash:string>" in text


def test_no_cartesian_products_in_gold(spark):
    for name in ("kpi_avg_fare", "kpi_booking_count", "kpi_popular_routes", "kpi_seasonal",
                 "report_layer_counts"):
        text = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_incremental_target_scan_is_pruned(spark, scratch):
    from pyspark.sql import functions as F
    from farelake.functions.dates import departure_month
    t = (B.with_row_hash(fixture_bronze(spark, SF_SMALL))
         .withColumn("departure_month", departure_month("departure_datetime")))
    t.write.partitionBy("departure_month").parquet(scratch + "/t")
    target = spark.read.parquet(scratch + "/t")
    t.where(F.col("departure_month") == "1995-03").write.parquet(scratch + "/batch")
    q = changes.new_rows(spark.read.parquet(scratch + "/batch"), target, prune_by="departure_month")
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert q.count() == 0


def test_median_shuffles_its_bracket_only(spark, scratch):
    """One scan for the sketch, one to select: of a million values, some thousands are shuffled by value."""
    from pyspark.sql import functions as F
    from farelake.functions import money as M
    spark.range(1_000_000).select((F.col("id") % 3).cast("string").alias("k"),
                                  F.col("id").cast("decimal(18,6)").alias("v")).write.parquet(scratch + "/f")
    fact = spark.read.parquet(scratch + "/f")
    q = M.exact_median(fact, ["k"], "v")
    assert {r.k: int(r.median * 2) for r in q.collect()} == {"0": 999_999, "1": 999_998, "2": 1_000_000}
    final = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 2 and "BroadcastHashJoin" in final
    # the join with the brackets comes before any shuffle of the rows
    assert final.rindex("BroadcastHashJoin") > final.rindex("Exchange hashpartitioning")
    brackets = fact.groupBy("k").agg(*M.median_bracket("v")).collect()
    assert all(r._median_ends[1] - r._median_ends[0] < 10_000 for r in brackets)


def test_promote_moves_no_rows(spark, scratch):
    from farelake.plans import pipeline as P
    rows = B.with_row_hash(fixture_bronze(spark, SF_SMALL)).limit(50)
    B.to_staging(rows).write.parquet(scratch + "/s")
    text = P.promoted(spark.read.parquet(scratch + "/s"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_ids_move_no_rows(spark, scratch):
    """The offsets, one row a split, are broadcast; before, every row was shuffled to meet them."""
    from farelake.operators.ids import assign_ids, with_positions
    with_positions(spark.range(0, 1000, 1, 4).withColumnRenamed("id", "n")).write.parquet(scratch + "/r")
    q = assign_ids(spark.read.parquet(scratch + "/r"))
    text = q._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r.id for r in q.collect()) == list(range(1, 1001))


def test_shared_layers_are_derived_once(spark):
    """What is returned reads working tables; before, each part derived silver from the lines again."""
    for name in ("tax_percentage", "kpi_avg_fare", "kpi_median_fare", "kpi_booking_count", "market_share",
                 "dq_unique", "incremental_pruned"):
        text = plan(Q.QUERIES[name](spark, SF_SMALL))
        assert "l_orderkey" not in text, name
    for name in ("dq_not_null", "dq_accepted_values", "run_report", "report_layer_counts"):
        # bronze itself, and nothing else
        text = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert text.count("lineitem.parquet") == 1, name


def test_codes_are_spelled_once_a_nation(spark):
    """The nation's rows carry their codes into the joins; before, every line spelled both."""
    text = fixture_bronze(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    spelled = [line for line in text.splitlines() if "lpad(" in line]
    assert len(spelled) == 2 and all("n_nationkey" in line and "l_orderkey" not in line for line in spelled)
