"""End to end: CSV -> staging -> bronze -> silver -> gold -> report."""

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.plans import pipeline as P
from farelake.plans import queries as Q
from farelake.sources.fixture import booking_fixture
from farelake.sources.lake import Lake
from tests.conftest import SF_SMALL

KPIS = {"kpi_avg_fare": "kpi_avg_fare_by_airline",
        "kpi_booking_count": "kpi_booking_count_by_airline",
        "kpi_popular_routes": "kpi_most_popular_routes",
        "kpi_seasonal": "kpi_seasonal_fare_variation"}


def test_pipeline_matches_direct_queries(spark, scratch):
    # One CSV file in fixture-id order, so scan-order ids keep the fixture's order.
    (booking_fixture(spark, SF_SMALL).orderBy("id")
     .select(*[F.col(e).alias(s) for s, e in S.RENAME.items()])
     .coalesce(1).write.option("header", True).csv(scratch + "/csv"))
    rep = P.run_pipeline(spark, scratch + "/csv", scratch + "/lake")
    lake = Lake(spark, scratch + "/lake")

    staging = lake.read(P.STAGING)
    r = staging.agg(F.min("id"), F.max("id"), F.count_distinct("id"), F.count("*")).first()
    assert tuple(r) == (1, 6469, 6469, 6469)

    for name, table in KPIS.items():
        direct = Q.QUERIES[name](spark, SF_SMALL)
        written = lake.read(table).select(*direct.columns)
        assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, written.collect())), name

    layers = rep.layers.first()
    assert (layers.bronze_records, layers.silver_records, layers.unique_airlines) == (6469, 4984, 25)
    assert rep.top_airlines.count() == 3 and rep.top_routes.count() == 3
    assert {r.season_type for r in rep.seasonal.collect()} == {S.PEAK, S.NON_PEAK}
    one = rep.frame().collect()
    assert {r.section for r in one} == {"layers", "top_airlines", "top_routes", "seasonal"}
    assert {r.metric: r.value for r in one if r.section == "layers"}["bronze_records"] == 6469
    assert all(r.failures == 0 for r in P.data_tests(lake).collect())

    # A second incremental run over the same file changes nothing.
    assert P.ingest(spark, scratch + "/csv", lake, S.INCREMENTAL).rows_loaded == 0
    assert P.promote(spark, lake, S.INCREMENTAL).rows_loaded == 0
    assert lake.read(P.BRONZE).count() == 6469
