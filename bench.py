"""Benchmark: the pipeline's models on the booking fixture at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each step reads the previous layer's Parquet table and writes its own, as a
scheduled run does; row-level checks (hashing, incremental anti join) write
to Spark's no-op sink so only their computation is timed. Before timing, the
same steps run once, untimed, on a 2,000-row slice (JVM warm-up), so the
first timed step does not carry class loading and JIT compilation.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from farelake import schema as S  # noqa: E402
from farelake.operators import bronze as B  # noqa: E402
from farelake.operators import changes, dims, kpi, quality, report, silver  # noqa: E402
from farelake.operators.fact import fact_bookings  # noqa: E402
from farelake.plans import pipeline as P  # noqa: E402
from farelake.session import local_session  # noqa: E402
from farelake.sources.fixture import booking_fixture, fixture_bronze  # noqa: E402
from farelake.sources.lake import Lake  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="farelake-bench")
    scratch = tempfile.mkdtemp(prefix="farelake-bench-")
    lake = Lake(spark, f"{scratch}/lake")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    def ok(result):
        if not result.ok:
            raise RuntimeError(f"load failed: {result.error}")

    # Source file for the ingest path (not timed): the fixture as a headered CSV.
    csv = f"{scratch}/bookings_csv"
    (booking_fixture(spark, sf_dir).orderBy("id")
     .select(*[F.col(e).alias(s) for s, e in S.RENAME.items()])
     .write.option("header", True).csv(csv))

    # Warm-up (untimed): the pipeline on a small slice in its own lake.
    small = f"{scratch}/warmup_csv"
    (booking_fixture(spark, sf_dir).orderBy("id").limit(2000)
     .select(*[F.col(e).alias(s) for s, e in S.RENAME.items()])
     .write.option("header", True).csv(small))
    warm = Lake(spark, f"{scratch}/warmup_lake")
    P.ingest(spark, small, warm, S.FULL)
    P.promote(spark, warm, S.FULL)
    P.build_silver(warm)
    P.build_gold(warm)
    P.ingest(spark, small, warm, S.INCREMENTAL)

    timed("csv_ingest", lambda: ok(P.ingest(spark, csv, lake, S.FULL, with_profile=False)))
    # an ingest's profile, timed on its own
    staged = lake.read(P.STAGING).select(*[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS])
    timed("profile", lambda: P.write_profile(lake, staged))
    timed("promote", lambda: ok(P.promote(spark, lake, S.FULL)))
    # The silver/gold benchmark runs on the fixture's own bronze (fixture ids).
    timed("bronze_build", lambda: lake.write(B.with_row_hash(fixture_bronze(spark, sf_dir)), "bronze"))
    bronze = lake.read("bronze")
    timed("stg_bookings", lambda: lake.write(silver.stg_bookings(bronze), "stg"))
    timed("validation_failures", lambda: lake.write(silver.validation_failures(bronze), "failures"))
    stg = lake.read("stg")

    def build_dims():
        lake.write(dims.dim_airline(stg), "dim_airline")
        lake.write(dims.dim_route(stg), "dim_route")
        lake.write(dims.dim_date(stg), "dim_date")
    timed("dims", build_dims)
    airline, route = lake.read("dim_airline"), lake.read("dim_route")
    timed("fact_bookings", lambda: lake.write(fact_bookings(stg, route), "fact"))
    fact = lake.read("fact")
    timed("kpi_avg_fare", lambda: lake.write(kpi.kpi_avg_fare(fact, airline), "kpi_avg"))
    timed("kpi_booking_count", lambda: lake.write(kpi.kpi_booking_count(fact, airline), "kpi_bc"))
    timed("kpi_popular_routes", lambda: lake.write(kpi.kpi_popular_routes(fact, route), "kpi_routes"))
    timed("kpi_seasonal", lambda: lake.write(kpi.kpi_seasonal(fact), "kpi_seasonal"))

    unhashed = bronze.drop("row_hash")
    timed("row_hash", lambda: B.with_row_hash(unhashed).select("id", "row_hash")
          .write.format("noop").mode("overwrite").save())
    target = bronze.where(F.col("id") % 3 != 0)
    timed("incremental_new_rows", lambda: changes.new_rows(bronze, target)
          .write.format("noop").mode("overwrite").save())

    def data_tests_and_report():
        for name, tbl in (("stg_flight_bookings", "stg"), ("stg_validation_failures", "failures"),
                          ("kpi_avg_fare_by_airline", "kpi_avg"),
                          ("kpi_booking_count_by_airline", "kpi_bc"),
                          ("kpi_most_popular_routes", "kpi_routes"),
                          ("kpi_seasonal_fare_variation", "kpi_seasonal")):
            tables[name] = lake.read(tbl)
        quality.run_checks(tables, quality.ALL_CHECKS).collect()
        report.layer_counts(bronze, stg, airline, route, lake.read("dim_date")).collect()
        report.top_airlines(tables["kpi_booking_count_by_airline"]).collect()
        report.top_routes(tables["kpi_most_popular_routes"]).collect()
        report.seasonal(tables["kpi_seasonal_fare_variation"]).collect()
    tables = {}
    timed("data_tests_report", data_tests_and_report)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
