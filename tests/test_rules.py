"""Literal edge cases of the silver and gold rules (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import cleaning as C
from farelake.functions.keys import row_hash, surrogate_key
from farelake.operators import dims, kpi, silver
from farelake.operators.fact import fact_bookings
from tests.helpers import booking, bronze_df, by_id


def test_total_repair(spark):
    rows = [booking(i, base_fare_bdt=100, tax_surcharge_bdt=10, total_fare_bdt=t,
                    departure_datetime=f"2024-01-0{i} 06:00:00")
            for i, t in enumerate([0, 90, 110, 120], start=1)]
    stg = by_id(silver.stg_bookings(bronze_df(spark, rows)))
    assert [float(stg[i].total_fare_bdt) for i in (1, 2, 3, 4)] == [110, 110, 110, 120]


def test_class_and_season_standardise(spark):
    df = spark.createDataFrame(
        [(" FIRST CLASS ", "Winter Holidays"), ("economy", "Eid ul-Adha"), ("Premium", "HAJJ"),
         (None, "regular"), ("business", "Monsoon"), ("Economy", None)], "c string, s string")
    out = df.select(C.standard_class("c").alias("c"), C.standard_season("s").alias("s")).collect()
    assert [r.c for r in out] == ["First", "Economy", "Premium", "Economy", "Business", "Economy"]
    assert [r.s for r in out] == ["Winter", "Eid", "Hajj", "Regular", "Monsoon", "Regular"]


def test_lead_buckets(spark):
    days = [0, 7, 8, 14, 15, 30, 31, 60, 61]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r[0] for r in df.select(C.lead_category("d")).collect()]
    assert got == ["Last Minute", "Last Minute", "Short Notice", "Short Notice", "Standard",
                   "Standard", "Advance", "Advance", "Early Bird"]


def test_duration_bounds_and_null_days(spark):
    durs = [-0.1, 0.0, 48.0, 48.1, None]
    rows = [booking(i, duration_hours=d, departure_datetime=f"2024-02-0{i} 06:00:00",
                    days_before_departure=None) for i, d in enumerate(durs, start=1)]
    bronze = bronze_df(spark, rows)
    stg = by_id(silver.stg_bookings(bronze))
    assert sorted(stg) == [2, 3, 5]
    assert stg[5].duration_hours == 0.0 and stg[5].days_before_departure == 0
    fact = by_id(fact_bookings(silver.stg_bookings(bronze)), "booking_id")
    assert fact[5].booking_lead_category == "Last Minute"
    reasons = {r.bronze_id: r.failure_reason for r in silver.validation_failures(bronze).collect()}
    assert reasons == {1: "negative_duration", 4: "excessive_duration"}


def test_dedupe_before_filter(spark):
    rows = [booking(1, duration_hours=60.0), booking(2, duration_hours=5.0)]
    bronze = bronze_df(spark, rows)
    assert silver.stg_bookings(bronze).count() == 0
    kept = silver.stg_bookings(bronze, S.Rules(validate_first=True)).collect()
    assert [r.bronze_id for r in kept] == [2]


def test_failure_reason_first_match_and_null_numerics(spark):
    rows = [booking(1, airline=None, source_code=None), booking(2, base_fare_bdt=None,
            total_fare_bdt=None), booking(3, base_fare_bdt=-5, duration_hours=-1.0),
            booking(4, base_fare_bdt=0, tax_surcharge_bdt=0, total_fare_bdt=0)]
    got = {r.bronze_id: r.failure_reason for r in silver.validation_failures(bronze_df(spark, rows)).collect()}
    assert got == {1: "missing_airline", 3: "negative_duration", 4: "invalid_total_fare"}


def test_tax_percentage_zero_base(spark):
    rows = [booking(1, base_fare_bdt=0, tax_surcharge_bdt=5, total_fare_bdt=5),
            booking(2, base_fare_bdt=200, tax_surcharge_bdt=25, total_fare_bdt=225,
                    departure_datetime="2024-03-01 06:00:00")]
    fact = by_id(fact_bookings(silver.stg_bookings(bronze_df(spark, rows))), "booking_id")
    assert float(fact[1].tax_percentage) == 0.0 and float(fact[2].tax_percentage) == 12.5


def test_date_attributes(spark):
    rows = [booking(1, departure_datetime="2024-01-06 06:30:00"),
            booking(2, departure_datetime="2024-01-07 06:30:00")]
    d = {r.full_date: r for r in dims.dim_date(silver.stg_bookings(bronze_df(spark, rows))).collect()}
    sat, sun = d[dt.date(2024, 1, 6)], d[dt.date(2024, 1, 7)]
    assert (sat.day_of_week, sun.day_of_week) == (6, 0)
    assert sat.is_weekend and sun.is_weekend
    assert (sat.date_key, sun.date_key) == (20240106, 20240107)
    assert (sat.day_name, sat.month_name, sat.weather_season, sat.quarter) == \
        ("Saturday", "January", "Winter", 1)


def test_empty_departure_gives_null_date_key(spark):
    rows = [booking(1, departure_datetime=""), booking(2, departure_datetime=None,
            base_fare_bdt=50, total_fare_bdt=60), booking(3, departure_datetime="not a date",
            base_fare_bdt=70, total_fare_bdt=80)]
    stg = silver.stg_bookings(bronze_df(spark, rows))
    assert dims.dim_date(stg).count() == 0
    assert [r.date_key for r in fact_bookings(stg).collect()] == [None, None, None]


def test_single_row_airline_stddev_null_and_rank_ties(spark):
    rows = [booking(1, airline="Solo"),
            booking(2, airline="Pair", departure_datetime="2024-01-08 06:00:00"),
            booking(3, airline="Pair", departure_datetime="2024-01-09 06:00:00"),
            booking(4, airline="Twin", departure_datetime="2024-01-08 06:00:00"),
            booking(5, airline="Twin", departure_datetime="2024-01-09 06:00:00")]
    stg = silver.stg_bookings(bronze_df(spark, rows))
    out = {r.airline: r for r in kpi.kpi_avg_fare(fact_bookings(stg), dims.dim_airline(stg)).collect()}
    assert out["Solo"].fare_std_dev is None
    assert out["Pair"].popularity_rank == out["Twin"].popularity_rank == 1
    assert out["Solo"].popularity_rank == 3
    assert out["Pair"].market_share_pct == 40.0 and out["Solo"].market_share_pct == 20.0


def test_route_fanout_and_strict(spark):
    rows = [booking(1, source_name="Dhaka"),
            booking(2, source_name="Dhaka Intl", departure_datetime="2024-01-08 06:00:00")]
    stg = silver.stg_bookings(bronze_df(spark, rows))
    route = dims.dim_route(stg)
    assert fact_bookings(stg, route).count() == 4
    from farelake.operators import quality
    assert quality.unique(route, "dim_route", "route_key").first().failures == 1
    with pytest.raises(ValueError):
        fact_bookings(stg, route, S.Rules(strict_routes=True))


def test_season_without_non_peak_rows(spark):
    rows = [booking(1, seasonality="Eid"), booking(2, seasonality="Winter",
            departure_datetime="2024-01-08 06:00:00")]
    fact = fact_bookings(silver.stg_bookings(bronze_df(spark, rows)))
    out = kpi.kpi_seasonal(fact).collect()
    assert {r.season_type for r in out} == {"Peak"}
    assert all(r.fare_diff_from_non_peak is None and r.peak_vs_non_peak_pct_diff is None for r in out)


def test_whitespace_insensitive_hash(spark):
    a = bronze_df(spark, [booking(1, airline="\tA ", stopovers="Direct\n")])
    b = bronze_df(spark, [booking(2, airline="A", stopovers="Direct")])
    ha, hb = (d.select(row_hash(d)).first()[0] for d in (a, b))
    assert ha == hb and len(ha) == 32


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("A", None)], "a string, b string")
    got = df.select(surrogate_key("a", "b")).first()[0]
    import hashlib
    assert got == hashlib.md5(f"A-{S.KEY_NULL}".encode()).hexdigest()


def test_approx_median_option(spark):
    rows = [booking(i, airline="Solo", total_fare_bdt=100 + i, base_fare_bdt=90,
                    departure_datetime=f"2024-01-{i:02d} 06:00:00") for i in range(1, 12)]
    stg = silver.stg_bookings(bronze_df(spark, rows))
    fact, airline = fact_bookings(stg), dims.dim_airline(stg)
    exact = kpi.median_fare(fact, airline).first().median_fare_bdt
    approx = kpi.median_fare(fact, airline, S.Rules(approx_median=True)).first().median_fare_bdt
    assert exact == 106.0 and abs(approx - exact) <= 1.0


def test_min_fare_drives_silver_and_audit(spark):
    rules = S.Rules(min_fare=50)
    rows = [booking(1, base_fare_bdt=40, total_fare_bdt=50),
            booking(2, base_fare_bdt=60, total_fare_bdt=70, departure_datetime="2024-01-08 06:00:00")]
    bronze = bronze_df(spark, rows)
    assert [r.bronze_id for r in silver.stg_bookings(bronze, rules).collect()] == [2]
    failed = {r.bronze_id: r.failure_reason for r in silver.validation_failures(bronze, rules).collect()}
    assert failed == {1: "negative_base_fare"}
