"""Silver layer: cleaned, deduplicated bookings (M1) and the rejection audit (M2)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import cleaning as C

STG_COLUMNS = (
    "bronze_id", "airline", "source_code", "source_name", "destination_code",
    "destination_name", "departure_datetime", "arrival_datetime", "duration_hours",
    "stopovers", "aircraft_type", "booking_class", "booking_source", "base_fare_bdt",
    "tax_surcharge_bdt", "total_fare_bdt", "seasonality", "days_before_departure",
)


def cleaned(bronze: DataFrame) -> DataFrame:
    """Mandatory-field filter (E1) and trimming / defaults / standardisation."""
    keep = ["ingested_at"] if "ingested_at" in bronze.columns else []
    d = S.TEXT_DEFAULTS
    return bronze.where(
        F.col("airline").isNotNull() & F.col("source_code").isNotNull()
        & F.col("destination_code").isNotNull()
    ).select(
        F.col("id").alias("bronze_id"),
        C.trim_or("airline", d["airline"]).alias("airline"),
        C.trim_or("source_code", d["source_code"]).alias("source_code"),
        C.trim_or("source_name", d["source_name"]).alias("source_name"),
        C.trim_or("destination_code", d["destination_code"]).alias("destination_code"),
        C.trim_or("destination_name", d["destination_name"]).alias("destination_name"),
        F.trim("departure_datetime").alias("departure_datetime"),
        F.trim("arrival_datetime").alias("arrival_datetime"),
        C.or_zero("duration_hours").alias("duration_hours"),
        C.trim_or("stopovers", d["stopovers"]).alias("stopovers"),
        C.trim_or("aircraft_type", d["aircraft_type"]).alias("aircraft_type"),
        C.standard_class("booking_class").alias("booking_class"),
        C.trim_or("booking_source", d["booking_source"]).alias("booking_source"),
        C.or_zero("base_fare_bdt").alias("base_fare_bdt"),
        C.or_zero("tax_surcharge_bdt").alias("tax_surcharge_bdt"),
        C.or_zero("total_fare_bdt").alias("total_fare_bdt"),
        C.standard_season("seasonality").alias("seasonality"),
        C.or_zero("days_before_departure").alias("days_before_departure"),
        *keep,
    )


def fare_validated(clean: DataFrame) -> DataFrame:
    """Add ``validated_total_fare_bdt``."""
    return clean.withColumn("validated_total_fare_bdt", C.repaired_total(
        "total_fare_bdt", "base_fare_bdt", "tax_surcharge_bdt"))


def money_lit(x) -> F.Column:
    """A threshold as an exact decimal literal, so comparisons stay decimal."""
    return F.lit(Decimal(str(x))).cast(S.MONEY)


def _valid(rules: S.Rules) -> F.Column:
    dur = F.col("duration_hours")
    return ((dur >= 0) & (dur <= F.lit(float(rules.max_duration)))
            & (F.col("base_fare_bdt") >= money_lit(rules.min_fare))
            & (F.col("validated_total_fare_bdt") > 0))


def ranked(df: DataFrame) -> DataFrame:
    """``rn`` = position by ``bronze_id`` inside each dedupe group."""
    w = Window.partitionBy(*S.DEDUPE_KEYS).orderBy("bronze_id")
    return df.withColumn("rn", F.row_number().over(w))


def stg_bookings(bronze: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Cleaned, repaired, deduplicated, valid bookings (M1).

    The first copy (lowest ``bronze_id``) of each dedupe group is ranked
    before the validity filter, so an invalid first copy removes its group
    (source-system order; ``rules.validate_first`` flips it). ``rn = 1`` plans
    as a WindowGroupLimit that also runs before the shuffle, so a dedupe
    key holding many copies ships one row per map partition.
    """
    df = fare_validated(cleaned(bronze))
    if rules.validate_first:
        df = ranked(df.where(_valid(rules))).where(F.col("rn") == 1)
    else:
        df = ranked(df).where((F.col("rn") == 1) & _valid(rules))
    keep = ["ingested_at"] if "ingested_at" in df.columns else []
    return df.select(*[F.col("validated_total_fare_bdt").alias(c) if c == "total_fare_bdt"
                       else F.col(c) for c in STG_COLUMNS], *keep)


FAILURE_COLUMNS = ("bronze_id", "airline", "source_code", "destination_code",
                   "departure_datetime", "duration_hours", "base_fare_bdt",
                   "tax_surcharge_bdt", "total_fare_bdt", "failure_reason")


def validation_failures(bronze: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Rows of bronze that fail a rule, with the first failing rule."""
    return bronze.where(C.any_failure(rules)).select(
        F.col("id").alias("bronze_id"), "airline", "source_code", "destination_code",
        "departure_datetime", "duration_hours", "base_fare_bdt", "tax_surcharge_bdt",
        "total_fare_bdt", C.failure_reason(rules).alias("failure_reason"))


def unlogged_drops(bronze: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Bronze rows that are neither in silver nor in the audit table (Q4).

    Membership in the audit table is a predicate on the row itself, so only
    silver needs a join.
    """
    stg = stg_bookings(bronze, rules).select(F.col("bronze_id").alias("id"))
    return bronze.where(~F.coalesce(C.any_failure(rules), F.lit(False))).join(stg, "id", "left_anti")
