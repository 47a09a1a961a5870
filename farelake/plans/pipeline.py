"""End-to-end pipeline: ingest, promote, silver, gold, report.

Every step reads the previous layer's table from the lake and writes its
own; each model is therefore computed once, and downstream models read it
back with exact file statistics (so Spark broadcasts a dimension only when
its files are small).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import bronze as B
from farelake.operators import dims, kpi, load as L, profile, quality, report, silver, sketches, validate
from farelake.operators.fact import fact_bookings
from farelake.functions import dates as D
from farelake.functions.keys import canonical_number
from farelake.operators.ids import POSITION, assign_ids, with_positions
from farelake.sources.csv import MALFORMED, SourceError, preflight, read_text_csv
from farelake.sources.lake import Lake
from farelake.sources.working import working, working_tables

log = logging.getLogger(__name__)

STAGING, BRONZE = "raw_flight_staging", "raw_flight_data"
SILVER = ("stg_flight_bookings", "stg_validation_failures", "dim_airline", "dim_route",
          "dim_date", "fct_flight_bookings")
GOLD = ("kpi_avg_fare_by_airline", "kpi_booking_count_by_airline", "kpi_most_popular_routes",
        "kpi_seasonal_fare_variation")


class PipelineError(Exception):
    pass


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# ------------------------------------------------------------------ R1 ingest
PROFILES = ("shape", "nulls", "null_columns", "value_counts", "distincts", "top_values", "stats",
            "issues", "issue_list")


def distinct_metrics() -> dict[str, Column]:
    """What each load keeps sketches of (C3, N4, N6); a route has both ends."""
    source, destination = F.col("Source"), F.col("Destination")
    return {"row_hash": F.col("row_hash"), "airline": F.col("Airline"), "source": source, "destination": destination,
            "route": F.concat(source, F.lit("\x1f"), destination)}


def write_profile(lake: Lake, df: DataFrame, prefix: str = "profile_", one_row: DataFrame | None = None) -> None:
    """Profile a source-shaped frame (N1-N7) into ``profile_*`` tables.

    The families that need one row of aggregates share one scan, or none where
    that row is given.
    """
    if one_row is None:
        one_row = working(profile.summary(df), "profile")

    def write(name: str) -> None:
        family = getattr(profile, name)
        frame = family(df, one_row) if name in profile.FROM_SUMMARY else family(df)
        lake.write(frame, f"{prefix}{name}", stamps=("profiled_at",))
    write(PROFILES[0])   # reads the commit log once
    with ThreadPoolExecutor(4) as pool:   # small independent jobs, run side by side
        list(pool.map(write, PROFILES[1:]))


def arriving(text: DataFrame, with_profile: bool = True) -> tuple[DataFrame, Observation]:
    """The batch's typed rows with hash, month and position, and what their one pass observes.

    It observes everything that validation and the load ask of all rows (the
    row count, text in numeric columns, malformed lines), and ``with_profile``
    the profile's nulls, ranges, means and issue counters.
    """
    found = Observation()
    positioned = with_positions(text.select(*[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS], MALFORMED))
    # each value is cast once, beside its text; numbers are spelled for the hash here, below what
    # observes, as Java leaves a generated method of over 8,000 bytes to its interpreter
    typed = {c: f"_typed_{i}" for i, c in enumerate(S.SOURCE_COLUMNS)}
    spelled = {c: f"_spelled_{c}" for c in S.NUMERIC_KINDS if c not in S.INT_SOURCE}
    both = positioned.withColumns({t: validate.typed_value(c) for c, t in typed.items()}
                                  | {s: canonical_number(F.col(f"`{c}`")) for c, s in spelled.items()})
    summary = profile.summary_aggregates(S.SOURCE_COLUMNS, lambda c: F.col(typed[c])) if with_profile else []
    observed = both.observe(found, *validate.problem_aggregates(positioned.columns), *summary)
    rows = observed.select(
        POSITION, content_hash(observed, typed, spelled).alias("row_hash"),
        D.departure_month(F.col("`Departure Date & Time`")).alias(S.LAYOUT_COLUMN), *[F.col(t).alias(c) for c, t in typed.items()])
    return rows, found


def arrived(text: DataFrame, with_profile: bool = True) -> tuple[DataFrame, dict]:
    """:func:`arriving` as a working table, and what its write observed."""
    rows, found = arriving(text, with_profile)
    return working(rows, "batch"), found.get


def content_hash(rows: DataFrame, typed: dict[str, str], spelled: dict[str, str]) -> Column:
    """The hash of a row's text; a day count of 5 and of 5.0 are the same, so these count by value."""
    names = [typed[c] if c in S.INT_SOURCE else spelled.get(c, c) for c in S.SOURCE_COLUMNS]
    return B.row_hash(rows, names, canonical=tuple(spelled.values()))


def ingest(spark: SparkSession, csv_path: str, lake: Lake, mode: str = S.FULL,
           with_profile: bool = True, multiline: bool = False, after_read: Callable[[], None] | None = None) -> L.LoadResult:
    """Validate the CSV, hash every row, load it into staging, log the outcome.

    The CSV is parsed in one pass (:func:`arrived`), which writes the typed and
    hashed rows with their scan positions to a working table and observes every
    aggregate that validation and the profile need. Ids, the other profile
    families and the load read that table, so they see the same rows however
    the source is split. It is deleted at the end. ``multiline`` reads quoted
    line breaks. ``after_read`` is called when a valid file has been read for
    the last time, before its rows are loaded.
    """
    with working_tables(spark):
        return _ingest(spark, csv_path, lake, mode, with_profile, multiline, after_read)


def _ingest(spark: SparkSession, csv_path: str, lake: Lake, mode: str, with_profile: bool, multiline: bool,
            after_read: Callable[[], None] | None) -> L.LoadResult:
    started = _now()
    name = csv_path.rstrip("/").rsplit("/", 1)[-1]
    mode = L.resolve_mode(mode)

    def log_row(status, expected, loaded, error):
        try:
            lake.append_row(L.INGESTION_LOG, dict(
                file_name=name, status=status, rows_expected=expected, rows_loaded=loaded,
                error_message=error, started_at=started, completed_at=_now()),
                L.INGESTION_LOG_SCHEMA)
        except Exception as e:  # the log never fails the load
            log.error("The ingestion log could not be written: %s", e)

    def failed(errors, expected=0):
        log_row("FAILURE", expected, 0, "; ".join(errors))
        return L.LoadResult(False, rows_expected=expected, error="; ".join(errors))

    try:
        preflight(spark, csv_path)
        source = read_text_csv(spark, csv_path, multiline)
        missing = validate.missing_columns(source)
        if missing:
            return failed([f"Missing columns: {missing}"])
        rows, found = arrived(source, with_profile)
        res = validate.check_frame(rows.drop("row_hash", S.LAYOUT_COLUMN), found=found)
    except SourceError as e:
        return failed([str(e)])
    except Exception as e:
        return failed([f"CSV parsing error: {e}"])
    if not res.ok:
        return failed(res.errors)
    try:
        if after_read is not None:
            after_read()
        if with_profile:
            write_profile(lake, rows.select(*[F.col(f"`{c}`") for c in S.SOURCE_COLUMNS]),
                          one_row=profile.observed_summary(spark, found))
            copies = B.duplicate_hash_metric(rows).first()["duplicate_rows"]
            if copies:
                log.warning("%s of %s rows repeat the content of another row; all are loaded", copies, res.rows)
        out = L.load(rows, lake, STAGING, mode, stamps=("ingested_at",),
                     partition_by=(S.LAYOUT_COLUMN,), batch_rows=res.rows, place=POSITION,
                     number=lambda df, start, all_rows: assign_ids(df, start, all_rows=all_rows))
        if with_profile:
            # a row of sketches for each load since the last full one: their union counts them all without another scan
            lake.write(sketches.sketch_row(rows, distinct_metrics()), sketches.TABLE, stamps=("sketched_at",),
                       mode="append" if mode == S.INCREMENTAL else "overwrite")
    except Exception as e:
        return failed([f"Unexpected error during load: {e}"], res.rows)
    log_row("SUCCESS", out.rows_expected, out.rows_loaded, None)
    return out


# ------------------------------------------------------------------ R2 promote
def promoted(staging: DataFrame, offset: int = 0) -> DataFrame:
    """Staging rows under engine names, their ids moved by ``offset``: a projection, no shuffle."""
    bronze = B.to_bronze(staging.withColumn("_sid", F.col("id")))
    return B.enforce_types(bronze.withColumn("id", F.col("_sid") + F.lit(offset)).drop("_sid"))


def promote(spark: SparkSession, lake: Lake, mode: str = S.FULL) -> L.LoadResult:
    """Staging -> bronze with engine names and fresh ids.

    Bronze ids keep staging order: a full load reuses the staging id, an
    incremental load offsets it by the bronze table's current maximum, so
    ids stay unique and increase with arrival without a sort. Staging is laid
    out by month already, so a load moves no row between tasks; ids that repeat,
    which no load gives, make an incremental one find its rows by key.
    """
    mode = L.resolve_mode(mode)
    src, dst = f"staging.{STAGING}", f"bronze.{BRONZE}"

    def log_row(status, n, error):
        try:
            lake.append_row(L.TRANSFER_LOG, dict(
                source_table=src, target_table=dst, status=status, rows_transferred=n,
                error_message=error, transferred_at=_now()), L.TRANSFER_LOG_SCHEMA)
        except Exception as e:
            log.error("The transfer log could not be written: %s", e)

    staging = lake.read(STAGING) if lake.exists(STAGING) else None
    rows = staging.count() if staging is not None else 0   # Parquet footers only
    if rows == 0:
        log_row("FAILURE", 0, "No data in source table")
        return L.LoadResult(False, error="No data in source table")
    offset = L.max_id(lake, BRONZE) if mode == S.INCREMENTAL else 0
    try:
        ids_differ = mode == S.INCREMENTAL and staging.agg(F.count_distinct("id")).first()[0] == rows
        out = L.load(promoted(staging, offset), lake, BRONZE, mode, stamps=("ingested_at",),
                     partition_by=(S.LAYOUT_COLUMN,), batch_rows=rows,
                     gather=False, place="id" if ids_differ else None)
    except Exception as e:
        log_row("FAILURE", 0, str(e))
        return L.LoadResult(False, error=str(e))
    log_row("SUCCESS", out.rows_loaded, None)
    return out


# ------------------------------------------------------------------ R3 models
def build_silver(lake: Lake, rules: S.Rules = S.Rules()) -> None:
    """stg (persisted once, read by four models), audit table, dimensions, fact."""
    bronze = lake.read(BRONZE)
    lake.write(silver.stg_bookings(bronze, rules), "stg_flight_bookings", stamps=("processed_at",))
    lake.write(silver.validation_failures(bronze, rules), "stg_validation_failures",
               stamps=("detected_at",))
    stg = lake.read("stg_flight_bookings").drop("processed_at")
    stamps = ("created_at", "updated_at")
    lake.write(dims.dim_airline(stg), "dim_airline", stamps=stamps)
    lake.write(dims.dim_route(stg), "dim_route", stamps=stamps)
    lake.write(dims.dim_date(stg), "dim_date", stamps=("created_at",))
    route = lake.read("dim_route").drop(*stamps)
    # laid out by month, so that a date range reads its own months only
    fact = fact_bookings(stg, route, rules).withColumn(S.LAYOUT_COLUMN, D.departure_month("departure_datetime"))
    lake.write(fact, "fct_flight_bookings", stamps=("processed_at", "created_at"),
               partition_by=(S.LAYOUT_COLUMN,))


def build_gold(lake: Lake, rules: S.Rules = S.Rules()) -> None:
    fact = lake.read("fct_flight_bookings")
    airline = lake.read("dim_airline").drop("created_at", "updated_at")
    route = lake.read("dim_route").drop("created_at", "updated_at")
    at = ("calculated_at",)
    lake.write(kpi.kpi_avg_fare(fact, airline, rules), "kpi_avg_fare_by_airline", stamps=at)
    lake.write(kpi.kpi_booking_count(fact, airline, rules), "kpi_booking_count_by_airline", stamps=at)
    lake.write(kpi.kpi_popular_routes(fact, route, rules), "kpi_most_popular_routes", stamps=at)
    lake.write(kpi.kpi_seasonal(fact, rules), "kpi_seasonal_fare_variation", stamps=at)


def data_tests(lake: Lake) -> DataFrame:
    """Run the declared data tests (H1-H3) on the written models."""
    names = {ck.model for ck in quality.ALL_CHECKS}
    return quality.run_checks({n: lake.read(n) for n in names}, quality.ALL_CHECKS)


# ------------------------------------------------------------------ R4 report
@dataclass
class Report:
    layers: DataFrame
    top_airlines: DataFrame
    top_routes: DataFrame
    seasonal: DataFrame

    def frame(self) -> DataFrame:
        """The whole report as (section, position, item, metric, value)."""
        return report.as_one(self.layers, self.top_airlines, self.top_routes, self.seasonal)


def run_report(lake: Lake) -> Report:
    return Report(
        report.layer_counts(lake.read(BRONZE), lake.read("stg_flight_bookings"),
                            lake.read("dim_airline"), lake.read("dim_route"), lake.read("dim_date")),
        report.top_airlines(lake.read("kpi_booking_count_by_airline")),
        report.top_routes(lake.read("kpi_most_popular_routes")),
        report.seasonal(lake.read("kpi_seasonal_fare_variation")),
    )


# ------------------------------------------------------------------ R5 whole run
def run_pipeline(spark: SparkSession, csv_path: str, lake_root: str, mode: str = S.FULL,
                 rules: S.Rules = S.Rules(), with_profile: bool = True, multiline: bool = False,
                 after_read: Callable[[], None] | None = None) -> Report:
    """The five steps in order; the first failure stops the run. ``after_read`` is :func:`ingest`'s."""
    lake = Lake(spark, lake_root)
    if not ingest(spark, csv_path, lake, mode, with_profile, multiline, after_read).ok:
        raise PipelineError("The CSV was not loaded; ingestion_log has the reason.")
    with working_tables(spark):
        if not promote(spark, lake, mode).ok:
            raise PipelineError("Staging was not promoted to bronze; transfer_log has the reason.")
        build_silver(lake, rules)
        build_gold(lake, rules)
    return run_report(lake)
