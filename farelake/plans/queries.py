"""Named queries over a scale-factor directory, one per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and builds its result lazily from the
driver tables through the booking fixture, so its work grows with the
tables. Timestamps (D15) are left out so results are deterministic; money
leaves as ``double``, counts as ``bigint`` and ranks as ``int``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import cleaning as C
from farelake.functions.dates import departure_month
from farelake.functions.keys import surrogate_key
from farelake.operators import bronze as B
from farelake.operators import changes, dims, kpi, profile, quality, report, silver, sketches, validate
from farelake.operators.fact import FACT_COLUMNS, fact_bookings
from farelake.operators.ids import assign_ids, with_positions
from farelake.plans import runs
from farelake.plans.pipeline import distinct_metrics
from farelake.sources.fixture import fixture_bronze
from farelake.sources.tables import table
from farelake.sources.working import working

#: Silver columns behind a fact column of another name, and behind the dimensions.
FACT_INPUTS = {"airline_key": ("airline",), "route_key": ("source_code", "destination_code"),
               "date_key": ("departure_datetime",), "booking_id": ("bronze_id",),
               "tax_percentage": ("tax_surcharge_bdt", "base_fare_bdt"),
               "booking_lead_category": ("days_before_departure",)}
DIMENSION_INPUTS = ("airline", "source_code", "source_name", "destination_code", "destination_name")
#: Fact columns that each KPI reads.
FARE_FACT = ("airline_key", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt", "duration_hours", "tax_percentage")
COUNT_FACT = ("airline_key", "booking_class", "booking_source", "booking_lead_category", "seasonality", "total_fare_bdt")
ROUTE_FACT = ("route_key", "total_fare_bdt", "duration_hours", "stopovers", "booking_class", "days_before_departure")
SEASON_FACT = ("seasonality", "total_fare_bdt", "base_fare_bdt", "tax_surcharge_bdt", "days_before_departure")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _money_out(df: DataFrame) -> DataFrame:
    """Decimal columns leave as double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


class Layers:
    """Lazily built layers of one run over ``sf_dir``.

    What several plans read is a working table, derived once: ``stg``, of the
    columns that the query reads, and the route dimension. ``fact`` and ``stg``
    name the columns that are read of either.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, rules: S.Rules = S.Rules(),
                 fanout: bool = False, fact: tuple[str, ...] = FACT_COLUMNS,
                 stg: tuple[str, ...] = ()):
        self.rules, self.fact_columns = rules, fact
        self.stg_columns = [c for c in silver.STG_COLUMNS
                            if c in {*stg, *DIMENSION_INPUTS, *(i for f in fact for i in FACT_INPUTS.get(f, (f,)))}]
        self.bronze = fixture_bronze(spark, sf_dir, fanout)

    @cached_property
    def stg(self) -> DataFrame:
        return working(silver.stg_bookings(self.bronze, self.rules).select(*self.stg_columns), "silver")

    @cached_property
    def dim_airline(self) -> DataFrame:
        return dims.dim_airline(self.stg)

    @cached_property
    def dim_route(self) -> DataFrame:
        return working(dims.dim_route(self.stg), "routes")

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.stg)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_bookings(self.stg, self.dim_route, self.rules, self.fact_columns)


# ------------------------------------------------------------------ bronze/silver
@query
def raw_bookings(spark, sf):
    """Bronze input: the fixture typed as bronze (A1 shape, D14)."""
    return _money_out(fixture_bronze(spark, sf))


@query
def stg_bookings(spark, sf):
    """Silver bookings (M1: E1, D4-D9, I1, E2)."""
    return _money_out(silver.stg_bookings(fixture_bronze(spark, sf)))


@query
def stg_bookings_validate_first(spark, sf):
    """Silver bookings with validity applied before dedupe (Q3 option)."""
    return _money_out(silver.stg_bookings(fixture_bronze(spark, sf), S.Rules(validate_first=True)))


@query
def validation_failures(spark, sf):
    """Rejection audit with the first failing rule (M2: E3, D13)."""
    return _money_out(silver.validation_failures(fixture_bronze(spark, sf)))


@query
def failure_counts(spark, sf):
    """Rejections per reason (G1 over M2)."""
    return (silver.validation_failures(fixture_bronze(spark, sf))
            .groupBy("failure_reason").agg(F.count(F.lit(1)).alias("failures")))


@query
def unlogged_drops(spark, sf):
    """Bronze rows neither in silver nor in the audit (Q4)."""
    return silver.unlogged_drops(fixture_bronze(spark, sf)).select("id")


@query
def class_standardise(spark, sf):
    """Raw booking class -> standard label, with counts."""
    return (fixture_bronze(spark, sf)
            .groupBy(F.col("booking_class").alias("raw_class"),
                     C.standard_class("booking_class").alias("booking_class"))
            .agg(F.count(F.lit(1)).alias("bookings")))


@query
def season_standardise(spark, sf):
    """Raw seasonality -> standard label, with counts."""
    return (fixture_bronze(spark, sf)
            .groupBy(F.col("seasonality").alias("raw_seasonality"),
                     C.standard_season("seasonality").alias("seasonality"))
            .agg(F.count(F.lit(1)).alias("bookings")))


@query
def fare_repair(spark, sf):
    """Total-fare repair per row."""
    df = silver.fare_validated(silver.cleaned(fixture_bronze(spark, sf)))
    return _money_out(df.select("bronze_id", "base_fare_bdt", "tax_surcharge_bdt",
                                "total_fare_bdt", "validated_total_fare_bdt"))


@query
def dedupe_first(spark, sf):
    """First copy of each dedupe group (I1, before E2)."""
    df = silver.ranked(silver.fare_validated(silver.cleaned(fixture_bronze(spark, sf))))
    return _money_out(df.where(F.col("rn") == 1).select("bronze_id", *S.DEDUPE_KEYS))


# ------------------------------------------------------------------ dimensions/fact
@query
def dim_airline(spark, sf):
    """Airline dimension (M3: G12, L18)."""
    return dims.dim_airline(silver.stg_bookings(fixture_bronze(spark, sf)))


@query
def dim_route(spark, sf):
    """Route dimension (M4: G12, L5, L18)."""
    return dims.dim_route(silver.stg_bookings(fixture_bronze(spark, sf)))


@query
def dim_date(spark, sf):
    """Date dimension (M5: L6-L13)."""
    return dims.dim_date(silver.stg_bookings(fixture_bronze(spark, sf)))


@query
def surrogate_keys(spark, sf):
    """NULL-safe surrogate keys over raw code pairs."""
    return (fixture_bronze(spark, sf).select("source_code", "destination_code").distinct()
            .select("source_code", "destination_code",
                    surrogate_key("source_code", "destination_code").alias("route_key")))


@query
def fact_bookings_q(spark, sf):
    """Booking fact (M6: F1-F3, D10, D11)."""
    return _money_out(Layers(spark, sf).fact)


@query
def tax_percentage(spark, sf):
    """Tax percentage per booking."""
    f = Layers(spark, sf, fact=("booking_id", "base_fare_bdt", "tax_surcharge_bdt", "tax_percentage")).fact
    return _money_out(f.select("booking_id", "base_fare_bdt", "tax_surcharge_bdt", "tax_percentage"))


@query
def lead_category(spark, sf):
    """Bookings per lead-time bucket."""
    return (Layers(spark, sf, fact=("booking_lead_category",)).fact.groupBy("booking_lead_category")
            .agg(F.count(F.lit(1)).alias("bookings")))


# ------------------------------------------------------------------ gold
@query
def kpi_avg_fare(spark, sf):
    """Average-fare KPI per airline (M7: G1, G3, G4, G6-G8, I2, I3)."""
    L = Layers(spark, sf, fact=FARE_FACT)
    return kpi.kpi_avg_fare(L.fact, L.dim_airline)


@query
def kpi_median_fare(spark, sf):
    """Exact median total fare per airline."""
    L = Layers(spark, sf, fact=("airline_key", "total_fare_bdt"))
    return kpi.median_fare(L.fact, L.dim_airline)


@query
def kpi_booking_count(spark, sf):
    """Booking-count KPI per airline (M8: G2, G5, I2, I3, L16)."""
    L = Layers(spark, sf, fact=COUNT_FACT)
    return kpi.kpi_booking_count(L.fact, L.dim_airline)


@query
def kpi_booking_count_legacy(spark, sf):
    """M8 counting the source system's original labels (Q1, Q2)."""
    rules = S.Rules(legacy_labels=True)
    L = Layers(spark, sf, rules, fact=COUNT_FACT)
    return kpi.kpi_booking_count(L.fact, L.dim_airline, rules)


@query
def kpi_popular_routes(spark, sf):
    """Top-50 routes KPI (M9: G11, J4, G8)."""
    L = Layers(spark, sf, fact=ROUTE_FACT)
    return kpi.kpi_popular_routes(L.fact, L.dim_route)


@query
def route_fanout(spark, sf):
    """Popular routes when some code pairs carry two source-name spellings (Q7)."""
    L = Layers(spark, sf, fanout=True, fact=ROUTE_FACT)
    return kpi.kpi_popular_routes(L.fact, L.dim_route)


@query
def kpi_seasonal(spark, sf):
    """Seasonal fare variation KPI (M10: D12, G9, G10, F6)."""
    return kpi.kpi_seasonal(Layers(spark, sf, fact=SEASON_FACT).fact)


@query
def season_pivot(spark, sf):
    """Peak vs non-peak comparison row."""
    return kpi.season_pivot(Layers(spark, sf, fact=SEASON_FACT).fact)


@query
def market_share(spark, sf):
    """Airline market share and booking rank."""
    L = Layers(spark, sf, fact=COUNT_FACT)
    return kpi.kpi_booking_count(L.fact, L.dim_airline).select(
        "airline", "total_bookings", "market_share_pct", "booking_rank")


@query
def revenue_rank(spark, sf):
    """Airline revenue and revenue rank."""
    L = Layers(spark, sf, fact=COUNT_FACT)
    return kpi.kpi_booking_count(L.fact, L.dim_airline).select(
        "airline", "total_revenue_bdt", "revenue_rank")


# ------------------------------------------------------------------ hashing / loads
def _hashed(spark, sf):
    return B.with_row_hash(fixture_bronze(spark, sf))


@query
def row_hash(spark, sf):
    """Content hash per row."""
    return _hashed(spark, sf).select("id", "row_hash")


@query
def duplicate_hash_metric(spark, sf):
    """Rows minus distinct hashes."""
    return B.duplicate_hash_metric(_hashed(spark, sf))


def _incremental(spark, sf):
    batch = working(_hashed(spark, sf), "batch")
    target = batch.where(F.col("id") % 3 != 0)
    return batch, target


@query
def incremental_new_rows(spark, sf):
    """Batch rows whose hash the target lacks."""
    batch, target = _incremental(spark, sf)
    return changes.new_rows(batch, target).select("id", "row_hash")


@query
def incremental_skipped(spark, sf):
    """Batch, new and skipped row counts."""
    batch, target = _incremental(spark, sf)
    return changes.change_summary(batch, target)


@query
def incremental_pruned(spark, sf):
    """New rows against a month-laid-out target with foreign rows, scanning the batch's months only.

    The target holds bookings that differ from the batch's, and lacks others.
    Both come from one written table.
    """
    month = departure_month("departure_datetime")
    batch = working(_hashed(spark, sf).withColumn(S.LAYOUT_COLUMN, month), "batch")
    other = batch.drop("row_hash", S.LAYOUT_COLUMN).where(F.col("id") % 3 != 0).withColumn(
        "seasonality", F.when(F.col("id") % 5 == 0, F.lit("Charter")).otherwise(F.col("seasonality")))
    target = B.with_row_hash(other).withColumn(S.LAYOUT_COLUMN, month)
    return changes.new_rows(batch, target, prune_by=S.LAYOUT_COLUMN).select("id", "row_hash")


@query
def row_ids(spark, sf):
    """Ids over the whole line table: dense, from 1, none twice."""
    lines = working(with_positions(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")), "row-ids")
    return assign_ids(lines).agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_distinct("id").alias("distinct_ids"))


@query
def type_check(spark, sf):
    """Values per numeric column that are text, and money that its type cannot hold."""
    text = B.to_staging(fixture_bronze(spark, sf).select("id", *[
        F.col(c).cast("string").alias(c) for c in S.ENGINE_COLUMNS]))

    def spoiled(c, every, value, always=False):
        hit = (F.col("id") % every == 0) & (F.lit(always) | F.col(f"`{c}`").isNotNull())
        return text.withColumn(c, F.when(hit, F.lit(value)).otherwise(F.col(f"`{c}`")))
    text = spoiled("Base Fare (BDT)", 17, "abc", always=True)
    text = spoiled("Duration (hrs)", 19, "long")
    text = spoiled("Total Fare (BDT)", 23, "1000000000000000")
    found = validate.value_problems(text.drop("id"))
    pairs = [(kind, c) for kind in ("text", "range") for c in S.NUMERIC_KINDS if f"{kind}: {c}" in found.columns]
    stack = ", ".join(f"'{c}', '{kind}', `{kind}: {c}`" for kind, c in pairs)
    return found.selectExpr(f"stack({len(pairs)}, {stack}) as (column_name, problem, rows)")


@query
def rename_bronze(spark, sf):
    """Staging -> bronze rename, drop and defaults."""
    staging = B.to_staging(_hashed(spark, sf))
    return _money_out(B.to_bronze(staging))


# ------------------------------------------------------------------ profiling
def _staging(spark, sf):
    return B.to_staging(fixture_bronze(spark, sf).drop("id"))


@query
def profile_shape(spark, sf):
    """Row and column count."""
    return profile.shape(_staging(spark, sf))


@query
def profile_nulls(spark, sf):
    """Nulls per column."""
    return profile.nulls(_staging(spark, sf))


@query
def profile_value_counts(spark, sf):
    """Value counts of Seasonality, Class, Stopovers."""
    return profile.value_counts(_staging(spark, sf))


@query
def profile_distincts(spark, sf):
    """Distinct airlines, sources, destinations, routes."""
    return profile.distincts(_staging(spark, sf))


@query
def profile_top_airlines(spark, sf):
    """Five most frequent airlines."""
    return profile.top_values(_staging(spark, sf))


@query
def profile_stats(spark, sf):
    """Min / max / mean of fares and duration."""
    return profile.stats(_staging(spark, sf))


@query
def profile_issues(spark, sf):
    """Data-quality issue counters."""
    return profile.issues(_staging(spark, sf))


@query
def profile_null_columns(spark, sf):
    """How many columns hold nulls."""
    return profile.null_columns(_staging(spark, sf))


@query
def profile_issue_list(spark, sf):
    """The data-quality issues that occur."""
    return profile.issue_list(_staging(spark, sf))


@query
def distinct_sketches(spark, sf):
    """Distinct counts of three loads from their merged sketches: the count, and whether the estimate is within its error."""
    rows = working(B.to_staging(_hashed(spark, sf).withColumn("_id", F.col("id"))), "batch")
    metrics = distinct_metrics()
    loads = working(reduce(DataFrame.unionByName, [sketches.sketch_row(rows.where(F.col("_id") % 3 == k), metrics) for k in range(3)]), "sketches")
    exact = rows.agg(*[F.count_distinct(c).alias(m) for m, c in metrics.items()])
    pairs = ", ".join(f"'{m}', `{m}`" for m in metrics)
    exact = exact.selectExpr(f"stack({len(metrics)}, {pairs}) as (metric, distinct_count)")
    return sketches.estimates(loads, metrics).join(exact, "metric").select(
        "metric", "distinct_count", (F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.col("error")).alias("within_error"))


# ------------------------------------------------------------------ data quality
def _checked(spark, sf, kind: str) -> DataFrame:
    """The checks of one kind on the models that have any, over one silver table with every column that they read."""
    L = Layers(spark, sf, fact=tuple({*FARE_FACT, *COUNT_FACT, *ROUTE_FACT, *SEASON_FACT}), stg=("bronze_id",))
    models = {
        "stg_flight_bookings": lambda: L.stg,
        "stg_validation_failures": lambda: silver.validation_failures(L.bronze),
        "kpi_avg_fare_by_airline": lambda: kpi.kpi_avg_fare(L.fact, L.dim_airline),
        "kpi_booking_count_by_airline": lambda: kpi.kpi_booking_count(L.fact, L.dim_airline),
        "kpi_most_popular_routes": lambda: kpi.kpi_popular_routes(L.fact, L.dim_route),
        "kpi_seasonal_fare_variation": lambda: kpi.kpi_seasonal(L.fact),
    }
    checks = [c for c in quality.ALL_CHECKS if c.check == kind]
    return quality.run_checks({m: models[m]() for m in {c.model for c in checks}}, checks)


@query
def dq_not_null(spark, sf):
    """not_null checks of the silver and gold models (H1)."""
    return _checked(spark, sf, "not_null")


@query
def dq_unique(spark, sf):
    """unique checks of the gold models (H2)."""
    return _checked(spark, sf, "unique")


@query
def dq_accepted_values(spark, sf):
    """accepted_values checks (H3)."""
    return _checked(spark, sf, "accepted_values")


# ------------------------------------------------------------------ report
@query
def report_layer_counts(spark, sf):
    """Layer counts and validation rate."""
    L = Layers(spark, sf, fact=(), stg=("departure_datetime",))
    return report.layer_counts(L.bronze, L.stg, L.dim_airline, L.dim_route, L.dim_date)


@query
def report_top_airlines(spark, sf):
    """Top-3 airlines by bookings."""
    L = Layers(spark, sf, fact=COUNT_FACT)
    return report.top_airlines(kpi.kpi_booking_count(L.fact, L.dim_airline))


@query
def report_top_routes(spark, sf):
    """Top-3 routes by bookings."""
    L = Layers(spark, sf, fact=ROUTE_FACT)
    return report.top_routes(kpi.kpi_popular_routes(L.fact, L.dim_route))


@query
def report_seasonal(spark, sf):
    """Bookings and mean fare per season type."""
    return report.seasonal(kpi.kpi_seasonal(Layers(spark, sf, fact=SEASON_FACT).fact))


@query
def run_report(spark, sf):
    """The whole run report as one frame."""
    L = Layers(spark, sf, fact=tuple({*COUNT_FACT, *ROUTE_FACT, *SEASON_FACT}), stg=("departure_datetime",))
    return report.as_one(
        report.layer_counts(L.bronze, L.stg, L.dim_airline, L.dim_route, L.dim_date),
        report.top_airlines(kpi.kpi_booking_count(L.fact, L.dim_airline)),
        report.top_routes(kpi.kpi_popular_routes(L.fact, L.dim_route)),
        report.seasonal(kpi.kpi_seasonal(L.fact)))


# Whole runs have their own module; the fact query is registered under its model name.
QUERIES |= runs.QUERIES
QUERIES["fact_bookings"] = QUERIES.pop("fact_bookings_q")
