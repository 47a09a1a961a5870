"""Gold KPI tables.

Shape of every KPI: aggregate the fact by the dimension *key* first (a
two-phase hash aggregation: partial aggregates per map partition, then one
small shuffle), and only then join the aggregate - one row per airline or
route - to the dimension for its names. Spark does not push aggregation
below joins by itself, and joining first would shuffle or broadcast against
every booking row. The per-dimension result (one row per airline or route) is
a working table: its count and totals are known before ranks and shares are
planned (:mod:`farelake.operators.ranking`), and no plan computes it twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schema as S
from farelake.functions import cleaning as C
from farelake.functions import money as M
from farelake.operators.ranking import with_ranks
from farelake.sources.working import working

D2 = T.DecimalType(20, 2)


def _all() -> Window:
    """Window over the whole (aggregated) frame."""
    return Window.partitionBy()


def _sized(df: DataFrame, name: str) -> tuple[DataFrame, int, F.Column]:
    """The per-dimension frame as a working table, its rows and its total of bookings."""
    df = working(df, name)
    rows, total = df.agg(F.count(F.lit(1)), F.sum("total_bookings")).first()
    return df, rows, F.lit(total).cast("bigint")


def _first_label(rules: S.Rules) -> str:
    return S.LEGACY_FIRST_CLASS if rules.legacy_labels else "First"


def _peak_labels(rules: S.Rules) -> tuple:
    return S.LEGACY_PEAK_SEASONS if rules.legacy_labels else tuple(rules.peak_seasons)


def _class_counts(rules: S.Rules) -> list[F.Column]:
    cls = F.col("booking_class")
    return [F.count_if(cls == "Economy").alias("economy_bookings"),
            F.count_if(cls == "Business").alias("business_bookings"),
            F.count_if(cls == _first_label(rules)).alias("first_class_bookings")]


# --------------------------------------------------------------------------- M7
def kpi_avg_fare(fact: DataFrame, dim_airline: DataFrame,
                 rules: S.Rules = S.Rules()) -> DataFrame:
    """Average-fare statistics per airline (M7)."""
    total, dur = F.col("total_fare_bdt"), M.as_money("duration_hours")
    agg = fact.groupBy("airline_key").agg(
        F.count(F.lit(1)).alias("total_bookings"),
        M.avg_round("base_fare_bdt").alias("avg_base_fare_bdt"),
        M.avg_round("tax_surcharge_bdt").alias("avg_tax_surcharge_bdt"),
        M.avg_round("total_fare_bdt").alias("avg_total_fare_bdt"),
        M.round_money(F.min(total)).alias("min_fare_bdt"),
        M.round_money(F.max(total)).alias("max_fare_bdt"),
        M.round_double(F.stddev_samp(total.cast("double"))).alias("fare_std_dev"),
        M.avg_round("tax_percentage").alias("avg_tax_percentage"),
        M.avg_round(dur).alias("avg_duration_hours"),
        # avg(total) / avg(duration) == sum(total) / sum(duration) exactly.
        M.ratio_round(F.sum(M.as_money(total)), F.sum(dur)).alias("avg_fare_per_hour"),
        *([M.approx_median_of("total_fare_bdt").alias("_median")] if rules.approx_median else M.median_bracket("total_fare_bdt")),
    )
    m, rows, bookings = _sized(agg.join(dim_airline, "airline_key"), "kpi-fare")
    if not rules.approx_median:
        med = M.median_within(fact, m, ["airline_key"], "total_fare_bdt", "_median").withColumnRenamed("airline_key", "_of")
        m = m.join(med, F.col("airline_key").eqNullSafe(F.col("_of")), "left")
    m = with_ranks(m, rows, {"fare_rank_desc": "avg_total_fare_bdt", "popularity_rank": "total_bookings"})
    out = m.select(
        F.col("airline_name").alias("airline"),
        "total_bookings",
        M.dbl("avg_base_fare_bdt").alias("avg_base_fare_bdt"),
        M.dbl("avg_tax_surcharge_bdt").alias("avg_tax_surcharge_bdt"),
        M.dbl("avg_total_fare_bdt").alias("avg_total_fare_bdt"),
        M.dbl("min_fare_bdt").alias("min_fare_bdt"),
        M.dbl("max_fare_bdt").alias("max_fare_bdt"),
        M.dbl("fare_std_dev").alias("fare_std_dev"),
        M.dbl(F.round("_median", 2)).alias("median_fare_bdt"),
        M.dbl("avg_tax_percentage").alias("avg_tax_percentage"),
        M.dbl("avg_duration_hours").alias("avg_duration_hours"),
        M.dbl("avg_fare_per_hour").alias("avg_fare_per_hour"),
        M.dbl(M.pct("total_bookings", bookings, 2)).alias("market_share_pct"),
        "fare_rank_desc", "popularity_rank",
    )
    return out.orderBy(F.col("total_bookings").desc(), "airline")


def median_fare(fact: DataFrame, dim_airline: DataFrame,
                rules: S.Rules = S.Rules()) -> DataFrame:
    """Exact (or approximate) median total fare per airline."""
    fn = M.approx_median if rules.approx_median else M.exact_median
    return fn(fact, ["airline_key"], "total_fare_bdt", "_median").join(dim_airline, "airline_key").select(
        F.col("airline_name").alias("airline"),
        M.dbl(F.round("_median", 2)).alias("median_fare_bdt"))


# --------------------------------------------------------------------------- M8
def kpi_booking_count(fact: DataFrame, dim_airline: DataFrame,
                      rules: S.Rules = S.Rules()) -> DataFrame:
    """Booking counts per airline with class / source / lead / season breakdowns (M8)."""
    src, lead = F.col("booking_source"), F.col("booking_lead_category")
    agg = fact.groupBy("airline_key").agg(
        F.count(F.lit(1)).alias("total_bookings"),
        *_class_counts(rules),
        *[F.count_if(src == label).alias(name) for name, label in S.BOOKING_SOURCES],
        F.count_if(lead == S.LEAD_BUCKETS[0][1]).alias("last_minute_bookings"),
        F.count_if(lead == S.LEAD_LAST).alias("early_bird_bookings"),
        F.count_if(F.col("seasonality").isin(*_peak_labels(rules))).alias("peak_season_bookings"),
        M.sum_round("total_fare_bdt").alias("total_revenue_bdt"),
        M.avg_round("total_fare_bdt").alias("avg_fare_bdt"),
    )
    m, rows, bookings = _sized(agg.join(dim_airline, "airline_key"), "kpi-bookings")
    m = with_ranks(m, rows, {"booking_rank": "total_bookings", "revenue_rank": "total_revenue_bdt"})
    n = F.col("total_bookings")
    out = m.select(
        F.col("airline_name").alias("airline"),
        "total_bookings", "booking_rank",
        M.dbl(M.pct("total_bookings", bookings, 2)).alias("market_share_pct"),
        "economy_bookings", "business_bookings", "first_class_bookings",
        M.dbl(M.pct("economy_bookings", n, 1)).alias("economy_pct"),
        M.dbl(M.pct("business_bookings", n, 1)).alias("business_pct"),
        M.dbl(M.pct("first_class_bookings", n, 1)).alias("first_class_pct"),
        "online_bookings", "agency_bookings", "direct_bookings",
        "last_minute_bookings", "early_bird_bookings", "peak_season_bookings",
        M.dbl(M.pct("peak_season_bookings", n, 1)).alias("peak_season_pct"),
        M.dbl("total_revenue_bdt").alias("total_revenue_bdt"),
        M.dbl("avg_fare_bdt").alias("avg_fare_bdt"),
        "revenue_rank",
    )
    return out.orderBy(F.col("total_bookings").desc(), "airline")


# --------------------------------------------------------------------------- M9
ROUTE_COLUMNS = ("source_code", "source_name", "destination_code", "destination_name",
                 "route_code", "route_description")


def route_metrics(fact: DataFrame, dim_route: DataFrame,
                  rules: S.Rules = S.Rules()) -> DataFrame:
    """All routes with metrics, ranks and shares, before the top-k cut."""
    total, dur = F.col("total_fare_bdt"), M.as_money("duration_hours")
    stop = F.col("stopovers")
    agg = fact.groupBy("route_key").agg(
        F.count(F.lit(1)).alias("total_bookings"),
        M.avg_round("total_fare_bdt").alias("avg_fare_bdt"),
        M.round_money(F.min(total)).alias("min_fare_bdt"),
        M.round_money(F.max(total)).alias("max_fare_bdt"),
        M.round_double(F.stddev_samp(total.cast("double"))).alias("fare_std_dev"),
        M.avg_round(dur).alias("avg_duration_hours"),
        M.round_money(F.min(dur)).alias("min_duration_hours"),
        M.round_money(F.max(dur)).alias("max_duration_hours"),
        F.count_if(stop == S.DIRECT_STOPOVER).alias("direct_flights"),
        F.count_if(stop != S.DIRECT_STOPOVER).alias("connecting_flights"),
        *_class_counts(rules),
        M.sum_round("total_fare_bdt").alias("total_revenue_bdt"),
        M.avg_round("days_before_departure", 1).alias("avg_days_before_departure"),
    )
    m, rows, bookings = _sized(agg.join(dim_route, "route_key"), "kpi-routes")
    m = with_ranks(m, rows, {"route_rank": "total_bookings", "revenue_rank": "total_revenue_bdt"})
    return m.select(
        *ROUTE_COLUMNS,
        "total_bookings", "route_rank",
        M.dbl(M.pct("total_bookings", bookings, 2)).alias("market_share_pct"),
        M.dbl("avg_fare_bdt").alias("avg_fare_bdt"),
        M.dbl("min_fare_bdt").alias("min_fare_bdt"),
        M.dbl("max_fare_bdt").alias("max_fare_bdt"),
        M.dbl("fare_std_dev").alias("fare_std_dev"),
        M.dbl("avg_duration_hours").alias("avg_duration_hours"),
        M.dbl("min_duration_hours").alias("min_duration_hours"),
        M.dbl("max_duration_hours").alias("max_duration_hours"),
        "direct_flights", "connecting_flights",
        M.dbl(M.pct("direct_flights", F.col("total_bookings"), 1)).alias("direct_flight_pct"),
        "economy_bookings", "business_bookings", "first_class_bookings",
        M.dbl("total_revenue_bdt").alias("total_revenue_bdt"),
        "revenue_rank",
        M.dbl("avg_days_before_departure").alias("avg_days_before_departure"),
        # The source system divides the two *rounded* averages.
        M.dbl(M.ratio_round("avg_fare_bdt", "avg_duration_hours", 2, num_t=D2, den_t=D2))
         .alias("fare_per_hour"),
    )


def kpi_popular_routes(fact: DataFrame, dim_route: DataFrame,
                       rules: S.Rules = S.Rules(), top: int = 50) -> DataFrame:
    """Top routes by bookings (M9, J4). Ranks and shares cover all routes.

    The cut is a distributed top-k (TakeOrderedAndProject); ties at the cut
    are broken by route code and names so the result is deterministic (Q8).
    """
    order = [F.col("total_bookings").desc(), F.col("route_code").asc_nulls_last(),
             F.col("source_name").asc_nulls_last(), F.col("destination_name").asc_nulls_last()]
    return route_metrics(fact, dim_route, rules).orderBy(*order).limit(top)


# -------------------------------------------------------------------------- M10
def by_seasonality(fact: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    total = F.col("total_fare_bdt")
    return (fact.withColumn("season_type", C.season_type("seasonality", tuple(rules.peak_seasons)))
                .groupBy("seasonality", "season_type").agg(
                    F.count(F.lit(1)).alias("total_bookings"),
                    M.avg_round("total_fare_bdt").alias("avg_total_fare_bdt"),
                    M.avg_round("base_fare_bdt").alias("avg_base_fare_bdt"),
                    M.avg_round("tax_surcharge_bdt").alias("avg_tax_surcharge_bdt"),
                    M.round_money(F.min(total)).alias("min_fare_bdt"),
                    M.round_money(F.max(total)).alias("max_fare_bdt"),
                    M.avg_round("days_before_departure", 1).alias("avg_days_before_departure"),
                ))


def _type_avg(by_type: Window) -> F.Column:
    """Unweighted mean of the rounded season averages."""
    x = F.col("avg_total_fare_bdt").cast(M.SUM_T)
    return F.round(F.sum(x).over(by_type) / F.count(x).over(by_type).cast(M.COUNT_T), 2)


def season_pivot(fact: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Peak vs non-peak comparison as one row."""
    s = by_seasonality(fact, rules)
    t = s.groupBy("season_type").agg(
        F.sum("total_bookings").alias("total_bookings"),
        F.round(F.sum(F.col("avg_total_fare_bdt").cast(M.SUM_T))
                / F.count("avg_total_fare_bdt").cast(M.COUNT_T), 2).alias("weighted_avg_fare"),
    )
    typ = F.col("season_type")
    return t.agg(
        M.dbl(F.max(F.when(typ == S.PEAK, F.col("weighted_avg_fare")))).alias("peak_avg_fare"),
        M.dbl(F.max(F.when(typ == S.NON_PEAK, F.col("weighted_avg_fare")))).alias("non_peak_avg_fare"),
        F.max(F.when(typ == S.PEAK, F.col("total_bookings"))).alias("peak_bookings"),
        F.max(F.when(typ == S.NON_PEAK, F.col("total_bookings"))).alias("non_peak_bookings"),
    )


def kpi_seasonal(fact: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Per-season fares compared with the non-peak average.

    The one-row comparison is computed with windows over the per-season
    aggregate instead of a cross join.
    """
    s = by_seasonality(fact, rules)
    typ = F.col("season_type")
    s = s.withColumn("_type_avg", _type_avg(Window.partitionBy("season_type")))
    s = (s.withColumn("_peak", F.max(F.when(typ == S.PEAK, F.col("_type_avg"))).over(_all()))
          .withColumn("_np", F.max(F.when(typ == S.NON_PEAK, F.col("_type_avg"))).over(_all())))
    avg, np_, pk = F.col("avg_total_fare_bdt"), F.col("_np"), F.col("_peak")
    out = s.select(
        "seasonality", "season_type", "total_bookings",
        M.dbl("avg_total_fare_bdt").alias("avg_total_fare_bdt"),
        M.dbl("avg_base_fare_bdt").alias("avg_base_fare_bdt"),
        M.dbl("avg_tax_surcharge_bdt").alias("avg_tax_surcharge_bdt"),
        M.dbl("min_fare_bdt").alias("min_fare_bdt"),
        M.dbl("max_fare_bdt").alias("max_fare_bdt"),
        M.dbl("avg_days_before_departure").alias("avg_days_before_departure"),
        M.dbl(F.round(avg - np_, 2)).alias("fare_diff_from_non_peak"),
        M.dbl(M.ratio_round(avg - np_, np_, 2, factor=100, num_t=D2, den_t=D2))
         .alias("fare_pct_diff_from_non_peak"),
        M.dbl(pk).alias("overall_peak_avg_fare"),
        M.dbl(np_).alias("overall_non_peak_avg_fare"),
        M.dbl(M.ratio_round(pk - np_, np_, 2, factor=100, num_t=D2, den_t=D2))
         .alias("peak_vs_non_peak_pct_diff"),
    )
    return out.orderBy(F.col("season_type").desc(), F.col("total_bookings").desc(), "seasonality")
