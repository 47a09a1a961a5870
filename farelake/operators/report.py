"""Run report over the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import money as M


def layer_counts(bronze: DataFrame, stg: DataFrame, dim_airline: DataFrame,
                 dim_route: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row of layer counts and the validation rate (O1, O2).

    Each count is a global aggregate (partial counts per partition); the
    five one-row results are unioned and folded into one row by a global
    aggregate, so no join is needed.
    """
    layers = {"bronze_records": bronze, "silver_records": stg,
              "unique_airlines": dim_airline, "unique_routes": dim_route,
              "date_entries": dim_date}
    parts = [df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
             for name, df in layers.items()]
    tall = reduce(DataFrame.unionByName, parts)
    row = tall.agg(*[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name)
                     for name in layers])
    return row.select(
        "bronze_records", "silver_records",
        # The source system divides by zero on an empty bronze table (Q11).
        M.dbl(M.pct(F.col("silver_records"), F.col("bronze_records"), 1)).alias("validation_rate_pct"),
        "unique_airlines", "unique_routes", "date_entries")


def top_airlines(kpi_booking_count: DataFrame, k: int = 3) -> DataFrame:
    return (kpi_booking_count.select("airline", "total_bookings", "market_share_pct")
            .orderBy(F.col("total_bookings").desc(), F.col("airline")).limit(k))


def top_routes(kpi_routes: DataFrame, k: int = 3) -> DataFrame:
    return (kpi_routes.select("route_code", "total_bookings", "avg_fare_bdt")
            .orderBy(F.col("total_bookings").desc(), F.col("route_code"),
                     F.col("avg_fare_bdt")).limit(k))


def seasonal(kpi_seasonal_df: DataFrame) -> DataFrame:
    """Bookings and mean season fare per season type."""
    x = F.col("avg_total_fare_bdt").cast(M.SUM_T)
    return kpi_seasonal_df.groupBy("season_type").agg(
        F.sum("total_bookings").alias("bookings"),
        M.dbl(F.round(F.sum(x) / F.count(x).cast(M.COUNT_T), 2)).alias("avg_fare"))


def as_one(layers: DataFrame, airlines: DataFrame, routes: DataFrame, seasons: DataFrame) -> DataFrame:
    """The run report as one frame: ``section, item, metric, value``.

    Each part is a handful of rows; the layer counts have the layer row
    itself as their item.
    """
    def tall(df, section, item, metrics):
        pairs = ", ".join(f"'{m}', cast({m} as double)" for m in metrics)
        return df.selectExpr(f"'{section}' as section", f"{item} as item",
                             f"stack({len(metrics)}, {pairs}) as (metric, value)")
    parts = [
        tall(layers, "layers", "'all'", layers.columns),
        tall(airlines, "top_airlines", "airline", ("total_bookings", "market_share_pct")),
        tall(routes, "top_routes", "route_code", ("total_bookings", "avg_fare_bdt")),
        tall(seasons, "seasonal", "season_type", ("bookings", "avg_fare")),
    ]
    return reduce(DataFrame.unionByName, parts)
