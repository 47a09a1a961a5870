"""Declarative data-quality checks on model outputs (H1-H3).

Each check gives a row ``(model, check_name, column_name, failures)``. All checks of
one model are one scan: ``not_null`` and ``accepted_values`` are conditional
counts, and ``unique`` counts rows per key, combined on the map side, with the
other counts carried along per key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S

RESULT = "model string, check_name string, column_name string, failures bigint"


@dataclass(frozen=True)
class Check:
    model: str
    check: str           # not_null | unique | accepted_values
    column: str
    values: tuple = ()


def _failing(ck: Check) -> F.Column:
    """Whether a row fails a check that looks at one row; a NULL is no unaccepted value."""
    if ck.check == "not_null":
        return F.col(ck.column).isNull()
    if ck.check == "accepted_values":
        return F.coalesce(~F.col(ck.column).isin(*ck.values), F.lit(False))
    raise ValueError(f"unknown check {ck.check}")


def check_model(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """The checks of one model in one scan.

    A unique check fails once per non-null value that occurs more than once.
    Several unique columns stack each row once per column, and the row's other
    counts go with the first of them.
    """
    names = [f"_{i}" for i in range(len(checks))]
    keys = [ck.column for ck in checks if ck.check == "unique"]
    rowwise = {n: _failing(ck) for n, ck in zip(names, checks) if ck.check != "unique"}
    if not keys:
        totals = df.agg(*[F.count_if(c).alias(n) for n, c in rowwise.items()])
    else:
        if len(keys) == 1:
            stacked = df.select(F.lit(0).alias("_at"), F.col(keys[0]).alias("_key"), *[c.alias(n) for n, c in rowwise.items()])
        else:
            pairs = ", ".join(f"{i}, cast(`{c}` as string)" for i, c in enumerate(keys))
            stacked = (df.select("*", *[c.alias(n) for n, c in rowwise.items()])
                       .selectExpr(*rowwise, f"stack({len(keys)}, {pairs}) as (_at, _key)"))
        first = F.col("_at") == 0
        per_key = stacked.groupBy("_at", "_key").agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(first & F.col(n)).alias(n) for n in rowwise])
        repeated = F.col("_key").isNotNull() & (F.col("_n") > 1)
        totals = per_key.agg(*[
            (F.count_if(repeated & (F.col("_at") == keys.index(ck.column))) if ck.check == "unique"
             else F.coalesce(F.sum(n), F.lit(0))).alias(n)
            for n, ck in zip(names, checks)])
    rows = ", ".join(f"'{ck.check}', '{ck.column}', `{n}`" for n, ck in zip(names, checks))
    return totals.selectExpr(f"stack({len(checks)}, {rows}) as (check_name, column_name, failures)").select(
        F.lit(model).alias("model"), "check_name", "column_name", F.col("failures").cast("bigint").alias("failures"))


def not_null(df: DataFrame, model: str, columns) -> DataFrame:
    return check_model(df, model, [Check(model, "not_null", c) for c in columns])


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    return check_model(df, model, [Check(model, "unique", column)])


def accepted_values(df: DataFrame, model: str, column: str, values) -> DataFrame:
    """Rows whose non-null value is outside ``values``."""
    return check_model(df, model, [Check(model, "accepted_values", column, tuple(values))])


def run_checks(tables: dict[str, DataFrame], checks) -> DataFrame:
    """The checks of all models, one scan each."""
    by_model: dict[str, list[Check]] = {}
    for ck in checks:
        by_model.setdefault(ck.model, []).append(ck)
    return reduce(DataFrame.unionByName, [check_model(tables[m], m, c) for m, c in by_model.items()])


# The checks declared on the silver and gold models.
NN = "not_null"
SILVER_CHECKS = (
    *[Check("stg_flight_bookings", NN, c) for c in
      ("bronze_id", "airline", "source_code", "destination_code", "total_fare_bdt")],
    Check("stg_validation_failures", NN, "failure_reason"),
    Check("stg_validation_failures", "accepted_values", "failure_reason", S.FAILURE_REASONS),
)
GOLD_CHECKS = (
    Check("kpi_avg_fare_by_airline", "unique", "airline"),
    *[Check("kpi_avg_fare_by_airline", NN, c) for c in
      ("airline", "total_bookings", "avg_total_fare_bdt", "market_share_pct")],
    *[Check("kpi_seasonal_fare_variation", NN, c) for c in
      ("seasonality", "season_type", "total_bookings", "avg_total_fare_bdt")],
    Check("kpi_seasonal_fare_variation", "accepted_values", "season_type", (S.PEAK, S.NON_PEAK)),
    Check("kpi_booking_count_by_airline", "unique", "airline"),
    *[Check("kpi_booking_count_by_airline", NN, c) for c in
      ("airline", "total_bookings", "booking_rank", "market_share_pct")],
    Check("kpi_most_popular_routes", "unique", "route_code"),
    *[Check("kpi_most_popular_routes", NN, c) for c in
      ("route_code", "total_bookings", "route_rank", "avg_fare_bdt")],
)
ALL_CHECKS = SILVER_CHECKS + GOLD_CHECKS
