"""Profiling of a source-shaped frame (N1-N7), as tidy DataFrames.

Everything stays distributed: one aggregation per metric family, then an
``unpivot``/``stack`` of the one-row result; no data goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import money as M
from farelake.schema import Rules
from farelake.sources.working import one_row

AIRLINE, SOURCE, DEST = "Airline", "Source", "Destination"
BASE, TOTAL, DURATION = "Base Fare (BDT)", "Total Fare (BDT)", "Duration (hrs)"
VALUE_COUNT_COLUMNS = ("Seasonality", "Class", "Stopovers")


def q(c: str) -> F.Column:
    return F.col(f"`{c}`")


# Profile families that read :func:`summary` instead of the rows.
FROM_SUMMARY = ("shape", "nulls", "null_columns", "stats", "issues", "issue_list")
STAT_COLUMNS = (("base_fare", BASE), ("total_fare", TOTAL), ("duration", DURATION))


def summary_aggregates(columns, value=q, max_duration: float = Rules().max_duration) -> list[F.Column]:
    """Every global aggregate of the profile (N1, N2, N5, N7); ``value`` gives a column's typed value."""
    stat = []
    for name, c in STAT_COLUMNS:
        if c in columns:
            stat += [M.dbl(M.round_money(F.min(value(c)))).alias(f"{name}_min"),
                     M.dbl(M.round_money(F.max(value(c)))).alias(f"{name}_max"),
                     M.dbl(M.avg_round(value(c))).alias(f"{name}_mean")]
    issue = [
        F.count_if(value(BASE) < 0).alias("negative_base_fares"),
        F.count_if(value(TOTAL) <= 0).alias("non_positive_total_fares"),
        F.count_if((value(DURATION) < 0) | (value(DURATION) > max_duration)).alias("invalid_durations"),
    ] if all(c in columns for c in (BASE, TOTAL, DURATION)) else []
    return [F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(value(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
            *stat, *issue]


def summary(df: DataFrame, max_duration: float = Rules().max_duration) -> DataFrame:
    """One row with every global aggregate of the profile, in one scan."""
    return df.agg(*summary_aggregates(df.columns, max_duration=max_duration))


def observed_summary(spark: SparkSession, found: dict) -> DataFrame:
    """The row of :func:`summary` from metrics that a write has observed."""
    names = [n for n in found if n == "total_rows" or n.startswith("_null_") or n in ISSUES
             or n.rpartition("_")[0] in dict(STAT_COLUMNS)]
    kinds = ["double" if n.rpartition("_")[2] in ("min", "max", "mean") else "long" for n in names]
    return one_row(spark, found, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def shape(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """Row and column count."""
    one = df.agg(F.count(F.lit(1)).alias("total_rows")) if one_row is None else one_row
    return one.select("total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns"))


def nulls(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """Null count and percent of rows per column, in one scan."""
    cols = df.columns
    one = summary(df) if one_row is None else one_row
    pairs = ", ".join(f"'{c}', `_null_{i}`" for i, c in enumerate(cols))
    return one.selectExpr("total_rows", f"stack({len(cols)}, {pairs}) as (column_name, null_count)").select(
        "column_name", F.col("null_count").cast("bigint").alias("null_count"),
        M.dbl(M.pct(F.col("null_count"), F.col("total_rows"), 2)).alias("null_pct"))


def null_columns(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """How many columns hold nulls."""
    return nulls(df, one_row).agg(F.count_if(F.col("null_count") > 0).alias("missing_value_columns"))


def value_counts(df: DataFrame, columns=VALUE_COUNT_COLUMNS) -> DataFrame:
    """Value counts per column, nulls excluded, percent over all rows.

    Each row is stacked into (column, value) pairs so that all columns are
    counted by one shuffle. The totals, one row a column, come from the same
    counts and are joined in, so a column of many values stays spread out.
    """
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    stacked = df.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, value)")
    counts = stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))
    totals = counts.groupBy("column_name").agg(F.sum("value_count").alias("_n"))
    return (counts.where(F.col("value").isNotNull()).join(F.broadcast(totals), "column_name")
                  .select("column_name", "value", "value_count",
                          M.dbl(M.pct(F.col("value_count"), F.col("_n"), 1)).alias("pct")))


def distincts(df: DataFrame) -> DataFrame:
    """Distinct airlines, sources, destinations and source-destination pairs.

    Rows are folded to their distinct (airline, source, destination) first,
    with map-side combining, so the four distinct counts expand that small
    frame and not every row.
    """
    small = df.groupBy(q(AIRLINE), q(SOURCE), q(DEST)).agg(F.count(F.lit(1)).alias("_n"))
    return small.agg(
        F.count_distinct(q(AIRLINE)).alias("unique_airlines"),
        F.count_distinct(q(SOURCE)).alias("unique_sources"),
        F.count_distinct(q(DEST)).alias("unique_destinations"),
        F.count_distinct(q(SOURCE), q(DEST)).alias("unique_routes"),
    )


def top_values(df: DataFrame, column: str = AIRLINE, k: int = 5) -> DataFrame:
    """Most frequent values with percent of all rows (N4, J6); ties by value.

    A distributed top-k; the total of all rows is a one-row subquery over the
    same counts.
    """
    counts = df.groupBy(q(column).alias("value")).agg(F.count(F.lit(1)).alias("value_count"))
    total = counts.agg(F.sum("value_count")).scalar()
    return (counts.where(F.col("value").isNotNull())
                  .orderBy(F.col("value_count").desc(), F.col("value").asc()).limit(k)
                  .select("value", "value_count", M.dbl(M.pct(F.col("value_count"), total, 1)).alias("pct")))


def stats(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """Min / max / mean of base fare, total fare and duration."""
    one = summary(df) if one_row is None else one_row
    return one.select(*[f"{name}_{kind}" for name, _ in STAT_COLUMNS for kind in ("min", "max", "mean")])


ISSUES = ("negative_base_fares", "non_positive_total_fares", "invalid_durations")


def issues(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """Counters of data-quality issues."""
    one = summary(df) if one_row is None else one_row
    return one.select(*ISSUES)


def issue_list(df: DataFrame, one_row: DataFrame | None = None) -> DataFrame:
    """The issues that occur, with their row counts."""
    pairs = ", ".join(f"'{c}', {c}" for c in ISSUES)
    return issues(df, one_row).selectExpr(f"stack({len(ISSUES)}, {pairs}) as (issue, rows)").where("rows > 0")
