"""Silver-layer cleaning rules as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_or(c, default: str) -> Column:
    """``coalesce(trim(c), default)``; an empty string stays empty."""
    return F.coalesce(F.trim(col(c)), F.lit(default))


def or_zero(c) -> Column:
    """``coalesce(c, 0)`` keeping the column type."""
    return F.coalesce(col(c), F.lit(0))


def standard_class(c) -> Column:
    """Booking class standardiser."""
    key = F.lower(F.trim(col(c)))
    out = None
    for label, spellings in S.CLASS_LABELS.items():
        cond = key.isin(*spellings)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.coalesce(F.trim(col(c)), F.lit(S.CLASS_DEFAULT)))


def standard_season(c) -> Column:
    """Seasonality standardiser, first match wins."""
    key = F.lower(F.trim(col(c)))
    out = None
    for label, part in S.SEASON_CONTAINS:
        cond = key.contains(part)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    label, exact = S.SEASON_EXACT
    return (out.when(key == exact, label)
            .otherwise(F.coalesce(F.trim(col(c)), F.lit(S.SEASON_DEFAULT))))


def repaired_total(total, base, tax) -> Column:
    """Total fare repair: zero or below base -> base + tax."""
    total, base, tax = col(total), col(base), col(tax)
    return (F.when((total == 0) | (total < base), (base + tax).cast(S.MONEY))
            .otherwise(total))


def tax_percentage(tax, base) -> Column:
    """``round(tax / base * 100, 2)`` for a positive base, else 0.

    Exact decimal arithmetic: the quotient keeps 16 decimals before rounding.
    """
    tax, base = col(tax), col(base)
    hundred = F.lit(100).cast("decimal(3,0)")
    pct = F.round(tax * hundred / F.when(base > 0, base), 2)
    return F.when(base > 0, pct).otherwise(F.lit(0)).cast("decimal(12,2)")


def lead_category(days) -> Column:
    """Booking lead-time bucket."""
    d = col(days)
    out = None
    for bound, label in S.LEAD_BUCKETS:
        out = F.when(d <= bound, label) if out is None else out.when(d <= bound, label)
    return out.otherwise(S.LEAD_LAST)


def season_type(season, peak=("Eid", "Hajj", "Winter")) -> Column:
    """Peak / Non-Peak classifier."""
    return F.when(col(season).isin(*peak), S.PEAK).otherwise(S.NON_PEAK)


def failure_rules(rules) -> list[tuple[str, Column]]:
    """Rejection rules in order (D13, E3); NULL numerics do not fail."""
    dur, base = F.col("duration_hours"), F.col("base_fare_bdt")
    total, tax = F.col("total_fare_bdt"), F.col("tax_surcharge_bdt")
    return [
        ("missing_airline", F.col("airline").isNull()),
        ("missing_source", F.col("source_code").isNull()),
        ("missing_destination", F.col("destination_code").isNull()),
        ("negative_duration", dur < 0),
        ("excessive_duration", dur > F.lit(rules.max_duration)),
        ("negative_base_fare", base < F.lit(Decimal(str(rules.min_fare))).cast(S.MONEY)),
        ("invalid_total_fare", (total <= 0) & ((base + F.coalesce(tax, F.lit(0))) <= 0)),
    ]


def failure_reason(rules) -> Column:
    out = None
    for reason, cond in failure_rules(rules):
        out = F.when(cond, reason) if out is None else out.when(cond, reason)
    return out.otherwise(S.FAILURE_REASONS[-1])


def any_failure(rules) -> Column:
    out = None
    for _, cond in failure_rules(rules):
        out = cond if out is None else (out | cond)
    return out
