"""Date attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.keys import strip_ws


def departure_date(departure) -> Column:
    """Date part of ``'YYYY-MM-DD HH:MM:SS'``; unparseable text -> NULL."""
    c = F.col(departure) if isinstance(departure, str) else departure
    return F.split_part(c, F.lit(" "), F.lit(1)).try_cast("date")


def date_key(d: Column) -> Column:
    """``yyyyMMdd`` as int, by arithmetic rather than string formatting."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(d) - 1).cast("int")


def weather_season(d: Column) -> Column:
    m = F.month(d)
    out = None
    for label, months in S.WEATHER_SEASONS:
        out = F.when(m.isin(*months), label) if out is None else out.when(m.isin(*months), label)
    return out.otherwise(S.WEATHER_DEFAULT)


def attributes(d: Column) -> list[Column]:
    """All date-dimension attributes of date column ``d``."""
    dow = day_of_week(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        dow.isin(0, 6).alias("is_weekend"),
        weather_season(d).alias("weather_season"),
    ]


def departure_month(departure) -> Column:
    """``yyyy-MM`` of the departure date; ``S.NO_MONTH`` when the text is not a date.

    Layout column of the staging and bronze tables. Its cardinality is the
    number of calendar months. It is derived from the same stripped text that
    the content hash covers, so rows with equal hashes always share it, and an
    incremental load may prune the target to the months of the batch.
    """
    c = F.col(departure) if isinstance(departure, str) else departure
    return F.coalesce(F.date_format(departure_date(strip_ws(c)), "yyyy-MM"), F.lit(S.NO_MONTH))
