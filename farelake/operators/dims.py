"""Dimensions derived from silver bookings (M3-M5).

Each dimension carries its presentation order (J1). Catalyst drops a sort
below a join or an aggregation, so consumers do not pay for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import dates as D
from farelake.functions.keys import surrogate_key


def airline_key(airline="airline") -> F.Column:
    return surrogate_key(airline)


def route_key(source="source_code", destination="destination_code") -> F.Column:
    return surrogate_key(source, destination)


def dim_airline(stg: DataFrame) -> DataFrame:
    """Distinct airlines with an MD5 surrogate key."""
    return (stg.where(F.col("airline").isNotNull()).select("airline").distinct()
               .select(airline_key("airline").alias("airline_key"),
                       F.col("airline").alias("airline_name"))
               .orderBy("airline_name"))


def dim_route(stg: DataFrame) -> DataFrame:
    """Distinct (codes, names) with a key over the codes only (M4).

    The key ignores the names, so a code pair with two name spellings yields
    two rows with the same ``route_key`` (source-system fan-out, Q7).
    """
    routes = (stg.where(F.col("source_code").isNotNull() & F.col("destination_code").isNotNull())
                 .select("source_code", "source_name", "destination_code", "destination_name")
                 .distinct())
    return routes.select(
        route_key().alias("route_key"),
        "source_code", "source_name", "destination_code", "destination_name",
        F.concat(F.col("source_code"), F.lit("-"), F.col("destination_code")).alias("route_code"),
        F.concat(F.col("source_name"), F.lit(" to "), F.col("destination_name")).alias("route_description"),
    ).orderBy("source_code", "destination_code")


def dim_date(stg: DataFrame) -> DataFrame:
    """Distinct departure dates with calendar attributes (M5).

    Text that is not a date yields no row (the source system's cast would fail
    the whole model instead; T4).
    """
    dep = F.col("departure_datetime")
    dates = (stg.where(dep.isNotNull() & (dep != ""))
                .select(D.departure_date(dep).alias("d")).distinct()
                .where(F.col("d").isNotNull()))
    return dates.select(*D.attributes(F.col("d"))).orderBy("full_date")


def check_unique_routes(dim: DataFrame) -> None:
    """Raise when one ``route_key`` has several name spellings (strict mode)."""
    dup = dim.groupBy("route_key").count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError("dim_route: a source/destination code pair has more than one name spelling")
