"""Booking fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import cleaning as C
from farelake.functions import dates as D
from farelake.operators import dims

FACT_COLUMNS = (
    "airline_key", "route_key", "date_key", "booking_id", "booking_class", "booking_source",
    "stopovers", "aircraft_type", "departure_datetime", "arrival_datetime", "duration_hours",
    "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt", "days_before_departure",
    "seasonality", "tax_percentage", "booking_lead_category",
)


def fact_bookings(stg: DataFrame, dim_route: DataFrame | None = None,
                  rules: S.Rules = S.Rules(), columns: tuple[str, ...] = FACT_COLUMNS) -> DataFrame:
    """Silver bookings with dimension keys, degenerate dimensions and derived measures.

    The airline and date dimensions hold exactly the distinct natural keys
    of ``stg``, and their keys are deterministic functions of those natural
    keys, so the left joins F1 and F3 reduce to computing the key on the
    booking row: no join and no shuffle of the fact. The route dimension
    is joined (F2) because it can hold several name spellings per code pair
    and the source system multiplies bookings by them (Q7). That join is a plain
    equi-join: Spark broadcasts the dimension when its size is known to be
    small (file statistics, or AQE's runtime size) and shuffles otherwise,
    with AQE splitting a skewed route partition.

    ``columns`` names the fact columns to return, where ``stg`` holds no
    others' inputs; the rows are the same.
    """
    if dim_route is None:
        dim_route = dims.dim_route(stg)
    if rules.strict_routes:
        dims.check_unique_routes(dim_route)
    routes = dim_route.select(
        "route_key", F.col("source_code").alias("_rs"), F.col("destination_code").alias("_rd"))
    derived = {
        "airline_key": F.when(F.col("airline").isNotNull(), dims.airline_key("airline")),
        "date_key": D.date_key(D.departure_date("departure_datetime")),
        "booking_id": F.col("bronze_id"),
        "tax_percentage": C.tax_percentage("tax_surcharge_bdt", "base_fare_bdt"),
        "booking_lead_category": C.lead_category("days_before_departure"),
    }
    j = stg.join(routes, (stg.source_code == routes._rs) & (stg.destination_code == routes._rd), "left")
    keep = [c for c in ("ingested_at",) if c in stg.columns]
    return j.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS if c in columns], *keep)
