from pyspark.sql import functions as F

from farelake import schema as S

BRONZE_DDL = ", ".join(
    ["id long"] + [f"{c} {S.ENGINE_TYPES[c].simpleString()}" for c in S.ENGINE_COLUMNS])


def booking(id, **kw):
    """One bronze row with valid defaults; keyword arguments override columns."""
    from decimal import Decimal
    row = dict(
        airline="Air One", source_code="DAC", source_name="Dhaka", destination_code="CXB",
        destination_name="Cox's Bazar", departure_datetime="2024-01-06 06:30:00",
        arrival_datetime="2024-01-06 07:30:00", duration_hours=1.0, stopovers="Direct",
        aircraft_type="ATR", booking_class="Economy", booking_source="Online Website",
        base_fare_bdt=Decimal("100"), tax_surcharge_bdt=Decimal("10"), total_fare_bdt=Decimal("110"),
        seasonality="Regular", days_before_departure=10)
    row.update(kw)
    for m in S.MONEY_COLUMNS:
        if row[m] is not None and not isinstance(row[m], Decimal):
            row[m] = Decimal(str(row[m]))
    return (id, *[row[c] for c in S.ENGINE_COLUMNS])


def bronze_df(spark, rows):
    return spark.createDataFrame(rows, BRONZE_DDL)


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def by_id(df, key="bronze_id"):
    return {r[key]: r for r in df.collect()}


__all__ = ["F", "booking", "bronze_df", "col_values", "by_id"]
