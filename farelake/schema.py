"""Declared shapes, fixed labels and run parameters of the booking pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values of the source system's
# declarations for results to match; they are listed in natural order.
# ---------------------------------------------------------------------------

# CSV header -> engine column, in the declared column order of the file.
RENAME = {
    "Airline": "airline",
    "Source": "source_code",
    "Source Name": "source_name",
    "Destination": "destination_code",
    "Destination Name": "destination_name",
    "Departure Date & Time": "departure_datetime",
    "Arrival Date & Time": "arrival_datetime",
    "Duration (hrs)": "duration_hours",
    "Stopovers": "stopovers",
    "Aircraft Type": "aircraft_type",
    "Class": "booking_class",
    "Booking Source": "booking_source",
    "Base Fare (BDT)": "base_fare_bdt",
    "Tax & Surcharge (BDT)": "tax_surcharge_bdt",
    "Total Fare (BDT)": "total_fare_bdt",
    "Seasonality": "seasonality",
    "Days Before Departure": "days_before_departure",
}

# Declared numeric kinds of the CSV columns; all other columns are text.
NUMERIC_KINDS = {
    "Duration (hrs)": "double",
    "Base Fare (BDT)": "double",
    "Tax & Surcharge (BDT)": "double",
    "Total Fare (BDT)": "double",
    "Days Before Departure": "int",
}

# Load modes.
FULL = "full"
INCREMENTAL = "incremental"

# Row-hash canonical form: separator and null token.
HASH_SEPARATOR = "|"
HASH_NULL = "NULL"

# Surrogate-key canonical form: separator and null token.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Defaults for missing text values in the silver layer.
TEXT_DEFAULTS = {
    "airline": "Unknown",
    "source_code": "UNK",
    "source_name": "Unknown Airport",
    "destination_code": "UNK",
    "destination_name": "Unknown Airport",
    "stopovers": "Unknown",
    "aircraft_type": "Unknown",
    "booking_source": "Unknown",
}

# Booking class standardisation: label -> accepted spellings (lower case).
CLASS_LABELS = {
    "First": ("first class", "first"),
    "Business": ("business class", "business"),
    "Economy": ("economy class", "economy"),
}
CLASS_DEFAULT = "Economy"

# Seasonality standardisation, first match wins: (label, substring).
SEASON_CONTAINS = (("Winter", "winter"), ("Eid", "eid"), ("Hajj", "hajj"))
SEASON_EXACT = ("Regular", "regular")
SEASON_DEFAULT = "Regular"

# Booking lead-time buckets: (upper bound in days, label); above all: Early Bird.
LEAD_BUCKETS = ((7, "Last Minute"), (14, "Short Notice"), (30, "Standard"), (60, "Advance"))
LEAD_LAST = "Early Bird"

# Weather season by calendar month.
WEATHER_SEASONS = (
    ("Winter", (11, 12, 1, 2)),
    ("Summer", (3, 4, 5)),
    ("Monsoon", (6, 7, 8, 9, 10)),
)
WEATHER_DEFAULT = "Unknown"

# Failure reasons of the audit table, in rule order.
FAILURE_REASONS = (
    "missing_airline",
    "missing_source",
    "missing_destination",
    "negative_duration",
    "excessive_duration",
    "negative_base_fare",
    "invalid_total_fare",
    "unknown_failure",
)

# Season types.
PEAK = "Peak"
NON_PEAK = "Non-Peak"

# Labels counted by the gold KPIs.
BOOKING_SOURCES = (("online_bookings", "Online Website"),
                   ("agency_bookings", "Travel Agency"),
                   ("direct_bookings", "Direct Booking"))
DIRECT_STOPOVER = "Direct"
# Labels as the gold models of the source system spelled them; silver
# standardises to other labels, so counting these yields 0 (legacy mode).
LEGACY_FIRST_CLASS = "First Class"
LEGACY_PEAK_SEASONS = ("Eid ul-Fitr", "Eid ul-Adha", "Winter Holidays")

SOURCE_SYSTEM = "mysql_staging"

# Partition column of the staging and bronze tables, and its value for rows
# without a readable departure date.
LAYOUT_COLUMN = "departure_month"
NO_MONTH = "-"

# ---------------------------------------------------------------------------
# Derived declarations
# ---------------------------------------------------------------------------

SOURCE_COLUMNS = tuple(RENAME)
ENGINE_COLUMNS = tuple(RENAME.values())

# Money is exact decimal; 6 decimals keep any CSV text exactly and stay a
# compact (long-backed) decimal in Spark.
MONEY = T.DecimalType(18, 6)
MONEY_COLUMNS = ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")
INT_SOURCE = tuple(c for c, kind in NUMERIC_KINDS.items() if kind == "int")
MONEY_SOURCE = tuple(src for src, eng in RENAME.items() if eng in MONEY_COLUMNS)

ENGINE_TYPES = {
    c: (MONEY if c in MONEY_COLUMNS
        else T.DoubleType() if c == "duration_hours"
        else T.IntegerType() if c == "days_before_departure"
        else T.StringType())
    for c in ENGINE_COLUMNS
}

# Python's str.strip() whitespace set, derived from str.isspace().
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Dedupe key of the silver layer.
DEDUPE_KEYS = ("airline", "source_code", "destination_code", "departure_datetime",
               "booking_class", "base_fare_bdt")


@dataclass(frozen=True)
class Rules:
    """Run parameters of the silver and gold layers."""

    max_duration: float = 48.0
    min_fare: float = 0.0
    peak_seasons: tuple = ("Eid", "Hajj", "Winter")
    # Count the labels the source system's gold models used (always 0 after
    # silver standardisation) instead of the standardised ones.
    legacy_labels: bool = False
    # Apply validity rules before picking the first copy of a duplicate
    # group (the source system ranks first, then filters).
    validate_first: bool = False
    # Raise when a route code pair has more than one name spelling.
    strict_routes: bool = False
    # Approximate instead of exact medians.
    approx_median: bool = False
