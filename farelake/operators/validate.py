"""Structural validation of a source frame."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators.ids import POSITION
from farelake.sources.csv import HEADER_ONLY, MALFORMED, SourceError, preflight, read_text_csv

log = logging.getLogger(__name__)

INTERNAL = (MALFORMED, POSITION)


@dataclass
class ValidationResult:
    ok: bool
    errors: list[str] = field(default_factory=list)
    df: DataFrame | None = None
    rows: int | None = None


def missing_columns(df: DataFrame) -> list[str]:
    """Required columns (B1) that the frame lacks; other columns are reported and ignored (B2)."""
    extra = [c for c in df.columns if c not in S.SOURCE_COLUMNS and c not in INTERNAL]
    if extra:
        log.warning("Source columns outside the declared set are skipped: %s", extra)
    return [c for c in S.SOURCE_COLUMNS if c not in df.columns]


def _text(column: str):
    return F.col(f"`{column}`").cast("string")


def problem_aggregates(columns) -> list[F.Column]:
    """``rows``, and per numeric column the values that are no number and those that do not fit."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in S.NUMERIC_KINDS:
        if c not in columns:
            continue
        number = _text(c).try_cast("double")
        aggs.append(F.count_if(_text(c).isNotNull() & number.isNull()).alias(f"text: {c}"))
        if c in S.MONEY_SOURCE:
            aggs.append(F.count_if(number.isNotNull() & _text(c).try_cast(S.MONEY).isNull()).alias(f"range: {c}"))
    if MALFORMED in columns:
        aggs += [F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
                 F.min(F.substring(MALFORMED, 1, 200)).alias("malformed_line")]
    return aggs


def value_problems(df: DataFrame) -> DataFrame:
    """One row of :func:`problem_aggregates`."""
    return df.agg(*problem_aggregates(df.columns))


def check_frame(df: DataFrame, found: dict | None = None) -> ValidationResult:
    """Required columns (B1), extra columns (B2), values (B3), verdict (B4), in one aggregation.

    A frame without data rows, with a row of too many fields, with text in a
    numeric column or with money that the declared type cannot hold fails.
    ``found`` are the aggregates when a write of the frame has observed them.
    """
    missing = missing_columns(df)
    errors = [f"Missing columns: {missing}"] if missing else []
    found = value_problems(df).first().asDict() if found is None else found
    if found["rows"] == 0:
        errors.append(HEADER_ONLY)
    if found.get("malformed"):
        errors.append(f"CSV parsing error: {found['malformed']} row(s) with more fields than the header, "
                      f"such as: {found['malformed_line']}")
    for c, kind in S.NUMERIC_KINDS.items():
        if found.get(f"text: {c}"):
            errors.append(f"Column '{c}' expected {kind}, got text")
        if found.get(f"range: {c}"):
            errors.append(f"Column '{c}' holds {found[f'range: {c}']} value(s) beyond {S.MONEY.simpleString()}")
    keep = [*S.SOURCE_COLUMNS, *(c for c in (POSITION,) if c in df.columns)]
    selected = df.select(*[F.col(f"`{c}`") for c in keep]) if not missing else None
    return ValidationResult(not errors, errors, selected, int(found["rows"]))


def check_structure(spark: SparkSession, path: str, multiline: bool = False) -> ValidationResult:
    """Preflight (A2) then :func:`check_frame` on the all-text read."""
    try:
        preflight(spark, path)
        df = read_text_csv(spark, path, multiline)
    except SourceError as e:
        return ValidationResult(False, [str(e)], None)
    return check_frame(df)


def typed_value(src: str) -> F.Column:
    """A source column's text as its declared type (money exact, ints via rounding)."""
    c, eng = F.col(f"`{src}`"), S.RENAME[src]
    if eng == "days_before_departure":
        return F.round(c.cast("string").try_cast("decimal(18,6)")).try_cast("int")
    if eng in S.MONEY_COLUMNS:
        return c.cast("string").try_cast(S.MONEY)
    return c.try_cast(S.ENGINE_TYPES[eng])
