"""Booking CSV source: preflight checks and an all-text read by header name (A1, A2)."""

from __future__ import annotations

from csv import reader

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from farelake.sources.records import QuoteError, csv_records

# The text tokens that pandas' CSV reader turns into a missing
# value by default (its documented ``na_values`` list).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")

# Column of :func:`read_text_csv`: the raw line of a row with too many fields.
MALFORMED = "_malformed_line"
_CORRUPT = "_corrupt_record"

HEADER_ONLY = "CSV file contains only headers, no data rows"


class SourceError(Exception):
    """The file cannot be used at all (missing, empty, header only, unreadable)."""


def preflight(spark: SparkSession, path: str) -> None:
    """Raise :class:`SourceError` for a missing or empty file (A2).

    Existence and emptiness are checked through Spark's own file listing, so
    the path may be on any Hadoop file system. Whether data rows follow the
    header is known from the parsed rows (:mod:`farelake.operators.validate`).
    """
    try:
        empty = spark.read.text(path).isEmpty()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceError(f"File not found: {path}") from None
        raise SourceError(f"CSV parsing error: {e}") from None
    if empty:
        raise SourceError("CSV file is empty (0 bytes)")


def _options() -> dict:
    return dict(header=True, mode="PERMISSIVE", quote='"', escape='"', enforceSchema=False, columnPruning=False)


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _CORRUPT]])


def _multiline(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The header's columns and the parsed records of files whose records may span lines."""
    try:
        records = csv_records(spark, path)
    except QuoteError as e:
        raise SourceError(f"CSV parsing error: {e}") from None
    heads = [r["text"] for r in records.where("head").select("text").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise SourceError("CSV parsing error: the files' headers differ")
    columns = next(reader([heads[0]]))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, _CORRUPT])
    fields = F.from_csv(F.col("text"), schema, dict(quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT))
    rows = records.where(~F.col("head") & (F.trim("text") != ""))
    return columns, rows.select(fields.alias("_r")).select("_r.*")


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column as text, matched by header name, NA tokens -> NULL.

    The header gives the column names; no types are inferred (a full extra
    pass). Every file of a directory must carry the same header. A row with
    fewer fields than the header is filled with NULLs; one with more fields
    keeps its raw text in :data:`MALFORMED`, and validation rejects the file.
    ``multiline`` reads quoted fields that hold line breaks, from all splits of
    a file at once (:mod:`farelake.sources.records`).
    """
    if multiline:
        columns, df = _multiline(spark, path)
    else:
        columns = spark.read.options(**_options()).csv(path).columns
        df = spark.read.options(**_options(), columnNameOfCorruptRecord=_CORRUPT).schema(_text_schema(columns)).csv(path)
    # A row is flagged for too few or too many fields; only the latter has one
    # past the last column. A letter after the line keeps an empty last field.
    wider = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    fields = F.from_csv(F.concat(F.col(_CORRUPT), F.lit("x")), wider, dict(quote='"', escape='"',
                                                                      mode="PERMISSIVE"))
    over_long = fields[f"c{len(columns)}"].isNotNull()
    return df.select(
        *[F.when(F.col(f"`{c}`").isin(*NA_TOKENS), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
          for c in columns],
        F.when(F.col(_CORRUPT).isNotNull() & over_long, F.col(_CORRUPT)).alias(MALFORMED))
