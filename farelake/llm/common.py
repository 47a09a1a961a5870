"""Helpers of the operators: tables in the shared folder, text columns, table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.sources.working import working

#: The letters that the contracts lower-case, in order.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends here.

    Later stages reread the files when an executor is lost, and joins see
    their true size. A ``working_tables`` scope around a run deletes them.
    """
    return working(df, name)


def text_or_empty(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` does just that on ASCII, and faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
