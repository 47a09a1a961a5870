"""Staging -> bronze: typing, renaming, hashing, default columns."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.keys import hash_bytes, row_hash

log = logging.getLogger(__name__)


def enforce_types(df: DataFrame) -> DataFrame:
    """Project the 17 engine columns (plus ``id`` when present) to their declared types.

    Text is cast with ``try_cast`` so an unparseable number becomes NULL
    rather than failing the job; structural validation (B3) reports such
    values before load.
    """
    cols = [F.col("id").cast("long").alias("id")] if "id" in df.columns else []
    cols += [F.col(c).try_cast(S.ENGINE_TYPES[c]).alias(c) for c in S.ENGINE_COLUMNS]
    extra = [c for c in ("row_hash", "source_system", "ingested_at", S.LAYOUT_COLUMN) if c in df.columns]
    return df.select(*cols, *extra)


def with_row_hash(df: DataFrame, columns=S.ENGINE_COLUMNS) -> DataFrame:
    """Add ``row_hash`` over ``columns`` in declared order."""
    return df.withColumn("row_hash", row_hash(df, columns))


def duplicate_hash_metric(df: DataFrame) -> DataFrame:
    """``total_rows - distinct(row_hash)``; rows are kept, this only measures.

    One aggregation; the distinct count is a two-phase (partial/final)
    aggregation keyed by the hash, so it never gathers rows in one task. The
    16 bytes that a hash spells are shuffled instead of its 32 characters.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(hash_bytes("row_hash")).alias("distinct_hashes"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_hashes"))


def to_bronze(staging: DataFrame, source_system: str = S.SOURCE_SYSTEM) -> DataFrame:
    """Rename source headers to engine names, drop staging ids, add defaults."""
    df = staging.drop("id", "ingested_at")
    if "row_hash" not in df.columns:
        log.warning("Staging rows carry no row_hash; bronze will have none either")
    df = df.withColumnsRenamed({k: v for k, v in S.RENAME.items() if k in df.columns})
    return df.withColumn("source_system", F.lit(source_system))


def to_staging(df: DataFrame) -> DataFrame:
    """Engine-named columns back to the source file's header names."""
    back = {v: k for k, v in S.RENAME.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})
