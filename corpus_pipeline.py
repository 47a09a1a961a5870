"""A training corpus from ``documents``: classify, dedup lines, dedup texts, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept. ``run`` writes every stage's rows as Parquet in the shared folder
and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import line_dedup, minhash, quality
from farelake.llm.common import read_table, written
from farelake.llm.queries import QUALITY_THRESHOLD, packed_documents, quality_network


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; the columns stay."""
    scored = quality.score(docs, quality_network(spark, sf_dir), carried=tuple(docs.columns))
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that repeat earlier ones; one of which nothing is left goes.

    ``n_chars`` follows the text where it changed.
    """
    cleaned = line_dedup.dedup_lines(docs)
    changed = F.size("deleted_lines") > 0
    return cleaned.where(~changed | (F.trim("text") != "")).withColumn(
        "n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    dropped = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences of 2048."""
    return packed_documents(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier, the alignment and the packing are beyond SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
