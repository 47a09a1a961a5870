"""Queries over whole runs: the fixture as a CSV in the shared folder, loaded, promoted, built and reported.

Each query writes its source files and its lake under names of its own in the
shared folder, runs the pipeline's steps, and returns a resulting table or the
log rows without their times. The fixture that several files hold is derived
once, files are compressed, and each is deleted when it has been read for the
last time, before its rows are loaded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import bronze as B
from farelake.operators import load as L
from farelake.operators import silver
from farelake.operators.changes import at_places
from farelake.operators.ids import POSITION, RANK, with_positions
from farelake.plans import pipeline as P
from farelake.session import shared_dir
from farelake.sources.fixture import booking_fixture
from farelake.sources.lake import Lake
from farelake.sources.working import delete, shuffles_released, working, working_tables


class Run:
    """A lake and source files in a folder of its own."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = f"{shared_dir(spark)}/runs/{uuid.uuid4().hex}"
        self.lake = Lake(spark, f"{self.root}/lake")

    def csv(self, rows: DataFrame, name: str) -> str:
        """The rows as headered CSV files, as they are: white space stays."""
        path = f"{self.root}/{name}"
        with shuffles_released(self.spark):
            rows.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                               ignoreTrailingWhiteSpace=False, compression="gzip").csv(path)
        return path

    def ingest(self, path: str, mode: str, with_profile: bool = True, last: bool = True) -> None:
        """Loads a file, which is deleted when its ``last`` load has read it."""
        try:
            P.ingest(self.spark, path, self.lake, mode, with_profile, after_read=(lambda: self.discard(path)) if last else None)
        finally:
            if last:
                self.discard(path)

    def discard(self, *paths: str) -> None:
        """Deletes source files that no further step reads."""
        for path in paths:
            delete(self.spark, path)

    def source(self) -> DataFrame:
        """The fixture under the file's header names, with ``id`` beside them."""
        return booking_fixture(self.spark, self.sf_dir).withColumnsRenamed({e: s for s, e in S.RENAME.items()})


def _money_out(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _log(lake: Lake, table: str, at: str, *columns: str) -> DataFrame:
    """A log's rows, numbered from 1 as they were written: a few rows a run."""
    return lake.read(table).select(F.row_number().over(Window.orderBy(at)).alias("step"), *columns)


def ingest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after a full load of the CSV."""
    run = Run(spark, sf_dir)
    path = run.csv(run.source().drop("id"), "bookings")
    run.ingest(path, S.FULL)
    staging = run.lake.read(P.STAGING)
    return _money_out(staging.select(*[F.col(f"`{s}`").alias(e) for s, e in S.RENAME.items()], "row_hash", S.LAYOUT_COLUMN))


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log and the ids of four loads: full, incremental, the same again, and one of an unknown mode.

    The first file holds two thirds of the bookings, the others all of them.
    """
    run = Run(spark, sf_dir)
    with working_tables(spark):
        source = working(run.source(), "source")
        some = run.csv(source.where(F.col("id") % 3 != 0).drop("id"), "first")
        every = run.csv(source.drop("id"), "second")
    ids = []
    loads = [(some, S.FULL), (every, S.INCREMENTAL), (every, S.INCREMENTAL), (every, "delta")]
    for step, (path, mode) in enumerate(loads, 1):
        run.ingest(path, mode, with_profile=False, last=path not in [p for p, _ in loads[step:]])
        # one row, taken now: a later frame over the same folder would share its plan
        with shuffles_released(spark):
            ids.append((step, *run.lake.read(P.STAGING).agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()))
    logged = _log(run.lake, L.INGESTION_LOG, "completed_at", "file_name", "status", "rows_expected", "rows_loaded", "error_message")
    return logged.join(spark.createDataFrame(ids, "step int, min_id long, max_id long, distinct_ids long"), "step")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of files that are refused; nothing of them is loaded.

    One lacks a column and has an undeclared one, one holds text and money that
    does not fit, one has no data rows, and one does not exist.
    """
    run = Run(spark, sf_dir)
    source = run.source()
    spoiled = source.withColumn("Base Fare (BDT)", F.when(F.col("id") % 17 == 0, "abc").otherwise(F.col("`Base Fare (BDT)`").cast("string"))).withColumn(
        "Total Fare (BDT)", F.when((F.col("id") % 23 == 0) & F.col("`Total Fare (BDT)`").isNotNull(), "1000000000000000").otherwise(F.col("`Total Fare (BDT)`").cast("string")))
    files = [run.csv(source.drop("Class"), "no_class"), run.csv(spoiled.drop("id"), "spoiled"), run.csv(source.drop("id").limit(0), "no_rows")]
    for path in (*files, f"{run.root}/absent"):
        P.ingest(spark, path, run.lake, S.FULL)
    run.discard(*files)
    loaded = run.lake.read(P.STAGING).count() if run.lake.exists(P.STAGING) else 0
    return _log(run.lake, L.INGESTION_LOG, "completed_at", "file_name", "status", "rows_expected", "rows_loaded",
                F.replace("error_message", F.lit(run.root + "/"), F.lit("")).alias("error_message"),
                F.lit(loaded).cast("long").alias("staged_rows"))


def promote_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a full load and a full promotion."""
    run = Run(spark, sf_dir)
    path = run.csv(run.source().drop("id"), "bookings")
    run.ingest(path, S.FULL, with_profile=False)
    P.promote(spark, run.lake, S.FULL)
    return _money_out(run.lake.read(P.BRONZE).select(*S.ENGINE_COLUMNS, "row_hash", "source_system", S.LAYOUT_COLUMN))


def promote_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of four promotions: without staging, full, incremental, incremental again; and bronze's ids."""
    run = Run(spark, sf_dir)
    P.promote(spark, run.lake, S.FULL)
    with working_tables(spark):
        source = working(run.source(), "source")
        first = run.csv(source.where(F.col("id") % 3 != 0).drop("id"), "first")
        second = run.csv(source.drop("id"), "second")
    run.ingest(first, S.FULL, with_profile=False)
    P.promote(spark, run.lake, S.FULL)
    run.ingest(second, S.INCREMENTAL, with_profile=False)
    with working_tables(spark):
        P.promote(spark, run.lake, S.INCREMENTAL)
    with working_tables(spark):
        P.promote(spark, run.lake, S.INCREMENTAL)
    ids = run.lake.read(P.BRONZE).agg(F.count(F.lit(1)).alias("bronze_rows"), F.count_distinct("id").alias("bronze_ids"))
    moves = _log(run.lake, L.TRANSFER_LOG, "transferred_at", "status", "rows_transferred", "error_message")
    # one row of counts beside each log row
    return moves.withColumn("_one", F.lit(1)).join(F.broadcast(ids.withColumn("_one", F.lit(1))), "_one").drop("_one")


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a whole run from a CSV.

    The file holds the first copy of each duplicate group and every row that
    silver refuses: ids follow the files' order, so which copy of a group comes
    first would otherwise be the writer's choice.
    """
    run = Run(spark, sf_dir)
    with working_tables(spark):
        positioned = working(with_positions(booking_fixture(spark, sf_dir)), "source")
        source = positioned.drop(POSITION)
        bronze = B.enforce_types(source)
        copies = silver.ranked(silver.fare_validated(silver.cleaned(bronze))).where("rn > 1").select(F.col("bronze_id").alias("id"))
        # ids and positions alone are shuffled, and whole rows are picked by position where they are
        places = working(positioned.select("id", POSITION).join(copies, "id", "left_anti").select(POSITION), "kept")
        kept, _ = at_places(positioned, places, POSITION)
        path = run.csv(kept.drop("id", POSITION, RANK).withColumnsRenamed({e: s for s, e in S.RENAME.items()}), "bookings")
    try:
        return P.run_pipeline(spark, path, f"{run.root}/lake", after_read=lambda: run.discard(path)).frame()
    finally:
        run.discard(path)


QUERIES = {f.__name__: f for f in (ingest_full, ingest_incremental, ingest_rejects, promote_full, promote_incremental, pipeline_report)}
