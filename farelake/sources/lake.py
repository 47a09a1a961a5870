"""Layer tables as Parquet directories under one shared root.

A table is a set of versions ``<root>/<table>/v<n>``. Overwriting writes the
next version and then appends a commit row to ``<root>/_commits``; readers
use the newest committed version. A failed write therefore leaves the old
data readable, and a plan may read a table while it writes the table's
next version (trap T8). The commit row also holds the schema, so a version
without rows reads as an empty table. Appends add files to the current
version through Spark's file-commit protocol; a job that fails before its
commit leaves the table as it was, and a repeated incremental load skips
whatever an interrupted one had added.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from farelake.functions.keys import hash_bytes, hash_text
from farelake.sources.working import CODEC, one_row, shuffles_released

COMMITS = "_commits"
#: Columns of md5 text, if a table has them.
HASHES = ("row_hash",)


class RowCountError(Exception):
    """A written version does not hold the rows it should; it is not committed."""


class Lake:
    """Layer tables under ``root``.

    The newest committed version of every table is read from the commit log
    once (one row per table) and then kept up to date by this instance's
    own writes; call :meth:`refresh` to see commits made by other writers.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._versions: dict[str, tuple[str, str]] | None = None
        self._committing = threading.Lock()

    # ---------------------------------------------------------------- catalog
    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{COMMITS}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def refresh(self) -> None:
        c = self._commits()
        if c is None:
            self._versions = {}
            return
        last = F.max_by(F.struct("version", "schema"), F.struct("committed_at", "version"))
        rows = c.groupBy("table").agg(last.alias("v")).collect()
        self._versions = {r["table"]: (r["v"]["version"], r["v"]["schema"]) for r in rows}

    def current(self, table: str) -> str | None:
        """Path of the newest committed version of ``table``."""
        if self._versions is None:
            self.refresh()
        v = self._versions.get(table)
        return None if v is None else f"{self.root}/{table}/{v[0]}"

    def exists(self, table: str) -> bool:
        return self.current(table) is not None

    def read(self, table: str) -> DataFrame:
        path = self.current(table)
        if path is None:
            raise FileNotFoundError(f"table {table!r} has no committed version in {self.root}")
        schema = T.StructType.fromJson(json.loads(self._versions[table][1]))
        return self.spark.read.schema(schema).parquet(path)

    def _commit(self, table: str, version: str, schema: str) -> None:
        row = one_row(self.spark, dict(table=table, version=version, schema=schema), "table string, version string, schema string").withColumn(
            "committed_at", F.current_timestamp())
        with self._committing:   # appends to one folder must not overlap
            row.write.mode("append").parquet(f"{self.root}/{COMMITS}")
            if self._versions is None:
                self.refresh()
            else:
                self._versions[table] = (version, schema)

    # ---------------------------------------------------------------- writes
    def write(self, df: DataFrame, table: str, mode: str = "overwrite",
              stamps: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
              gather: bool = True, expected_rows: int | None = None) -> str:
        """:meth:`write_counted`, for the path of the version written."""
        self.write_counted(df, table, mode, stamps, partition_by, gather, expected_rows)
        return self.current(table)

    def write_counted(self, df: DataFrame, table: str, mode: str = "overwrite",
                      stamps: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
                      gather: bool = True, expected_rows: int | None = None) -> int:
        """Write ``df`` as a new version (overwrite) or into the current one (append); the rows written.

        ``partition_by`` lays the files out by those columns (Hive-style);
        ``gather`` first shuffles each value's rows together. A new version
        with other than ``expected_rows`` rows is not committed.

        ``stamps`` names audit columns set to ``current_timestamp()`` at write
        time (D15), so query results stay free of wall-clock values.
        """
        if partition_by and gather:
            # One shuffle by the layout columns so each task writes few
            # partition directories; AQE sizes the partitions and splits a
            # skewed (hot) value instead of giving it to one task. Hashes go
            # as the bytes that they spell, half their length.
            hashes = [c for c in HASHES if dict(df.dtypes).get(c) == "string"]
            df = df.withColumns({c: hash_bytes(c) for c in hashes}).hint("rebalance", *partition_by)
            df = df.withColumns({c: hash_text(c) for c in hashes})
        for name in stamps:
            df = df.withColumn(name, F.current_timestamp())
        # the writing stage counts its rows: each of its tasks once, however often it is tried
        counted = Observation()
        fields = df.schema.fields
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        current = self.current(table) if mode == "append" else None
        with shuffles_released(self.spark):
            return self._written(df, table, current, partition_by, expected_rows, counted, fields)

    def _written(self, df: DataFrame, table: str, current: str | None, partition_by: tuple[str, ...],
                 expected_rows: int | None, counted: Observation, fields: list[T.StructField]) -> int:
        if current is not None:
            w = df.write.mode("append").option("compression", CODEC)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(current)
            return counted.get.get("rows", 0)   # an empty plan observes nothing
        version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{version}"
        w = df.write.mode("errorifexists").option("compression", CODEC)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        schema = T.StructType([f for f in fields if f.name not in partition_by] + [f for f in fields if f.name in partition_by])
        rows = counted.get.get("rows", 0)
        if expected_rows is not None and rows != expected_rows:
            raise RowCountError(f"{table}: {rows} of the batch's {expected_rows} rows were written; the version is not committed")
        self._commit(table, version, schema.json())
        return rows

    def append_row(self, table: str, row: dict, schema: str) -> None:
        """Append one log row."""
        self.write(one_row(self.spark, row, schema), table, mode="append")
