"""Working tables in the shared folder: where a run cuts its lineage, and where Spark learns a frame's true size."""

from __future__ import annotations

import contextlib
import datetime as dt
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import shared_dir

#: Parquet codec of the working and layer tables; hashes, half of a row, take half the bytes of the default's.
CODEC = "zstd"

#: Whether a query's shuffle files go as it ends; else they stay until the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scopes: list[list[str]] = []
_releasing: dict[SparkSession, list] = {}
_lock = threading.Lock()


def one_row(spark: SparkSession, row: dict, schema: str) -> DataFrame:
    """A frame of one row, made by the JVM in one task; ``schema`` lists names and simple types. Times are in the session's zone."""
    out = []
    for field in schema.split(","):
        name, kind = field.split()
        value = row.get(name.strip("`"))
        out.append(F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value).cast(kind).alias(name.strip("`")))
    return spark.range(0, 1, 1, 1).select(*out)


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile delete their shuffle files as they end. Scopes may nest and overlap; the session's setting comes back after the last."""
    with _lock:
        held = _releasing.setdefault(spark, [0, None])
        held[0] += 1
        if held[0] == 1:
            held[1] = spark.conf.get(RELEASE, None)
            spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if held[0] == 0:
                del _releasing[spark]
                spark.conf.unset(RELEASE) if held[1] is None else spark.conf.set(RELEASE, held[1])


def working(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    A retried task rereads the files, a plan that uses the frame twice does
    not compute it twice, and joins see its size. The table's name is its own,
    so runs do not meet. :func:`working_tables` deletes it.
    """
    path = f"{shared_dir(df.sparkSession)}/working/{name}-{uuid.uuid4().hex}"
    with _lock:
        for scope in _scopes:
            scope.append(path)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the working tables written meanwhile, and shuffle files as their queries end; frames that read the tables end with the scope."""
    mine: list[str] = []
    with _lock:
        _scopes.append(mine)
    try:
        with shuffles_released(spark):
            yield
    finally:
        with _lock:
            # by identity: an equal list may belong to another run
            _scopes[:] = [s for s in _scopes if s is not mine]
        for path in mine:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the run's own."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
