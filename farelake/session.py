"""Session construction and the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "farelake", driver_memory: str = "8g", **conf) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, for working tables.

    Only a local session (tests, benchmarks), whose tasks all run on this
    machine, gets a folder of its own when the setting is unset.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="farelake-")
    return _LOCAL_DIRS[sc.applicationId]
