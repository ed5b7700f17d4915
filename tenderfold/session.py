"""Session helpers.

Settings are only filled in where the session leaves them unset, so a cluster's
own configuration (shuffle partitions, checkpoint folder, AQE) always wins.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this library creates itself (tests, bench, local runs).
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tenderfold", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (``spark.checkpoint.dir``) and hand it to the session.

    On a cluster the setting names a folder that every executor reaches; it is
    never replaced, and a cluster session without it fails here with a clear
    message. Only a single-process session (master ``local[..]``: tests, bench)
    may go without: it gets a folder of its own under the SQL warehouse.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not current:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        current = f"{warehouse}/_checkpoints/{sc.applicationId}"
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut, and unused columns are not read."""
    path = shared_path(df.sparkSession, name.lstrip("_"))       # a leading underscore hides files from Spark's reader
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_A_TASK = 100_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` partitioned by ``keys`` into tasks of about ``ROWS_A_TASK`` rows (at least the session's shuffle partitions).

    Sorts and hash tables of a task stay at that size however large the table
    is; the number of partitions grows instead. Frames of the same ``rows`` and
    keys join without another exchange.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // ROWS_A_TASK)), *keys)
