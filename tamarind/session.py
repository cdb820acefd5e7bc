"""Session set-up and the one place that decides where lineage is cut."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

#: SQL options the reports rely on. All of them can be set on a running session.
SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: let a skewed shuffle partition be split even when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that hold whole blocks of vectors are large; batches for Python are bounded by bytes, not by rows only.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}


def build_session(app_name: str = "tamarind", master: str | None = None, **options: str) -> SparkSession:
    """A session with the options above. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_options(spark: SparkSession) -> SparkSession:
    """Set the SQL options on a session that somebody else created."""
    for key, value in SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for frozen tables: ``spark.checkpoint.dir`` of the session.

    Without the setting the warehouse of the session is used. On a cluster that has to lie on a file system that all
    machines share, so a local path is an error there. The session's settings are left as they are.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if on_one_machine(warehouse) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{warehouse} is a folder of one machine: set spark.checkpoint.dir to one that all executors reach")
    return warehouse.rstrip("/") + "/_frozen"


def on_one_machine(path: str) -> bool:
    """Whether a path names the file system of the machine it is read on. Spark writes that scheme out in its warehouse."""
    return urlsplit(path).scheme == "file"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    The returned frame no longer depends on the plan of ``df``, so values that a re-run could change (range boundaries,
    row positions) stay fixed when an executor is lost, and later steps still get column pruning and file statistics.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
