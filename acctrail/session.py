"""Session construction and the shared working folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from real shuffle sizes
# (runtime broadcast only below the threshold, skew-join splitting of hot
# partitions); the UI is off because no job may open a web port.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "acctrail", extra: dict | None = None) -> SparkSession:
    """A session with BASE_CONF; master and partition count only where the caller names
    them, so that spark-submit's settings hold on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Without one
    this is an error, in local mode too: a machine-local folder would not be
    visible to other executors.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing, sub-folder of :func:`shared_dir` for one write."""
    token = os.urandom(6).hex()
    return shared_dir(spark, "acctrail", f"{name}-{token}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
