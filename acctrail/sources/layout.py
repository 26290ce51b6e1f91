"""Written layouts that later reads profit from: folders by day, buckets by key."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir


def by_day(df: DataFrame, day: str, path: str | None = None) -> DataFrame:
    """``df`` written with one folder per value of ``day`` and read back, columns in the old order.

    A filter on ``day`` reads the folders of its days only (``PartitionFilters``), and so does a join with a
    small table of days (dynamic pruning). The rows are dealt out by day first, so a day has few files; the
    ``rebalance`` hint lets Spark cut a heavy day into several tasks (with the days that
    hash to the same partition) and put small days together. Rows without
    a day get a folder of their own. ``path`` is a new folder, by default in the shared one.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, "by-day")
    df.hint("rebalance", F.col(day)).write.partitionBy(day).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` written in ``buckets`` sorted buckets of ``key`` in the shared folder, and read as a table.

    Joins and groupings on ``key`` between tables of equal bucket numbers need no shuffle. One shuffle writes
    them, with one file a bucket. For tables of one or few rows per key: a key's rows share a bucket, and no later
    stage can split it. The catalog name is ``name`` with a random ending, so writing again never replaces a table in use.
    """
    spark = df.sparkSession
    table = f"{name}_{os.urandom(6).hex()}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", fresh_dir(spark, name)).saveAsTable(table))
    return spark.table(table)
