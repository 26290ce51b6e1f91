"""Table access and shared storage used by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    Executors and driver both see it. A session without one gets an error: a
    machine-local folder would hide the files from the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This runs a job. It cuts the lineage, so that a lost executor costs a
    re-read, and lets several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{os.urandom(8).hex()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(run):
    """``run`` of batches; at its end the worker, which lives on for other tasks, returns memory that it no longer uses."""
    def released(batches):
        import pyarrow as pa
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)
    return released


@contextlib.contextmanager
def rows_a_batch(spark: SparkSession, rows: int):
    """Python workers get at most ``rows`` rows at a time in the jobs that run inside; the setting is put back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def hash_sample(df: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among the ``rows`` keys with the smallest hash, stored.

    At most ``rows`` keys are broadcast; null keys are never drawn.
    """
    keys = (df.select(key).where(F.col(key).isNotNull()).distinct()
            .orderBy(F.xxhash64(key), key).limit(rows))
    return stored(df.join(F.broadcast(stored(keys, f"{name}-keys")), key).dropDuplicates([key]), name)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes not to be a column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
