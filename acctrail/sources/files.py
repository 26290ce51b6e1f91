"""CSV reads and writes, the typed history load with rejects, merges, CTAS.

Paths are folders on storage every executor can reach; writes are whole
Spark jobs (one file per task), never a single-process file.
"""

from __future__ import annotations

import os
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codes import count_cols

CORRUPT = "_corrupt_record"

# one schema end to end: the 25 counts are integers, not the legacy floats
HISTORY_SCHEMA = T.StructType(
    [T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
     T.StructField("product_type", T.StringType()), T.StructField("created", T.DateType())]
    + [T.StructField(c, T.LongType()) for c in count_cols()])


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *,
             header: bool = True) -> DataFrame:
    """CSV with a header line, typed by ``schema`` (never inferred)."""
    return spark.read.schema(schema).option("header", header).csv(paths)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> str:
    """CSV folder with a header per file; ISO dates."""
    df.write.mode(mode).option("header", header).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def load_typed_csv(spark: SparkSession, paths: str | Sequence[str],
                   schema: T.StructType = HISTORY_SCHEMA, *, header: bool = True) -> DataFrame:
    """S3: typed bulk load (skip one header line). Lines that do not fit the
    schema (bad number, bad date, wrong field count) keep their raw text in
    ``_corrupt_record``; use :func:`split_rejects` to separate them."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", CORRUPT).option("dateFormat", "yyyy-MM-dd")
                 .csv(paths))


def split_rejects(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reject column, rejected lines).

    Rejects carry the raw line and every field as far as it parsed (NULL
    where it did not). Both sides reference all fields, so the CSV reader
    parses every field even with column pruning on, and a bad value in any
    column is caught; no cache of the input is needed.
    """
    fields = [c for c in loaded.columns if c != CORRUPT]
    good = loaded.filter(F.col(CORRUPT).isNull()).select(*fields)
    bad = loaded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_line"), *fields)
    return good, bad


def reject_report(spark: SparkSession, paths, schema: T.StructType = HISTORY_SCHEMA, *, header: bool = True) -> DataFrame:
    """Rejected lines with their file, the file's modification time, the line and the reason; newest file first.

    The reason names the fields that hold text but did not parse, or says that the number of fields is wrong.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    loaded = load_typed_csv(spark, paths, schema, header=header).select(*full.fieldNames(), "_metadata")
    given = F.from_csv(F.col(CORRUPT), ", ".join(f"f{i} string" for i in range(len(schema.fields))))
    unparsed = F.array_compact(F.array(*(
        F.when(F.col(f.name).isNull() & given[f"f{i}"].isNotNull(), F.lit(f.name)) for i, f in enumerate(schema.fields))))
    reason = (F.when(F.size(unparsed) > 0, F.concat(F.lit("not parsed: "), F.array_join(unparsed, ", ")))
              .otherwise(F.lit(f"not {len(schema.fields)} fields")))
    return (loaded.where(F.col(CORRUPT).isNotNull())
            .select(F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file"),
                    F.col(CORRUPT).alias("raw_line"), reason.alias("reason"))
            .orderBy(F.col("file_time").desc(), "file", "raw_line"))


def write_history_csv(df: DataFrame, path: str, schema: T.StructType = HISTORY_SCHEMA) -> str:
    """The history table as CSV, columns in ``schema`` order (CSV binds by position)."""
    return write_csv(df.select(*schema.fieldNames()), path)


def merge_outputs(spark: SparkSession, paths: Sequence[str], schema: T.StructType, *,
                  fmt: str = "csv") -> DataFrame:
    """Many result folders as one relation (one multi-path scan)."""
    if fmt == "csv":
        return read_csv(spark, list(paths), schema)
    return spark.read.schema(schema).parquet(*paths)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def log_rejects(spark: SparkSession, paths, log: str, load_id: str, schema: T.StructType = HISTORY_SCHEMA, *,
                header: bool = True) -> None:
    """Add the rejected lines of one load (see :func:`reject_report`) to the folder ``log``.

    A load's rejects are one sub-folder, so loading again under the same ``load_id`` replaces them.
    """
    reject_report(spark, paths, schema, header=header).write.mode("overwrite").parquet(f"{log}/load_id={load_id}")


def reject_log(spark: SparkSession, log: str) -> DataFrame:
    """The rejects of all loads: load_id, file_time, file, raw_line, reason; newest first."""
    return (spark.read.schema("file_time timestamp, file string, raw_line string, reason string, load_id string").parquet(log)
            .select("load_id", "file_time", "file", "raw_line", "reason")
            .orderBy(F.col("file_time").desc(), F.col("load_id").desc(), "file", "raw_line"))


def write_sorted(df: DataFrame, by: Sequence[Column | str], path: str, ranges: int | None = None) -> str:
    """O1/O2: ``df`` as Parquet in the order of ``by``: files numbered in the order, rows in order inside each.

    One range shuffle into ``ranges`` (by default as many as the size asks for); no task sorts more than its range.
    """
    df.repartitionByRange(*([ranges] if ranges else []), *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    """(file system, path object) of a folder on whatever storage holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _fresh() -> str:
    """Names that ascend with time and never meet."""
    return f"{time.time_ns():020d}-{os.urandom(4).hex()}"


def publish(df: DataFrame, target: str) -> str:
    """The new content of ``target``, for readers by :func:`current`; at no time is there none.

    The rows go to a fresh sub-folder, which counts from the moment its job has committed. A job that dies leaves
    the version before it in place. The last two versions are kept, so that running readers end.
    """
    spark = df.sparkSession
    path = f"{target}/{_fresh()}"
    df.write.parquet(path)
    fs, _ = _folder(spark, target)
    for old in versions(spark, target)[:-2]:
        fs.delete(_folder(spark, old)[1], True)
    return path


def versions(spark: SparkSession, target: str) -> list[str]:
    """The complete versions of a published folder, oldest first."""
    fs, at = _folder(spark, target)
    if not fs.exists(at):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())
    return [f"{target}/{n}" for n in names if fs.exists(_folder(spark, f"{target}/{n}/_SUCCESS")[1])]


def current(spark: SparkSession, target: str) -> DataFrame:
    """The last complete version of what :func:`publish` wrote to ``target``."""
    if not (found := versions(spark, target)):
        raise FileNotFoundError(f"nothing has been published to {target}")
    return spark.read.parquet(found[-1])


def materialize(df: DataFrame, target: str) -> str:
    """Create-table-as-select as an idempotent replace; a job that dies leaves the old table as it was.

    ``target`` is a folder when it holds a ``/``, else the name of a catalog table. A folder is written beside
    itself and swapped in by two renames (readers that must find a table at every moment use :func:`publish`). A
    table gets a fresh folder, to which the catalog then points; only a changed schema drops and creates it anew.
    """
    spark = df.sparkSession
    if "/" in target:
        staged, old = f"{target}.staged-{_fresh()}", f"{target}.replaced-{_fresh()}"
        df.write.parquet(staged)
        fs, at = _folder(spark, target)
        there = fs.exists(at)
        if there and not fs.rename(at, _folder(spark, old)[1]):
            raise OSError(f"cannot replace {target}")
        if not fs.rename(_folder(spark, staged)[1], at):
            if there:
                fs.rename(_folder(spark, old)[1], at)
            raise OSError(f"cannot replace {target}")
        if there:
            fs.delete(_folder(spark, old)[1], True)
        return target
    database, _, table = target.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = f"{home}/{table}-{_fresh()}"
    df.write.parquet(path)
    if spark.catalog.tableExists(target):
        if [(f.name, f.dataType) for f in spark.table(target).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{path}'")
            spark.catalog.refreshTable(target)
            return target
        spark.sql(f"DROP TABLE {target}")
    spark.catalog.createTable(target, path=path, source="parquet")
    return target
