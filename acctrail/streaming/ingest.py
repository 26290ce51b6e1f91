"""The typed history load as a Structured Streaming file ingest.

New CSV files landing in ``source_dir`` are parsed with the fixed schema;
each micro-batch is split into good rows and rejects (as the bulk load and
its error report do) and written to ``batch=<id>`` folders with overwrite, so
a micro-batch replayed after a failure rewrites the same folder: together with
the stream's checkpoint this makes the ingest exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from ..sources.files import CORRUPT, HISTORY_SCHEMA, split_rejects


def load_history_stream(spark: SparkSession, source_dir: str, table_dir: str, rejects_dir: str, *,
                        schema: T.StructType = HISTORY_SCHEMA, checkpoint_dir: str | None = None,
                        max_files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Start the ingest; returns the running query (``awaitTermination()`` for a backfill).

    ``available_now`` processes what is there in bounded micro-batches and
    stops; otherwise the query keeps watching ``source_dir``.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(full).option("header", True).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", CORRUPT).option("dateFormat", "yyyy-MM-dd")
                   .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_rejects(batch)
        good.write.mode("overwrite").parquet(f"{table_dir}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch_id}")

    ckpt = checkpoint_dir or shared_dir(spark, "acctrail", "streams", "history_load")
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
