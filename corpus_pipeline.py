"""A corpus pipeline over ``documents``: five stages, each one operator of acctrail.llm.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and hands it, read again, to the next. All but the last return the columns of
documents. Null texts are kept by the filters; null doc_ids and repeated
rows are defined in the operators' docstrings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrail.llm.bpe import round_trip
from acctrail.llm.common import stored, table, unused
from acctrail.llm.decontaminate import drop_contaminated
from acctrail.llm.jaccard_join import drop_near_duplicates
from acctrail.llm.pii import masked_column, train_pii
from acctrail.llm.queries import rank_file
from acctrail.llm.toxicity import toxicity_column, train_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is 0.7 or more.

    Null and empty texts score as no evidence and stay; repeated rows and null doc_ids are
    judged row by row; all columns are kept. Empty tables give an empty table.
    """
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_column(F.col("text"), model) < 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by 5-word shingle Jaccard similarity of 0.8 or more.

    The smallest doc_id stays, a null one only without another; texts without words stay, of
    rows equal in doc_id and text one does; all columns are kept.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage within a fifth of a benchmark item's words in edits.

    Null and empty texts and items hold and match nothing; repeated rows and null doc_ids are
    judged row by row; all columns are kept.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars (where there is one) follows where the text changed.

    Null texts stay null; every row stays, repeated rows and null doc_ids too; all columns are kept.
    """
    columns, masked = docs.columns, unused(docs, "_masked")
    changed = docs.withColumn(masked, masked_column(F.col("text"), train_pii(docs)))
    if "n_chars" in columns:
        size = F.when(F.col(masked) == F.col("text"), F.col("n_chars")).otherwise(
            F.coalesce(F.length(masked).cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
        changed = changed.withColumn("n_chars", size)
    return changed.withColumn("text", F.col(masked)).select(*columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens and the digests of ids and decoded bytes."""
    # the earlier stages leave less of an executor's memory to the workers than the operator has alone
    return round_trip(docs, *rank_file(), sql_rows=150_000, cache_bytes=64 << 20)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("token_ids", token_ids)]

#: SQL cannot express the learned stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
