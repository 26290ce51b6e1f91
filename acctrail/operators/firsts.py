"""First row per key (W1) and latest-k per key with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .heavy import spread_join, unused


def first_per_key(df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: the row with the smallest ``order`` tuple.

    Order values that are NULL sort last; the last order column should be a
    unique id so the pick is deterministic. Expressed as ``min(struct)`` per
    key, an aggregate Spark combines map-side, so a key holding a large share
    of the rows is reduced to one row per task before the shuffle.
    Output: key, the order columns, the payload columns.
    """
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
    fields += [F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]
    picked = (df.filter(F.col(key).isNotNull())
                .groupBy(key).agg(F.min(F.struct(*fields)).alias("_first")))
    return picked.select(key,
                         *[F.col(f"_first.o{i}").alias(c) for i, c in enumerate(order)],
                         *[F.col(f"_first.p{i}").alias(c) for i, c in enumerate(payload)])


def latest_k(df: DataFrame, key: str, order: str, k: int, rank_col: str = "bills") -> DataFrame:
    """Rows whose rank by ``order`` descending (NULLs first, ties share a rank) is <= k.

    The rank is counted, not taken over raw rows: a value's rank is 1 + the rows of the greater values of its key.
    Rows are counted per (key, value); the k greatest values of a key hold its ranks up to k (a partial
    WindowGroupLimit before the shuffle); and the kept values are joined back to the rows with heavy (key, value)
    groups dealt out. Ties of one key therefore never meet in one task. NULL keys form one group.
    """
    value, rows = unused("_value", df), unused("_rows", df)
    counts = df.groupBy(key, order).agg(F.count(F.lit(1)).alias(rows))
    newest = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_first())
    kept = counts.withColumn(value, F.row_number().over(newest)).filter(F.col(value) <= k).drop(value)
    before = F.sum(rows).over(newest.rowsBetween(Window.unboundedPreceding, -1))
    ranked = kept.withColumn(rank_col, (F.lit(1) + F.coalesce(before, F.lit(0))).cast("int"))
    return spread_join(df, ranked.filter(F.col(rank_col) <= k).drop(rows), [key, order], "inner", nulls=True)
