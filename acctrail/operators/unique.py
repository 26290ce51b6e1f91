"""Lookup tables that must have one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .heavy import unused


def one_per_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` by rows with a key, where running it fails with ``name`` and the key if a key has several rows.

    Rows without a key are left out (they match nothing). Grouped by the key with map-side
    combine, so a much repeated key never fills a task; a join on the key reuses the partitioning
    and order of the grouping.
    """
    rows = unused("_rows", df)
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(rows), *[F.first(c).alias(c) for c in df.columns if c != key])
    several = F.concat(F.lit(f"{name} has more than one row for {key} "), F.col(key).cast("string"))
    return grouped.filter(F.assert_true(F.col(rows) == 1, several).isNull()).select(*df.columns)
