"""Outer and anti joins whose NULL keys do not pile up in one task.

A left row whose key is NULL can never match, yet a plain equi-join still
hashes every such row to the single partition that NULL maps to; when NULL
is a common key value (no borrower, no offer, no prior loan) that partition
holds a large share of the input. Here the join runs on two columns,
(key-or-salt, key-is-NULL): NULL-keyed rows are spread by ``salt`` (a
deterministic row id, so a retried task rebuilds the same partitioning) and
still match nothing, because the right side's flag is always false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
            salt: str) -> tuple[DataFrame, DataFrame, Column]:
    ktype = left.schema[left_key].dataType
    lk = F.col(left_key)
    lhs = (left.withColumn("_jk", F.coalesce(lk, F.col(salt).cast(ktype)))
               .withColumn("_jn", lk.isNull()))
    rhs = (right.withColumn("_rk", F.col(right_key).cast(ktype))
                .withColumn("_rn", F.lit(False)))
    cond = (F.col("_jk") == F.col("_rk")) & (F.col("_jn") == F.col("_rn"))
    return lhs, rhs, cond


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salt: str,
              extra: Column | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key [AND extra]``, NULL keys spread."""
    lhs, rhs, cond = _spread(left, right, left_key, right_key, salt)
    if extra is not None:
        cond = cond & extra
    return lhs.join(rhs, cond, "left").drop("_jk", "_jn", "_rk", "_rn")


def left_anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   salt: str) -> DataFrame:
    """Left rows with no match (NULL keys never match and are kept), NULL keys spread."""
    lhs, rhs, cond = _spread(left, right, left_key, right_key, salt)
    return lhs.join(rhs, cond, "left_anti").drop("_jk", "_jn")


def keep_keys(df: DataFrame, column: str, keys: DataFrame | None) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among the values of the one-column frame ``keys``; all without ``keys``.

    Values may repeat in ``keys``; NULLs are not kept. Spark broadcasts the keys where their size
    (measured, for a written table) is under its threshold and shuffles both sides otherwise.
    """
    if keys is None:
        return df
    return df.join(keys.toDF("_kept"), F.col(column) == F.col("_kept"), "left_semi")
