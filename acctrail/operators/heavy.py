"""Equi-joins to a side with one row per key, where a key may hold a large share of the left rows.

The heavy keys are found from the data: those with more than ``1 / most`` of the left
rows, so there are fewer than ``most`` of them, which is the size bound of their broadcast. The left rows
of a heavy key are dealt to as many pieces as its share asks for, by a hash of the row and its
input partition, and the one matching right row is copied to each piece. All other keys have one piece. This
does not rest on a runtime re-plan, so it also holds where a later operator reuses the
join's partitioning. Finding the heavy keys is one more pass over the key columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(stem: str, *frames: DataFrame) -> str:
    """A column name starting with ``stem`` that none of the frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def pieces_bound(df: DataFrame, most: int | None) -> int:
    """By default four times the shuffle partitions: a key under a quarter of a task's share is not heavy."""
    return min(most or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 200_000)


def heavy_keys(rows: DataFrame, keys: Sequence[str], most: int | None = None, nulls: bool = False) -> dict[int, int]:
    """Hash of each key with more than ``1 / most`` of ``rows``, and the number of pieces to deal it into.

    One pass over the key columns with a frequent-items sketch, combined map-side, that tracks 16 times as many
    keys as can be heavy, so that none is missed; its counts are estimates, which only the number of pieces
    depends on. NULL is a key only with ``nulls``.
    """
    most = pieces_bound(rows, most)
    if not nulls:
        rows = rows.dropna(subset=list(keys))
    found = rows.select(F.xxhash64(*keys).alias("key")).agg(
        F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(key, {most}, {min(16 * most, 1_000_000)})").alias("top")).first()
    return {r.item: math.ceil(r["count"] * most / found.total) for r in found.top if r["count"] * most > found.total}


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                most: int | None = None, nulls: bool = False) -> DataFrame:
    """``left`` joined to ``right`` (one row per key) on the columns ``keys`` of both, heavy keys dealt out.

    ``how`` is ``left`` or ``inner``. NULL keys match nothing and are spread over all tasks; with ``nulls`` they are
    keys like others. Output: the left columns, then the right ones without the keys.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    most = pieces_bound(left, most)
    spark = left.sparkSession
    key, pieces, place = (unused(c, left, right) for c in ("_key", "_pieces", "_place"))
    names = [unused(f"_key{i}", left, right) for i in range(len(keys))]
    heavy = spark.createDataFrame(list(heavy_keys(left, keys, most, nulls).items()), f"{key} long, {pieces} int")

    def dealt(df: DataFrame) -> DataFrame:
        # equal hashes of different keys only give a key more pieces than it needs, on both sides alike
        hashed = df.withColumn(key, F.xxhash64(*[F.col(k).cast(left.schema[k].dataType) for k in keys]))
        return hashed.join(F.broadcast(heavy), key, "left").withColumn(pieces, F.coalesce(F.col(pieces), F.lit(1)))

    parts = F.col(pieces)
    if not nulls:
        parts = F.when(reduce(or_, (F.col(k).isNull() for k in keys)), F.lit(most)).otherwise(parts)
    row = F.xxhash64(*left.columns, F.spark_partition_id())
    lhs = dealt(left).withColumn(place, F.pmod(row, parts).cast("int")).select(*left.columns, place)
    carried = [c for c in right.columns if c not in keys]
    rhs = (dealt(right if nulls else right.dropna(subset=list(keys)))
           .withColumn(place + "r", F.explode(F.sequence(F.lit(0), F.col(pieces) - 1)))
           .select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *carried, place + "r"))
    same = Column.eqNullSafe if nulls else Column.__eq__
    on = reduce(and_, (same(F.col(k), F.col(n)) for k, n in zip(keys, names, strict=True)))
    return lhs.join(rhs, on & (F.col(place) == F.col(place + "r")), how).select(*left.columns, *carried)
