"""Nearest earlier row of the same key that satisfies a predicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import _null_safe_key, in_ranges


def nearest_previous(df: DataFrame, *, key: str, order: Sequence[str], pred: Column, cols: Sequence[str],
                     max_back: int, name: str = "nearest", ranges: int | None = None) -> DataFrame:
    """Each row of ``df`` with ``name``: ``cols`` of the nearest earlier row that satisfies ``pred``.

    Earlier means before it among the rows of the same key in ``order`` (ascending, NULLs first; rows equal in it
    by a hash of all columns), and at most ``max_back`` rows back; the struct's last field ``back`` tells how many.
    NULL where there is none; a NULL predicate does not hold; rows of a NULL key form one group, as in SQL.
    Columns of ``df`` keep their values whatever their names.

    One ``last(..., ignorenulls)`` over a frame of ``max_back`` rows per (key, range of :func:`in_ranges`). Only the
    matching row crosses a bound between ranges: each range that continues a key gets the nearest match among the
    ``max_back`` rows before it, with its distance from the bound (the *halo*).
    """
    if max_back < 1:
        raise ValueError("max_back must be 1 or more")
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"), F.col(key).alias("_key"),
                      *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.xxhash64(*df.columns).alias("_tie"), F.when(pred, F.struct(*cols)).alias("_hit"))
    given, keys = _null_safe_key(given, "_key")
    by = [*(f"_o{i}" for i in range(len(order))), "_tie"]
    rows = in_ranges(given.drop("_key"), [*keys, *by], ranges)
    block = [*keys, "_part"]
    within = Window.partitionBy(*block).orderBy(*by)
    back = within.rowsBetween(-max_back, -1)
    rows = rows.withColumn("_pos", F.row_number().over(within))
    found = rows.withColumn("_own", F.last(F.when(F.col("_hit").isNotNull(), F.struct("_hit", "_pos")), True).over(back))

    # a bound between two ranges is crossed by one key at most, so both broadcasts have
    # fewer rows than there are ranges
    spans = (rows.groupBy(*keys).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
                 .filter(F.col("_first") < F.col("_last")).select(*keys))
    last_first = Window.partitionBy(*block).orderBy(*[F.col(c).desc() for c in by])
    tails = (rows.join(F.broadcast(spans), keys, "left_semi")
                 .select(*block, *by, "_hit", F.row_number().over(last_first).alias("_end"))
                 .filter(F.col("_end") <= max_back))
    along = Window.partitionBy(*keys).orderBy("_part", *by)
    halo = (tails.withColumn("_at", F.row_number().over(along))
            .select(*block, "_at", F.lag("_part").over(along).alias("_before"),
                    F.last(F.when(F.col("_hit").isNotNull(), F.struct("_hit", "_at")), True)
                    .over(along.rowsBetween(-max_back, -1)).alias("_far"))
            .filter((F.col("_before") < F.col("_part")) & F.col("_far").isNotNull())
            .select(*block, F.col("_far._hit").alias("_far"), (F.col("_at") - F.col("_far._at")).alias("_dist")))

    def match(hit: str, distance: Column) -> Column:
        return F.struct(*[F.col(hit)[c].alias(c) for c in cols], distance.cast("int").alias("back"))

    away = F.col("_pos") - 1 + F.col("_dist")
    return found.join(F.broadcast(halo), block, "left").select(
        "_all.*", F.when(F.col("_own").isNotNull(), match("_own._hit", F.col("_pos") - F.col("_own._pos")))
        .when(away <= max_back, match("_far", away)).alias(name))
