"""Per-person ordered history without a per-person group of raw rows.

A single person (or the NULL person) may own a large share of all rows, and a
single day of one person may too (a bulk migration day). No window here is
partitioned by the person alone over raw rows. :func:`in_ranges` deals the rows
out by their full order (person, time, id) into ranges of about equal row counts
and writes them with the number of their range, ``_part``:

* the range bounds are quantiles of the rows themselves, so a person or a day
  with many rows spans as many ranges as its share of the rows asks for, at
  every size and for every orderable type;
* every row-level window is partitioned by (person, [day,] ``_part``), so it
  never holds more than one range;
* person-level windows run only over one row per (person, day, range) (a day
  histogram) or over the last ``n`` rows of the ranges of a person that spans
  several; both are bounded per person by the numbers of calendar days and
  ranges, not by the number of rows.

The written copy makes ``_part`` the same for every reader and after a lost
executor. Calling an operator therefore runs the job that writes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import HORIZON_MONTHS, Products, count_col
from ..session import written

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


def _is(product: str, code: str) -> Column:
    return F.when(F.col(product) == F.lit(code), F.lit(1)).otherwise(F.lit(0))


def in_ranges(rows: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``rows`` plus ``_part``, the number of their range in ``order`` (NULLs first).

    Ranges are contiguous and ascending, rows equal in all of ``order`` share one.
    There are ``ranges`` of them, by default at most ``spark.sql.shuffle.partitions``.
    The result is written under the shared working folder and read back.
    """
    cut = rows.repartitionByRange(*([ranges] if ranges else []), *order)
    return written(cut.withColumn("_part", F.spark_partition_id()), "ranges")


def product_history_counts(history: DataFrame, *, person: str = "person", id_col: str = "id",
                           day: str = "created", product: str = "product_type",
                           products: Products = Products(), as_of=None,
                           horizons: Sequence[int] = HORIZON_MONTHS,
                           include: Sequence[str] = ("orig", "months", "today"),
                           ranges: int | None = None) -> DataFrame:
    """Counts of each person's accounts around every account.

    * ``orig``: accounts strictly before this one in (day, id) order, per known
      product; the total sums the four known products only.
    * ``{n}month``: accounts dated before ``add_months(day, n)`` (strict),
      including this one and all earlier ones; the total counts any product.
    * ``today``: accounts dated before ``as_of``; same value on each of the
      person's rows. Requires ``as_of``.
    Rows with a NULL person get 0 everywhere. A row with a NULL day has no place
    in the order and is never dated before anything: no other row counts it,
    and its own ``orig`` and month counts are 0; its ``today`` counts are the
    person's. Output: every input row with its columns + counts (BIGINT),
    named ``cnt_<tot|pcl|pl|dep|hm>_post_accts1_<suffix>``.
    """
    cats = products.items()
    keys = [k for k, _ in cats]
    suffixes = []
    if "orig" in include:
        suffixes.append("orig")
    if "months" in include:
        suffixes += [f"{n}month" for n in horizons]
    if "today" in include:
        if as_of is None:
            raise ValueError("as_of is required for the 'today' counts")
        suffixes.append("today")
    out_cols = [count_col(c, s) for s in suffixes for c in ["tot"] + keys]

    base_cols = history.columns
    # Rows without a person stay in the same flow: NULL is an ordinary group key
    # for the windows and the histogram, so those rows are dealt out by day and id
    # like any other person's; their counts are forced to 0 at the end.
    valid = in_ranges(history.filter(F.col(day).isNotNull()), [person, day, id_col], ranges)
    block = [person, day, "_part"]

    # 1. day histogram: one row per (person, day, range), map-side partial aggregation
    hist = valid.groupBy(*block).agg(
        F.count(F.lit(1)).alias("_n_tot"),
        *[F.sum(_is(product, code)).alias(f"_n_{k}") for k, code in cats])

    # 2. person-level windows over the histogram (size per person <= days + ranges);
    # the month frames are by day, so they take all ranges of a day together
    spec = f"PARTITION BY `{person}` ORDER BY `{day}`"
    feats = [F.col(c) for c in block]
    wd = Window.partitionBy(person).orderBy(day, "_part")
    if "orig" in suffixes:
        for k in keys:
            feats.append(F.coalesce(F.sum(f"_n_{k}").over(wd.rowsBetween(_UNB, -1)),
                                    F.lit(0)).alias(f"_before_{k}"))
    for n in horizons if any(s.endswith("month") for s in suffixes) else ():
        for k in ["tot"] + keys:
            upto = F.expr(f"sum(_n_{k}) OVER ({spec} RANGE BETWEEN UNBOUNDED PRECEDING "
                          f"AND INTERVAL {n} MONTHS FOLLOWING)")
            at = F.expr(f"sum(_n_{k}) OVER ({spec} RANGE BETWEEN INTERVAL {n} MONTHS FOLLOWING "
                        f"AND INTERVAL {n} MONTHS FOLLOWING)")
            feats.append((upto - F.coalesce(at, F.lit(0))).cast("long").alias(count_col(k, f"{n}month")))
    if "today" in suffixes:
        for k in ["tot"] + keys:
            feats.append(F.sum(F.when(F.col(day) < F.lit(as_of).cast("date"), F.col(f"_n_{k}"))
                               .otherwise(F.lit(0))).over(wd.rowsBetween(_UNB, _UNF))
                         .cast("long").alias(count_col(k, "today")))
    day_feats = hist.select(*feats)

    if "orig" in suffixes:
        # 3. earlier rows of the same day and range
        wb = Window.partitionBy(*block).orderBy(id_col).rowsBetween(_UNB, -1)
        rows = valid.select("*", *[F.count(F.when(F.col(product) == F.lit(code), F.lit(1)))
                                   .over(wb).alias(f"_same_{k}") for k, code in cats])
        joined = rows.join(day_feats, block, "left")
        per = [(F.col(f"_before_{k}") + F.col(f"_same_{k}")).cast("long") for k in keys]
        total = per[0]
        for p in per[1:]:
            total = total + p
        finals = [total.alias(count_col("tot", "orig"))] + [p.alias(count_col(k, "orig"))
                                                             for p, k in zip(per, keys)]
    else:
        joined = valid.join(day_feats, block, "left")
        finals = []
    finals += [F.col(c) for c in out_cols if not c.endswith("_orig")]
    no_person = F.col(person).isNull()
    counted = joined.select(*[F.col(c) for c in base_cols], *finals)

    # rows without a day: only the person's today counts apply to them
    undated = history.filter(F.col(day).isNull())
    if "today" in suffixes:
        today = hist.groupBy(person).agg(*[
            F.sum(F.when(F.col(day) < F.lit(as_of).cast("date"), F.col(f"_n_{k}")).otherwise(F.lit(0)))
            .alias(count_col(k, "today")) for k in ["tot"] + keys])
        undated = undated.join(today, person, "left")
    counted = counted.unionByName(undated.select(*base_cols, *[
        (F.coalesce(F.col(c), F.lit(0)) if c.endswith("_today") else F.lit(0)).cast("long").alias(c)
        for c in out_cols]))
    return counted.select(*base_cols, *[F.when(no_person, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c)
                                        for c in out_cols])


def _null_safe_key(df: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """Replace a nullable key by (value-or-default, is-null) so NULL keys form one
    group and all later joins stay plain equi-joins on the same columns."""
    dtype = df.schema[key].dataType.simpleString()
    default = F.lit("") if dtype == "string" else F.lit(0).cast(dtype)
    out = df.withColumn("_kv", F.coalesce(F.col(key), default)).withColumn("_kn", F.col(key).isNull())
    return out, ["_kv", "_kn"]


def previous_rows(df: DataFrame, *, key: str, ts: str, tie: str, cols: Sequence[str],
                  n: int = 5, prefix: str = "_prev", ranges: int | None = None) -> DataFrame:
    """Values of ``cols`` on the 1st..n-th earlier row of the same key.

    Order is (ts, tie) ascending, rows with a NULL ``ts`` before all others;
    rows of a NULL key form one group, as in SQL; rows equal in both are ordered
    by a hash of ``cols``. Every input row comes out. Adds struct columns
    ``{prefix}1`` .. ``{prefix}{n}`` (NULL where fewer earlier rows exist).
    Blocks are (key, range of :func:`in_ranges`): lags inside a block come from a
    block window; the first rows of a block that continues a key take their
    predecessors from the *halo*, the last ``n`` rows before the block, found by a
    per-key window over the block tails of the keys that span several ranges.
    """
    d, kcols = _null_safe_key(df, key)
    order = [ts, tie, "_tie_hash"]
    rows = in_ranges(d.withColumn("_tie_hash", F.xxhash64(*cols)), kcols + order, ranges)
    rows = rows.withColumn("_row", F.struct(*cols))
    part = kcols + ["_part"]
    wb = Window.partitionBy(*part).orderBy(*order)
    d = rows.select("*", F.row_number().over(wb).alias("_pos"),
                    *[F.lag("_row", i).over(wb).alias(f"_l{i}") for i in range(1, n + 1)])

    # ranges are contiguous in the key, so each bound between two of them is crossed
    # by at most one key: ``spans`` and ``halo`` have fewer rows than there are
    # ranges, whatever the data, which is the size bound of their broadcasts
    spans = (rows.groupBy(*kcols).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
                 .filter(F.col("_first") < F.col("_last")).select(*kcols))
    back = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    tails = (rows.join(F.broadcast(spans), kcols, "left_semi")
                 .select(*part, *order, "_row", F.row_number().over(back).alias("_back"))
                 .filter(F.col("_back") <= F.lit(n)))
    wt = Window.partitionBy(*kcols).orderBy("_part", *order)
    halo = (tails.select(*part, F.lag("_part").over(wt).alias("_before"),
                         *[F.lag("_row", i).over(wt).alias(f"_h{i}") for i in range(1, n + 1)])
            .filter(F.col("_before") < F.col("_part")).drop("_before"))

    j = d.join(F.broadcast(halo), part, "left")
    prevs = []
    for i in range(1, n + 1):
        c = F.when(F.col("_pos") > F.lit(i), F.col(f"_l{i}"))
        for p in range(i, 0, -1):  # position p takes the (i - p + 1)-th halo row
            c = c.when(F.col("_pos") == F.lit(p), F.col(f"_h{i - p + 1}"))
        prevs.append(c.alias(f"{prefix}{i}"))
    return j.select(*df.columns, *prevs)


def horizon_counts_merge(history: DataFrame, *, person: str = "person", day: str = "created",
                         product: str = "product_type", products: Products = Products(),
                         horizons: Sequence[int] = HORIZON_MONTHS,
                         ranges: int | None = None) -> DataFrame:
    """W6 as a range join computed by merging, not by pairing rows.

    For each account: the person's accounts dated before ``add_months(day, n)``.
    Probe rows (one per person, day, range and horizon, keyed at the bound) are
    merged with the person's day histogram in key order, probes ahead of data on
    equal keys; a running sum read at each probe is the strict count. Both
    sides have one row per (person, day, range of :func:`in_ranges`), so the
    per-person merge is bounded by the numbers of days and ranges. Rows with a NULL person or a NULL day get 0 (no bound
    to be dated before), and no other row counts a NULL day.
    """
    cats = ["tot"] + [k for k, _ in products.items()]
    placed = F.col(person).isNotNull() & F.col(day).isNotNull()
    valid = in_ranges(history.filter(placed).withColumn("_tie_hash", F.xxhash64(*history.columns)),
                      [person, day, "_tie_hash"], ranges)
    hist = valid.groupBy(person, day, "_part").agg(
        F.count(F.lit(1)).alias("_n_tot"),
        *[F.sum(_is(product, code)).alias(f"_n_{k}") for k, code in products.items()])
    data = hist.select(person, "_part", F.col(day).alias("_key"), F.lit(1).alias("_is_data"),
                       F.lit(None).cast("date").alias("_probe_day"), F.lit(None).cast("int").alias("_h"),
                       *[F.col(f"_n_{k}") for k in cats])
    probes = [hist.select(person, "_part", F.add_months(F.col(day), n).alias("_key"), F.lit(0).alias("_is_data"),
                          F.col(day).alias("_probe_day"), F.lit(n).alias("_h"),
                          *[F.lit(0).cast("long").alias(f"_n_{k}") for k in cats])
              for n in horizons]
    merged = data
    for p in probes:
        merged = merged.unionByName(p)
    w = Window.partitionBy(person).orderBy("_key", "_is_data").rowsBetween(_UNB, 0)
    running = merged.select(person, "_part", "_probe_day", "_h", "_is_data",
                            *[F.sum(f"_n_{k}").over(w).alias(f"_c_{k}") for k in cats])
    at_probe = running.filter(F.col("_is_data") == 0)
    wide = at_probe.groupBy(person, "_probe_day", "_part").pivot("_h", list(horizons)).agg(
        *[F.first(f"_c_{k}").alias(k) for k in cats])
    renamed = wide.select(F.col(person), F.col("_probe_day").alias(day), "_part",
                          *[F.col(f"{n}_{k}").cast("long").alias(count_col(k, f"{n}month"))
                            for n in horizons for k in cats])
    out_cols = [count_col(k, f"{n}month") for n in horizons for k in cats]
    counted = valid.join(renamed, [person, day, "_part"], "inner").select(*history.columns, *out_cols)
    zeros = history.filter(~placed).select(
        *history.columns, *[F.lit(0).cast("long").alias(c) for c in out_cols])
    return counted.unionByName(zeros)
