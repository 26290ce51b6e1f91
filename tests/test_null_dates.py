"""Rows with a NULL date or time: no row is lost, none is counted."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from acctrail.functions.exprs import local_date
from acctrail.operators.ordered import horizon_counts_merge, previous_rows, product_history_counts
from acctrail.session import shared_dir
from acctrail.sources.tables import load

CODES = {"PCL": "pcl", "PL": "pl", "DEP": "dep", "HM": "hm"}
AS_OF = dt.date(2020, 6, 1)


def add_months(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    last = (dt.date(y + m // 11, (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m + 1, min(d.day, last))


def history():
    rnd = random.Random(5)
    days = [None, *(dt.date(2020, 1, 1) + dt.timedelta(days=20 * i) for i in range(20))]
    return [(rnd.choice([None, "a", "b", "c"]), i, rnd.choice(days), rnd.choice([*CODES, "OTHER"])) for i in range(160)]


def brute(rows, row, keep):
    own = [o for o in rows if o[0] is not None and o[0] == row[0] and o[2] is not None and keep(o)]
    return [len(own), *(sum(o[3] == c for o in own) for c in CODES)]


@pytest.mark.parametrize("ids", ["long", "string"])
def test_counts(spark, ids):
    rows = [(p, i if ids == "long" else f"{i:05d}", d, t) for p, i, d, t in history()]
    df = spark.createDataFrame(rows, f"person string, id {ids}, created date, product_type string")
    got = {r["id"]: r for r in product_history_counts(df, as_of=str(AS_OF), ranges=4).collect()}
    merged = {r["id"]: r for r in horizon_counts_merge(df).collect()}
    assert len(got) == len(merged) == len(rows)
    for r in rows:
        p, i, d, _ = r
        prior = brute(rows, r, lambda o: d is not None and (o[2], o[1]) < (d, i))
        prior[0] = sum(prior[1:])
        want = {"orig": prior, "today": brute(rows, r, lambda o: o[2] < AS_OF)}
        for n in (3, 6, 12):
            want[f"{n}month"] = brute(rows, r, lambda o, n=n: d is not None and o[2] < add_months(d, n))
        for s, values in want.items():
            names = [f"cnt_{k}_post_accts1_{s}" for k in ("tot", *CODES.values())]
            assert [got[i][c] for c in names] == values
            if s.endswith("month"):
                assert [merged[i][c] for c in names] == values


@pytest.mark.parametrize("hot", [False, True])
def test_previous_rows(spark, hot):
    rnd = random.Random(6)
    times = [None, *(dt.datetime(2020, 1, 1 + i % 3, i % 24) for i in range(12))]
    rows = [(rnd.choice([None, "a", "b"]), i, rnd.choice(times)) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp")
    kw = {"ranges": 5} if hot else {}
    got = {r["id"]: [r[f"_prev{i}"]["id"] if r[f"_prev{i}"] else None for i in (1, 2, 3)]
           for r in previous_rows(df, key="k", ts="ts", tie="id", cols=["id"], n=3, **kw).collect()}
    assert len(got) == len(rows)
    for k, i, _ in rows:
        order = [r[1] for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[1]))]
        at = order.index(i)
        assert got[i] == [order[at - j] if at >= j else None for j in (1, 2, 3)]


def test_previous_rows_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        start = 1604214000  # 2020-11-01 00:00 there; the clock goes back at 02:00
        df = spark.range(240).select(F.lit("a").alias("k"), "id", F.timestamp_seconds(F.lit(start) + F.col("id") * 60).alias("ts"))
        rows = previous_rows(df, key="k", ts="ts", tie="id", cols=["id"], n=1, ranges=16).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {r["id"]: r["_prev1"] and r["_prev1"]["id"] for r in rows} == {i: i - 1 if i else None for i in range(240)}


def test_date_first(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 3, 5, 20, 0),)], "t timestamp_ntz")
    row = df.select(local_date("t", "Etc/GMT+8").alias("a"), local_date("t", "Etc/GMT+8", date_first=True).alias("b")).first()
    assert (row.a, row.b) == (dt.date(2020, 3, 5), dt.date(2020, 3, 4))


def test_load_sees_a_rewritten_table(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/orders.parquet")
    assert load(spark, str(tmp_path), "orders").columns == ["id"]
    spark.range(2).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert load(spark, str(tmp_path), "orders").columns == ["id", "x"]


def test_no_machine_local_working_folder():
    class Context:
        master = "local[2]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        shared_dir(Session())
