"""Nearest earlier matching row (W8), counted top-k (W2/O4) and joins on heavy keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrail.codes import AccountCodes
from acctrail.operators.firsts import latest_k
from acctrail.operators.heavy import heavy_keys, spread_join
from acctrail.operators.nearest import nearest_previous
from acctrail.plans.features import feature_deposit
from acctrail.plans.purchases import previous_products, repeat_purchase

S, L, TS = T.StringType(), T.LongType(), T.TimestampNTZType()
BASE = dt.datetime(2021, 3, 1)


def rows_schema(*cols):
    return T.StructType([T.StructField(n, t) for n, t in cols])


ROWS = rows_schema(("person", S), ("id", L), ("ts", TS), ("prod", S))


def random_rows(seed, sizes):
    rnd = random.Random(seed)
    rows, nid = [], 1
    for p, n in sizes.items():
        for _ in range(n):
            ts = None if rnd.random() < 0.05 else BASE + dt.timedelta(days=rnd.randint(0, 5))
            rows.append((p, nid, ts, rnd.choices(["PCL", "PL", None], [1, 6, 1])[0]))
            nid += 1
    return rows


def brute_nearest(rows, max_back):
    out = {}
    for p in {r[0] for r in rows}:
        same = sorted((r for r in rows if r[0] == p), key=lambda r: (r[2] is not None, r[2] or BASE, r[1]))
        for i, r in enumerate(same):
            hits = [(same[i - b][1], b) for b in range(1, max_back + 1) if i - b >= 0 and same[i - b][3] == "PCL"]
            out[r[1]] = hits[0] if hits else None
    return out


@pytest.mark.parametrize("ranges,max_back", [(1, 5), (7, 5), (60, 5), (13, 1), (9, 200)])
def test_nearest_over_range_bounds(spark, ranges, max_back):
    rows = random_rows(1, {"hot": 260, None: 60, "a": 9, "b": 1})
    df = spark.createDataFrame(rows, ROWS)
    found = nearest_previous(df, key="person", order=["ts", "id"], pred=F.col("prod") == "PCL", cols=["id", "ts"],
                             max_back=max_back, ranges=ranges).collect()
    assert {r.id: (r.nearest.id, r.nearest.back) if r.nearest else None for r in found} == brute_nearest(rows, max_back)
    assert len(found) == len(rows)


def test_match_crosses_ranges_that_hold_less_than_the_frame(spark):
    """One match, then rows in ranges of about two: the halo reaches back over several ranges."""
    rows = [("p", i, BASE + dt.timedelta(days=i), "PCL" if i == 3 else "PL") for i in range(40)]
    df = spark.createDataFrame(rows, ROWS)
    found = nearest_previous(df, key="person", order=["ts", "id"], pred=F.col("prod") == "PCL", cols=["id"],
                             max_back=11, ranges=20).collect()
    assert {r.id: r.nearest.back for r in found if r.nearest} == {i: i - 3 for i in range(4, 15)}


def test_own_names_and_empty_input(spark):
    names = ("_all", "_key", "_o0", "_tie", "_hit", "_pos", "_own", "_far", "_dist", "_at", "_kv", "_kn", "_part", "_end", "back")
    df = spark.createDataFrame([("p", i, None, "PCL") for i in range(3)], ROWS)
    for n in names:
        df = df.withColumn(n, F.concat(F.lit(n), F.col("id")))
    found = nearest_previous(df, key="person", order=["id"], pred=F.col("prod") == "PCL", cols=["id"], max_back=1)
    rows = found.orderBy("id").collect()
    assert [r.nearest.id if r.nearest else None for r in rows] == [None, 0, 1]
    assert all(r[n] == f"{n}{r.id}" for r in rows for n in names)
    none = nearest_previous(df.limit(0), key="person", order=["id"], pred=F.col("prod") == "PCL", cols=["id"], max_back=1)
    assert none.collect() == []


def test_repeat_purchase_equals_the_first_matching_slot(spark):
    rows = random_rows(2, {"hot": 120, "a": 12, None: 20})
    people = spark.createDataFrame(
        [(p, i, ts, prod, "OPENED" if i % 9 else "CLOSED") for p, i, ts, prod in rows],
        rows_schema(("person", S), ("id", L), ("created_at", TS), ("product_type", S), ("status", S)))
    codes = AccountCodes(opened="OPENED")
    channelled = people.filter("product_type = 'PCL'").select(
        "id", F.lit("2021-03").alias("contract_month"), F.concat(F.lit("ch"), F.col("id")).alias("pcl_channel"))
    want = {}
    for r in previous_products(people, channelled, codes=codes).filter("product_type = 'PCL' AND pcl_flag = 1").collect():
        i = next(i for i in range(1, 6) if r[f"prev_prod{i}"] == "PCL")
        want[r.id] = (f"prod{i} - PCL", r[f"channel_prev_prod{i}"], r[f"days_prod{i}"])
    got = {r.id: (r.previous_product, r.prev_channel, r.days_diff_twopcl)
           for r in repeat_purchase(people, channelled, codes=codes).collect()}
    assert got == want and want


# ------------------------------------------------------------------------ top-k
TOPK = rows_schema(("k", S), ("v", L), ("id", L))


def brute_topk(rows, k):
    out = []
    for key, v, i in rows:
        greater = sum(1 for r in rows if r[0] == key and (r[1] is None, r[1] or 0) > (v is None, v or 0))
        if greater + 1 <= k:
            out.append((key, v, i, greater + 1))
    return sorted(out, key=str)


def test_topk_counts_ties_nulls_and_repeats(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 3, 4, 5]), i) for i in range(90)]
    rows += [("c", 7, 1), ("c", 7, 1), ("c", 9, 2), ("d", None, 1), ("e", 1, 1)]
    for k in (1, 3, 50):
        df = spark.createDataFrame(rows, TOPK)
        assert sorted((tuple(r) for r in latest_k(df, "k", "v", k).collect()), key=str) == brute_topk(rows, k)


@pytest.fixture
def plain_joins(spark):
    """Neither runtime re-planning nor automatic broadcasts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def per_task(df):
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(counts), sum(counts) / 8


def test_equal_values_of_one_key_are_spread(spark, plain_joins):
    df = spark.range(8000).select(F.lit("hot").alias("k"), F.lit(1).alias("v"), "id")
    largest, mean = per_task(latest_k(df, "k", "v", 3))
    assert largest < 2 * mean


# -------------------------------------------------------------------- heavy keys
def test_spread_join_equals_the_plain_join(spark):
    rnd = random.Random(4)
    left = spark.createDataFrame([(i, rnd.choice([1, 1, 1, 2, 3, 4, None]), "x") for i in range(300)], "id long, k long, _pieces string")
    left = left.unionByName(left.limit(20))
    right = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four"), (9, "nine"), (None, "null")], "k long, _place string")
    for how in ("left", "inner"):
        got = spread_join(left, right, ["k"], how, most=10)
        want = left.join(right, "k", how).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    nulls = spread_join(left, right, ["k"], "inner", most=10, nulls=True)
    assert nulls.filter("k IS NULL").count() == left.filter("k IS NULL").count()
    assert spread_join(left.limit(0), right, ["k"]).collect() == []


def test_heavy_keys(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"))
    assert len(heavy_keys(df, ["k"], most=1000)) <= 1000
    assert heavy_keys(df, ["k"], most=10) == {}
    assert list(heavy_keys(df.select(F.lit(1).alias("k")), ["k"], most=10).values()) == [10]
    assert heavy_keys(df.select(F.lit(None).cast("long").alias("k")), ["k"]) == {}
    third = df.select(F.when(F.col("k") % 3 == 0, 0).otherwise(F.col("k")).alias("k"))
    assert max(heavy_keys(third, ["k"], most=300).values()) in range(99, 103)


def test_lines_of_a_hot_person_are_spread(spark, plain_joins):
    """One person holds a third of the lines; no re-planning at run time."""
    n = 6000
    person = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id")))
    people = spark.range(n).select("id", F.lit(None).cast("timestamp").alias("created_at"), F.lit("PCL").alias("product_type"),
                                   F.lit(AccountCodes().opened).alias("status"), F.lit(AccountCodes().pcl_program).alias("program"),
                                   F.lit("x").alias("program_code"), person.alias("person"))
    dap = spark.createDataFrame([], "account_id long, account_type string")
    out = feature_deposit(people, dap)
    largest, mean = per_task(out)
    assert out.count() == n and largest < 2 * mean
