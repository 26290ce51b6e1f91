"""Product-history counts (W5-W7) and previous rows (W3) against brute force."""

import datetime as dt
import random

from dateutil.relativedelta import relativedelta
from pyspark.sql import types as T

from acctrail.codes import Products, count_col
from acctrail.operators.ordered import horizon_counts_merge, in_ranges, previous_rows, product_history_counts

D = dt.date
AS_OF = D(2024, 6, 1)
KNOWN = ("PCL", "PL", "DEP", "HM")
CATS = {"pcl": "PCL", "pl": "PL", "dep": "DEP", "hm": "HM"}
SCHEMA = T.StructType([T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
                       T.StructField("created", T.DateType()), T.StructField("product_type", T.StringType())])

# FIXTURES section 4 "history": NULL persons, ties on date, month ends, an exact
# add_months boundary, unknown product, single-row person, PCL at distance 1/5/6
EDGE_ROWS = [
    (None, 1, D(2023, 1, 31), "PCL"), (None, 2, D(2023, 1, 31), "PL"),
    ("a", 10, D(2023, 11, 30), "PCL"), ("a", 11, D(2024, 2, 29), "PL"), ("a", 12, D(2024, 2, 29), "PCL"),
    ("a", 13, D(2024, 1, 29), "DEP"), ("a", 14, D(2024, 1, 30), "HM"), ("a", 15, D(2024, 1, 31), "OTHER"),
    ("a", 16, D(2024, 4, 30), "PCL"), ("a", 17, D(2024, 4, 29), "PCL"),
    ("b", 20, D(2022, 5, 1), "PCL"), ("b", 21, D(2022, 8, 1), "PL"), ("b", 22, D(2022, 7, 31), "PL"),
    ("c", 30, D(2020, 1, 1), "PCL"),
    ("d", 40, D(2021, 1, 1), "PCL"), ("d", 41, D(2021, 1, 2), "PL"), ("d", 42, D(2021, 1, 3), "PL"),
    ("d", 43, D(2021, 1, 4), "PL"), ("d", 44, D(2021, 1, 5), "PL"), ("d", 45, D(2021, 1, 6), "PCL"),
    ("d", 46, D(2021, 1, 7), "PCL"), ("d", 47, D(2021, 1, 8), "PL"), ("d", 48, D(2021, 1, 8), "PL"),
]


def brute_counts(rows):
    out = {}
    for p, i, d, prod in rows:
        res = {}
        same = [r for r in rows if p is not None and r[0] == p]
        before = [r for r in same if (r[2], r[1]) < (d, i)]
        for k, code in CATS.items():
            res[count_col(k, "orig")] = sum(1 for r in before if r[3] == code)
        res[count_col("tot", "orig")] = sum(1 for r in before if r[3] in KNOWN)
        for n in (3, 6, 12):
            bound = d + relativedelta(months=n)
            inside = [r for r in same if r[2] < bound]
            res[count_col("tot", f"{n}month")] = len(inside)
            for k, code in CATS.items():
                res[count_col(k, f"{n}month")] = sum(1 for r in inside if r[3] == code)
        today = [r for r in same if r[2] < AS_OF]
        res[count_col("tot", "today")] = len(today)
        for k, code in CATS.items():
            res[count_col(k, "today")] = sum(1 for r in today if r[3] == code)
        out[i] = res
    return out


def random_rows(seed, n_people=6, hot_rows=300):
    rnd = random.Random(seed)
    rows, nid = [], 1000
    for p in range(n_people):
        k = hot_rows if p == 0 else rnd.randint(1, 12)
        for _ in range(k):
            d = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60 if p == 0 else 900))
            rows.append((f"p{p}" if p != 5 else None, nid, d, rnd.choice(KNOWN + ("OTHER",))))
            nid += 1
    return rows


def _check_counts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r.asDict() for r in product_history_counts(df, as_of=AS_OF.isoformat()).collect()}
    want = brute_counts(rows)
    assert set(got) == set(want)
    for i, w in want.items():
        for c, v in w.items():
            assert got[i][c] == v, (i, c, got[i][c], v)
    return got


def test_counts_edge_fixture(spark):
    got = _check_counts(spark, EDGE_ROWS)
    assert all(v == 0 for k, v in got[1].items() if k.startswith("cnt_"))  # NULL person
    # add_months(2023-11-30, 3) = 2024-02-29: the two rows on that day are excluded
    assert got[10][count_col("tot", "3month")] == 4
    # same-day tie broken by id: 11 (PL) precedes 12 (PCL)
    assert got[12][count_col("pl", "orig")] == got[11][count_col("pl", "orig")] + 1


def test_counts_random_with_hot_person(spark):
    got = _check_counts(spark, random_rows(7))
    for r in got.values():
        assert r[count_col("tot", "3month")] <= r[count_col("tot", "6month")] <= r[count_col("tot", "12month")]
        for k in CATS:
            assert r[count_col(k, "12month")] <= r[count_col("tot", "12month")]


def test_merge_formulation_matches_frames(spark):
    rows = random_rows(11) + EDGE_ROWS
    df = spark.createDataFrame(rows, SCHEMA)
    a = {r["id"]: r.asDict() for r in product_history_counts(df, include=("months",)).collect()}
    for ranges in (None, 7):
        b = {r["id"]: r.asDict() for r in horizon_counts_merge(df, ranges=ranges).collect()}
        assert a == b


def brute_previous(rows, n=5):
    out = {}
    for p, i, ts, prod in rows:
        same = sorted([r for r in rows if r[0] == p], key=lambda r: (r[2], r[1]))
        idx = [r[1] for r in same].index(i)
        out[i] = [same[idx - k][3] if idx - k >= 0 else None for k in range(1, n + 1)]
    return out


def test_previous_rows_blocks_and_halo(spark):
    rnd = random.Random(3)
    rows, nid = [], 1
    base = dt.datetime(2021, 3, 1)
    for p in ["x", "y", None]:
        for _ in range(80 if p == "x" else 15):
            # few distinct days so blocks hold 1..many rows; ties on timestamp
            ts = base + dt.timedelta(days=rnd.randint(0, 9), hours=rnd.choice([0, 0, 5, 23]))
            rows.append((p, nid, ts, rnd.choice(["PCL", "PL", "DEP"])))
            nid += 1
    schema = T.StructType([T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()), T.StructField("prod", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=5, prefix="p")
    got = {r["id"]: [r[f"p{k}"]["prod"] if r[f"p{k}"] is not None else None for k in range(1, 6)]
           for r in res.collect()}
    assert got == brute_previous(rows)


def test_products_default_codes():
    assert [c for _, c in Products().items()] == list(KNOWN)


def test_counts_with_hot_day_split(spark):
    """One person holds most rows on a single day, which spans several ranges;
    results must not change."""
    rnd = random.Random(5)
    rows = [("hot", 5000 + i, D(2022, 3, 1), rnd.choice(KNOWN + ("OTHER",))) for i in range(400)]
    rows += [("hot", 6000 + i, D(2022, 3, 2 + i % 20), rnd.choice(KNOWN)) for i in range(60)]
    rows += random_rows(13, n_people=4, hot_rows=30)
    df = spark.createDataFrame(rows, SCHEMA)
    res = product_history_counts(df, as_of=AS_OF.isoformat(), ranges=8)
    got = {r["id"]: r.asDict() for r in res.collect()}
    want = brute_counts(rows)
    for i, w in want.items():
        for c, v in w.items():
            assert got[i][c] == v, (i, c)


def test_previous_rows_with_hot_day_split(spark):
    rnd = random.Random(9)
    base = dt.datetime(2021, 3, 1)
    rows = [("h", i, base + dt.timedelta(minutes=rnd.randint(0, 600)), rnd.choice(["PCL", "PL"]))
            for i in range(1, 301)]
    rows += [("h", 400 + i, base + dt.timedelta(days=1 + i), "DEP") for i in range(10)]
    rows += [(None, 500 + i, base + dt.timedelta(hours=i), "PL") for i in range(12)]
    schema = T.StructType([T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()), T.StructField("prod", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=5, prefix="p",
                        ranges=16)
    got = {r["id"]: [r[f"p{k}"]["prod"] if r[f"p{k}"] is not None else None for k in range(1, 6)]
           for r in res.collect()}
    assert got == brute_previous(rows)


def _range_sizes(df, order, n):
    return sorted(r["count"] for r in in_ranges(df, order, n).groupBy("_part").count().collect())


def test_ranges_follow_the_rows(spark):
    """No range holds much more than the mean: one day with nearly all rows, one outlier
    id, string ids, rows without a person."""
    n = 1600
    hot = [("hot", i if i else 10 ** 15, D(2022, 3, 1), "PCL") for i in range(n - 100)]
    hot += [(None, n + i, D(2022, 3, 1), "PL") for i in range(100)]
    for rows, ids in ((hot, "long"), ([(p, f"x{i}", d, t) for p, i, d, t in hot], "string")):
        df = spark.createDataFrame(rows, f"person string, id {ids}, created date, product_type string")
        sizes = _range_sizes(df, ["person", "created", "id"], 8)
        assert sum(sizes) == n and max(sizes) <= 2 * n / 8


def test_previous_rows_one_timestamp_with_string_tie(spark):
    at = dt.datetime(2021, 7, 1)
    rows = [("m", f"{i:04d}", at, f"P{i}") for i in range(300)] + [("a", "z", at, "A"), ("z", "a", at, "Z")]
    df = spark.createDataFrame(rows, "person string, id string, ts timestamp_ntz, prod string")
    assert max(_range_sizes(df, ["person", "ts", "id"], 8)) <= 2 * len(rows) / 8
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=5, prefix="p", ranges=8)
    got = {r["id"] + r["person"]: [r[f"p{k}"]["prod"] if r[f"p{k}"] is not None else None for k in range(1, 6)]
           for r in res.collect()}
    assert len(got) == len(rows)
    for i in range(300):
        assert got[f"{i:04d}m"] == [f"P{i - k}" if i >= k else None for k in range(1, 6)]
    assert got["za"] == got["az"] == [None] * 5


def test_previous_rows_with_repeated_rows(spark):
    """Rows equal in time and tie still get one predecessor each, across ranges too."""
    at = dt.datetime(2021, 7, 1)
    rows = [("m", 1, at, f"P{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "person string, id long, ts timestamp_ntz, prod string")
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=1, prefix="p", ranges=6).collect()
    before = [r["p1"]["prod"] for r in res if r["p1"] is not None]
    assert len(res) == 200 and len(before) == len(set(before)) == 199


def test_empty_history(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert product_history_counts(df, as_of=AS_OF.isoformat()).count() == 0
    assert horizon_counts_merge(df).count() == 0
    assert previous_rows(df, key="person", ts="created", tie="id", cols=["id"]).count() == 0


def test_null_person_rows_are_spread_and_zero(spark):
    rows = [(None, 9000 + i, D(2022, 5, 5), "PCL") for i in range(300)] + [("z", 1, D(2022, 5, 5), "PL")]
    df = spark.createDataFrame(rows, SCHEMA)
    res = product_history_counts(df, as_of=AS_OF.isoformat(), ranges=8)
    out = {r["id"]: r for r in res.collect()}
    assert all(out[9000 + i][count_col("tot", "12month")] == 0 for i in range(300))
    assert out[1][count_col("tot", "12month")] == 1


def test_previous_rows_hot_day_at_one_timestamp(spark):
    """A bulk-loaded day (every row at midnight) spans several ranges and stays exact."""
    midnight = dt.datetime(2021, 7, 1)
    rows = [("m", 50 + i, midnight, "PCL" if i % 3 else "PL") for i in range(120)]
    rows += [("m", 10, midnight - dt.timedelta(days=1), "DEP"), ("m", 500, midnight + dt.timedelta(days=1), "HM")]
    schema = T.StructType([T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()), T.StructField("prod", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=5, prefix="p",
                        ranges=6)
    got = {r["id"]: [r[f"p{k}"]["prod"] if r[f"p{k}"] is not None else None for k in range(1, 6)]
           for r in res.collect()}
    assert got == brute_previous(rows)
