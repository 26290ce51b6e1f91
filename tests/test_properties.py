"""Property tests: random histories against brute force (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from acctrail.operators.ordered import horizon_counts_merge, previous_rows, product_history_counts
from tests.test_history import AS_OF, SCHEMA, brute_counts, brute_previous

DAYS = [dt.date(2023, 1, 28) + dt.timedelta(days=i) for i in range(0, 400, 3)] + [
    dt.date(2023, 11, 30), dt.date(2024, 2, 29), dt.date(2024, 1, 31), dt.date(2024, 4, 30)]
rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(DAYS),
              st.sampled_from(["PCL", "PL", "DEP", "HM", "OTHER"])),
    min_size=1, max_size=60)
PROFILE = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def with_ids(rows):
    return [(p, 100 + i, d, prod) for i, (p, d, prod) in enumerate(rows)]


@PROFILE
@given(rows_strategy, st.sampled_from([None, 4]))
def test_counts_match_brute_force(spark, rows, ranges):
    rows = with_ids(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r.asDict() for r in product_history_counts(
        df, as_of=AS_OF.isoformat(), ranges=ranges).collect()}
    for i, want in brute_counts(rows).items():
        assert {c: got[i][c] for c in want} == want


@PROFILE
@given(rows_strategy)
def test_merge_counts_match_frames(spark, rows):
    df = spark.createDataFrame(with_ids(rows), SCHEMA)
    a = {r["id"]: r.asDict() for r in product_history_counts(df, include=("months",)).collect()}
    b = {r["id"]: r.asDict() for r in horizon_counts_merge(df).collect()}
    assert a == b


@PROFILE
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 5), st.integers(0, 3),
                          st.sampled_from(["PCL", "PL"])), min_size=1, max_size=50))
def test_previous_rows_match_brute_force(spark, raw):
    base = dt.datetime(2022, 6, 1)
    rows = [(p, 10 + i, base + dt.timedelta(days=d, hours=6 * h), prod) for i, (p, d, h, prod) in enumerate(raw)]
    schema = T.StructType([T.StructField("person", T.StringType()), T.StructField("id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()), T.StructField("prod", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    res = previous_rows(df, key="person", ts="ts", tie="id", cols=["prod"], n=5, prefix="p",
                        ranges=3)
    got = {r["id"]: [r[f"p{k}"]["prod"] if r[f"p{k}"] is not None else None for k in range(1, 6)]
           for r in res.collect()}
    assert got == brute_previous(rows)
