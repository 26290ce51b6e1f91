"""Scalar functions and bands at their edges (FIXTURES section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrail.codes import ZONE_LOS_ANGELES, ZONE_PST_FIXED
from acctrail.functions import (band, cashflow_band, classify, days_between, days_between_band,
                                first_code, flag, income_band, local_date, null_or_ne, ratio,
                                score_band_coarse, score_band_fine, usage_mix, year_month)


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def test_score_bands_edges(spark):
    vals = [None, -0.01, 0.0, 0.0299, 0.03, 0.07, 0.0799, 0.08, 0.09, 0.1, 0.11, 0.27, 0.5]
    df = one_col(spark, vals, T.DoubleType())
    got = {r["v"]: (r["f"], r["c"]) for r in
           df.select("v", score_band_fine("v").alias("f"), score_band_coarse("v").alias("c")).collect()}
    assert got[None] == ("w:Null", "w:Null")
    assert got[-0.01] == (None, None)  # negative: no branch, no ELSE
    assert got[0.0][0] == "a:[0%-3%)" and got[0.0299][0] == "a:[0%-3%)"
    assert got[0.03][0] == "b:[3%-5%)"
    assert got[0.07] == ("d:[7%-8%)", "d:[7%-9%)")
    assert got[0.08] == ("d:[8%-9%)", "d:[7%-9%)")
    assert got[0.1] == ("f:[10%-13%)", "e:[9%-11%)")
    assert got[0.27] == ("t:[27%+)", "t:[27%+)")


def test_income_and_cashflow_bands(spark):
    vals = [None, -1.0, 0.0, 49999.99, 50000.0, 124999.0, 125000.0, 125000.01, 1e7]
    df = one_col(spark, vals, T.DoubleType())
    got = {r["v"]: r["b"] for r in df.select("v", income_band("v").alias("b")).collect()}
    assert got[None] == "NA" and got[-1.0] == "NA"
    assert got[0.0] == "<50K" and got[49999.99] == "<50K" and got[50000.0] == "50K-60K"
    assert got[124999.0] == "100K-125K"
    assert got[125000.0] == "NA"  # exactly 125000 matches no rule
    assert got[125000.01] == "125K+"
    cf = {r["v"]: r["b"] for r in one_col(spark, [None, -5.0, 1999.0, 2000.0, 29999.0, 30000.0], T.DoubleType())
          .select("v", cashflow_band("v").alias("b")).collect()}
    assert cf == {None: "NA", -5.0: "NA", 1999.0: "<2000", 2000.0: "2K-4K", 29999.0: "25K-30K", 30000.0: "30K+"}


def test_days_between_band_overlaps(spark):
    vals = [None, -1, 30, 31, 60, 365, 366, 545, 546, 730, 731]
    got = {r["v"]: r["b"] for r in one_col(spark, vals, T.IntegerType())
           .select("v", days_between_band("v").alias("b")).collect()}
    assert got == {None: "NA", -1: "<=30", 30: "<=30", 31: "30-60", 60: "30-60", 365: "270-365",
                   366: "365-545", 545: "365-545", 546: "545-730", 730: "545-730", 731: "730+"}


def test_band_generic_rules(spark):
    rules = [("lo", None, False, 10, False), ("hi", 10, True, None, False)]
    got = [r["b"] for r in one_col(spark, [None, 9.0, 10.0], T.DoubleType())
           .select(band("v", rules, null_label="n").alias("b")).collect()]
    assert got == ["n", "lo", "hi"]


def test_local_dates(spark):
    # 06:59 / 07:00 UTC in July and 07:59 / 08:00 in January, midnight, first of month
    ts = [dt.datetime(2024, 7, 10, 6, 59), dt.datetime(2024, 7, 10, 7, 0),
          dt.datetime(2024, 1, 10, 7, 59), dt.datetime(2024, 1, 10, 8, 0),
          dt.datetime(2024, 3, 1, 0, 0)]
    df = one_col(spark, ts, T.TimestampNTZType())
    rows = df.select("v", local_date("v", ZONE_LOS_ANGELES).alias("la"),
                     local_date("v", ZONE_PST_FIXED).alias("pst"),
                     year_month(local_date("v", ZONE_LOS_ANGELES)).alias("m")).collect()
    got = {r["v"]: (r["la"], r["pst"], r["m"]) for r in rows}
    D = dt.date
    assert got[ts[0]][:2] == (D(2024, 7, 9), D(2024, 7, 9))
    assert got[ts[1]][:2] == (D(2024, 7, 10), D(2024, 7, 9))   # DST: LA is UTC-7 in July
    assert got[ts[2]][:2] == (D(2024, 1, 9), D(2024, 1, 9))
    assert got[ts[3]][:2] == (D(2024, 1, 10), D(2024, 1, 10))
    assert got[ts[4]][2] == "2024-02"  # a first of month moves to the previous month


def test_local_date_of_date_input(spark):
    df = one_col(spark, [dt.date(2024, 3, 1)], T.DateType())
    assert df.select(local_date("v", ZONE_PST_FIXED)).first()[0] == dt.date(2024, 2, 29)


def test_first_code(spark):
    vals = ['["CB15","TR"]', '["CB15"]', "CB15", "[]", "", None]
    got = [r[0] for r in one_col(spark, vals, T.StringType()).select(first_code("v")).collect()]
    assert got == ["CB15", "CB15", "CB15", "", "", None]


def test_ratio_and_usage(spark):
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("bt", "draws", "cards")])
    df = spark.createDataFrame([(None, 0, 0), (None, None, 1), (None, 2, 1), (None, 4, 1), (5, 0, 0),
                                (0, -1, 0)], schema)
    got = [(r["r"], r["u"]) for r in df.select(ratio("cards", "draws").alias("r"),
                                                 usage_mix("bt", "draws", "cards").alias("u")).collect()]
    assert got == [(None, "No draw"), (None, "NA"), (0.5, "Card Draw"), (0.25, "ACH Draw"),
                   (None, "BT"), (-0.0, "NA")]


def test_flag_classify_null_semantics(spark):
    df = one_col(spark, [None, "PHONE", "WEB"], T.StringType())
    rows = df.select(flag(F.col("v") == "WEB").alias("f"), null_or_ne("v", "PHONE").alias("n"),
                     classify([(F.col("v") == "WEB", "w")]).alias("c"),
                     classify([(F.col("v") == "WEB", "w")], "other").alias("d")).collect()
    assert [(r.f, r.n, r.c, r.d) for r in rows] == [(0, True, None, "other"), (0, False, None, "other"),
                                                     (1, True, "w", "w")]


@pytest.mark.parametrize("later,earlier,days", [
    (dt.datetime(2024, 1, 2, 0, 1), dt.datetime(2024, 1, 1, 23, 59), 1),
    (dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 1, 1, 0), 0),
])
def test_days_between_counts_boundaries(spark, later, earlier, days):
    schema = T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())])
    df = spark.createDataFrame([(later, earlier)], schema)
    assert df.select(days_between("a", "b")).first()[0] == days
