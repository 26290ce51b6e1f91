"""NULL-spreading outer/anti joins equal the plain joins, and spread NULL keys."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrail.operators.joins import left_anti_join, left_join

L = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType())])
R = T.StructType([T.StructField("rk", T.LongType()), T.StructField("v", T.StringType())])


def frames(spark):
    left = spark.createDataFrame([(i, None if i % 4 else i % 7) for i in range(400)], L)
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 7, 2)] + [(None, "nullkey")], R)
    return left, right


def test_left_join_matches_plain(spark):
    left, right = frames(spark)
    got = sorted(tuple(r) for r in left_join(left, right, "k", "rk", salt="id").select("id", "k", "v").collect())
    want = sorted(tuple(r) for r in left.join(right, F.col("k") == F.col("rk"), "left").select("id", "k", "v").collect())
    assert got == want
    assert sum(1 for r in got if r[1] is None) == 300 and all(r[2] is None for r in got if r[1] is None)


def test_left_anti_matches_plain(spark):
    left, right = frames(spark)
    got = sorted(r["id"] for r in left_anti_join(left, right, "k", "rk", salt="id").collect())
    want = sorted(r["id"] for r in left.join(right, F.col("k") == F.col("rk"), "left_anti").collect())
    assert got == want


def test_null_keys_are_spread(spark):
    left, right = frames(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = (left_join(left, right, "k", "rk", salt="id").filter(F.col("k").isNull())
                 .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1
