"""Tables by day and in buckets: same rows, folders pruned, joins without a shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acctrail.plans.features import feature_snapshot
from acctrail.plans.pipeline import Pipeline
from acctrail.session import written
from acctrail.sources.layout import bucketed, by_day
from acctrail.sources.roles import Roles

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def positions(spark):
    p = Roles(spark, SF).positions.filter(F.year("processing_date") == 1995)
    return p, by_day(p, "processing_date")


def test_a_day_reads_its_folder_only(spark, positions):
    p, daily = positions
    assert daily.dtypes == p.dtypes and rows(daily) == rows(p)
    as_of = str(p.agg(F.max("processing_date")).first()[0] + dt.timedelta(days=2))
    snapshot = feature_snapshot(daily, as_of)
    assert rows(snapshot) == rows(feature_snapshot(p, as_of)) != []
    scan = next(line for line in executed(snapshot).splitlines() if "FileScan" in line)
    assert "processing_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_days_from_a_table_prune_at_run_time(spark, positions):
    p, daily = positions
    days = p.select("processing_date").distinct().withColumn("day_of_month", F.dayofmonth("processing_date"))
    firsts = written(days, "calendar").filter("day_of_month = 1").select("processing_date")
    snapshot = feature_snapshot(daily, "2000-01-01", days=firsts)
    assert "dynamicpruning" in executed(snapshot)
    want = feature_snapshot(p.join(firsts, "processing_date", "left_semi"), "2000-01-01",
                            days=p.select("processing_date").distinct())
    assert rows(snapshot) == rows(want) != []


def test_rows_without_a_day_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, dt.date(2020, 1, 1), None), (2, dt.date(2020, 1, 1), None)],
                               "id long, day date, v string")
    for some in (df, df.limit(0)):
        assert rows(by_day(some, "day")) == rows(some)
        assert rows(bucketed(some, "id", 4, "edge")) == rows(some)


def test_a_heavy_day_is_written_by_several_tasks(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2020-01-01"), (F.col("id") % 90).cast("int")))
                                     .otherwise(F.lit("2021-01-01").cast("date")).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        daily = by_day(df, "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = daily.select(F.col("day").cast("string"), F.input_file_name().alias("file")).distinct().groupBy("day").count()
    files = {r["day"]: r["count"] for r in files.collect()}
    assert files.pop("2021-01-01") > 3
    # a light day that shares the heavy day's partition is cut with it, the others are not
    assert len(files) == 30 and sorted(files.values())[15] <= 2


def test_mart_joins_buckets_without_a_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        roles = Roles(spark, SF)
        plain = Pipeline(roles, as_of="2000-01-01", materialize=True).front_end()
        mart = Pipeline(roles, as_of="2000-01-01", materialize=True, buckets=4).front_end()
        assert "Exchange" in executed(plain)
        plan = executed(mart)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 8
        assert rows(mart) == rows(plain) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_buckets_grow_with_the_lines(spark):
    """A task joins one bucket of each table, so a bucket's rows are bounded whatever the number of lines."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        roles = Roles(spark, SF)
        lines = roles.front_end.count()
        mart = Pipeline(roles, as_of="2000-01-01", materialize=True, buckets=2, bucket_rows=lines // 6).front_end()
        assert mart.rdd.getNumPartitions() >= 6
        assert "Exchange" not in executed(mart)
        most = mart.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < lines // 3
        plain = Pipeline(roles, as_of="2000-01-01", materialize=True).front_end()
        assert rows(mart) == rows(plain) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
