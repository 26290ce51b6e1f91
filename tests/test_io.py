"""Typed CSV load, reject split and idempotent materialize (FIXTURES section 4 'load file')."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from acctrail.codes import count_cols
from acctrail.session import fresh_dir, shared_dir
from acctrail.sources import files
from acctrail.sources.tables import named
from oracle.sql import queries


def _line(person, id_, prod, date, counts="0"):
    return ",".join([person, id_, prod, date] + [counts] * 25)


def test_typed_load_and_rejects(spark):
    path = fresh_dir(spark, "load_fixture")
    header = ",".join(["person", "id", "product_type", "created"] + count_cols())
    lines = [header,
             _line("p1", "1", "PCL", "2024-01-31"),            # good
             _line("p2", "x9", "PCL", "2024-01-31"),           # bad int
             _line("p3", "3", "PCL", "31/01/2024"),            # bad date
             "p4,4,PCL",                                      # short row
             _line('"p,5"', "5", "PL", "2024-02-29")]          # quoted comma: good
    spark.sparkContext.parallelize(["\n".join(lines)], 1).saveAsTextFile(path)
    good, bad = files.split_rejects(files.load_typed_csv(spark, path))
    g = {r["id"]: r for r in good.collect()}
    assert set(g) == {1, 5}
    assert g[5]["person"] == "p,5" and g[5]["created"] == dt.date(2024, 2, 29)
    b = sorted(r["raw_line"][:6] for r in bad.collect())
    assert b == ["p2,x9,", "p3,3,P", "p4,4,P"]
    report = files.reject_report(spark, path).collect()
    assert [r["raw_line"][:2] for r in report] == ["p2", "p3", "p4"]
    assert [r["reason"] for r in report] == ["not parsed: id", "not parsed: created", "not 29 fields"]
    assert all(r["file"].endswith("part-00000") and r["file_time"] is not None for r in report)


def test_materialize_replaces(spark):
    path = fresh_dir(spark, "ctas_fixture")
    df = spark.range(5)
    files.materialize(df, path)
    files.materialize(df, path)
    assert spark.read.parquet(path).count() == 5


def test_materialize_replaces_a_named_table(spark):
    spark.sql(f"CREATE DATABASE named_fixture LOCATION '{fresh_dir(spark, 'named_fixture')}'")
    files.materialize(spark.range(7), "named_fixture.kept")
    files.materialize(spark.range(5), "named_fixture.kept")
    assert named(spark, "named_fixture.kept").count() == 5
    spark.sql("DROP DATABASE named_fixture CASCADE")


def test_every_channel_label_occurs():
    con = duckdb.connect()
    for name in ("orders", "customer", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    labels = con.sql(queries()["channel_classify"]).select("pcl_channel").distinct().fetchall()
    assert len(labels) == 10 and ("RAS-ERROR",) in labels


def test_shared_dir_uses_checkpoint_dir(spark):
    assert shared_dir(spark).rstrip("/").endswith(spark.sparkContext.getCheckpointDir().rstrip("/").split("/")[-1])


def test_streaming_ingest_splits_rejects(spark):
    from acctrail.streaming import load_history_stream
    src = fresh_dir(spark, "stream_src")
    header = ",".join(["person", "id", "product_type", "created"] + count_cols())
    files_in = [[header, _line("p1", "1", "PCL", "2024-01-31"), _line("p2", "2", "PL", "2024-13-01")],
                [header, _line("p3", "3", "DEP", "2023-12-01"), "p4,4"]]
    for i, lines in enumerate(files_in):
        spark.sparkContext.parallelize(["\n".join(lines)], 1).saveAsTextFile(f"{src}/part{i}")
    table, rejects = fresh_dir(spark, "stream_table"), fresh_dir(spark, "stream_rejects")
    ckpt = fresh_dir(spark, "stream_ckpt")
    q = load_history_stream(spark, f"{src}/*", table, rejects, checkpoint_dir=ckpt, max_files_per_trigger=1)
    q.awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [1, 3]
    assert sorted(r["raw_line"][:2] for r in spark.read.parquet(rejects).collect()) == ["p2", "p4"]
    # a restart on the same checkpoint finds nothing new: no duplicate rows
    q2 = load_history_stream(spark, f"{src}/*", table, rejects, checkpoint_dir=ckpt, max_files_per_trigger=1)
    q2.awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [1, 3]


def _failing(spark, n=400):
    """A frame of which only some tasks fail while it is written."""
    return spark.range(n, numPartitions=8).withColumn(
        "id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost halfway")).cast("long")).otherwise(F.col("id")))


def test_a_write_that_dies_leaves_the_old_table(spark):
    folder = fresh_dir(spark, "replace_fixture")
    files.materialize(spark.range(5), folder)
    with pytest.raises(Exception, match="lost halfway"):
        files.materialize(_failing(spark), folder)
    assert spark.read.parquet(folder).count() == 5
    files.materialize(spark.range(7), folder)
    assert spark.read.parquet(folder).count() == 7

    spark.sql(f"CREATE DATABASE replace_fixture LOCATION '{fresh_dir(spark, 'replace_db')}'")
    try:
        files.materialize(spark.range(5), "replace_fixture.kept")
        with pytest.raises(Exception, match="lost halfway"):
            files.materialize(_failing(spark), "replace_fixture.kept")
        assert named(spark, "replace_fixture.kept").count() == 5
        files.materialize(spark.range(6), "replace_fixture.kept")
        assert named(spark, "replace_fixture.kept").count() == 6
        files.materialize(spark.range(3).withColumn("more", F.lit("x")), "replace_fixture.kept")
        assert named(spark, "replace_fixture.kept").columns == ["id", "more"]
    finally:
        spark.sql("DROP DATABASE replace_fixture CASCADE")


def test_published_versions(spark):
    target = fresh_dir(spark, "publish_fixture")
    with pytest.raises(FileNotFoundError):
        files.current(spark, target)
    files.publish(spark.range(5), target)
    reader = files.current(spark, target)
    with pytest.raises(Exception, match="lost halfway"):
        files.publish(_failing(spark), target)
    assert files.current(spark, target).count() == 5
    files.publish(spark.range(6), target)
    assert files.current(spark, target).count() == 6 and reader.count() == 5
    files.publish(spark.range(0), target)
    assert files.current(spark, target).count() == 0 and len(files.versions(spark, target)) == 2


def test_reject_log_of_two_loads(spark):
    header = ",".join(["person", "id", "product_type", "created"] + count_cols())
    log = fresh_dir(spark, "reject_log_fixture")
    loads = {"a": [_line("p1", "x", "PCL", "2024-01-31"), _line("p2", "2", "PCL", "2024-01-31")], "b": ["p3,3"]}
    for load_id, lines in loads.items():
        src = fresh_dir(spark, f"load_{load_id}")
        spark.sparkContext.parallelize(["\n".join([header, *lines])], 1).saveAsTextFile(src)
        files.log_rejects(spark, src, log, load_id)
        if load_id == "a":  # loading again replaces that load's rejects
            files.log_rejects(spark, src, log, load_id)
    rows = files.reject_log(spark, log).collect()
    assert [(r.load_id, r.raw_line[:2], r.reason) for r in rows] == [("b", "p3", "not 29 fields"), ("a", "p1", "not parsed: id")]
    assert rows[0].file_time >= rows[1].file_time


def test_sorted_write_keeps_the_order_over_its_files(spark):
    import glob

    import pyarrow.parquet as pq
    df = spark.range(5000).select(F.when(F.col("id") % 50 > 0, (F.col("id") * 7919) % 1013).alias("v"), "id")
    path = files.write_sorted(df, [F.col("v").desc_nulls_first(), "id"], fresh_dir(spark, "sorted_fixture"), ranges=6)
    parts = sorted(glob.glob(path.removeprefix("file://").removeprefix("file:") + "/part-*.parquet"))
    got = [(r["v"], r["id"]) for p in parts for r in pq.read_table(p).to_pylist()]
    assert len(parts) > 1 and got == sorted(got, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1])) and len(got) == 5000


@pytest.mark.parametrize("table", ["cycles", "scores", "autopay"])
def test_a_repeated_lookup_key_fails_by_name(spark, table):
    from acctrail.plans.pipeline import Pipeline
    from acctrail.sources.roles import Roles
    roles = Roles(spark, "/root/testdata/sf0.001")
    given = getattr(roles, table)
    again = given.filter("mob = 1") if table == "cycles" else given

    class Doubled:
        def __getattr__(self, name):
            return given.unionByName(again.limit(1)) if name == table else getattr(roles, name)

    with pytest.raises(Exception, match=f"{table} has more than one row"):
        Pipeline(Doubled(), as_of="2000-01-01").front_end().write.format("noop").mode("overwrite").save()
