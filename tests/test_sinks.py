"""Vintage writers and the shared folder."""

import datetime as dt

from pyspark.sql import functions as F

from meterline.session import shared_folder
from meterline.sources import sinks
from meterline.sources.shared import one_build, shared, stored
from meterline.sources.tables import rule_table

D = dt.date


def frame(spark, data):
    return spark.createDataFrame(data, "vintage date, unit string, y double")


def test_only_written_vintages_are_replaced(spark, tmp_path):
    path = str(tmp_path / "forecast")
    sinks.write_vintages(frame(spark, [(D(2001, 1, 1), "a", 1.0), (D(2001, 1, 8), "a", 2.0), (D(2001, 1, 8), "b", 3.0)]),
                         path, cluster_by=("unit",))
    sinks.write_vintages(frame(spark, [(D(2001, 1, 8), "a", 9.0)]), path, cluster_by=("unit",))
    got = sorted((r["vintage"], r["unit"], r["y"]) for r in spark.read.parquet(path).collect())
    assert got == [(D(2001, 1, 1), "a", 1.0), (D(2001, 1, 8), "a", 9.0)]


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "table")
    one = frame(spark, [(D(2001, 1, 1), "a", 1.0)])
    sinks.append(one, path)
    sinks.append(one, path)
    assert spark.read.parquet(path).count() == 2
    sinks.overwrite(one, path)
    assert spark.read.parquet(path).count() == 1


def test_snapshot_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    data = [(D(2001, 1, 1), "a", 1.0), (D(2001, 1, 8), "a", 2.0)]
    sinks.append(frame(spark, data).withColumnRenamed("vintage", "snapshot_date"), path, "snapshot_date")
    kept = sinks.read_snapshot(spark, path, D(2001, 1, 8))
    assert [r["y"] for r in kept.collect()] == [2.0]
    assert "PartitionFilters: [isnotnull(snapshot_date" in kept._jdf.queryExecution().executedPlan().toString()


def test_stored_table_has_the_same_rows_and_a_short_plan(spark):
    df = spark.range(10).select("id", (F.col("id") * 2).alias("twice"))
    table = stored(df)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))
    assert "Range" not in table._jdf.queryExecution().analyzed().toString()
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_tables_are_shared_within_one_build_only(spark):
    built = []

    @shared
    def table(session, sf_dir):
        built.append(sf_dir)
        return session.range(1)

    with one_build():
        assert table(spark, "x") is table(spark, "x")
        table(spark, "y")
    table(spark, "x")
    assert built == ["x", "y", "x"]


def test_rule_tables_of_any_size(spark):
    rows = rule_table(spark, [(i,) for i in range(10_001)], "n int")
    assert sorted(r["n"] for r in rows.collect()) == list(range(10_001))
    assert rule_table(spark, [], "n int").count() == 0
    # Spark knows the size: a small table is broadcast without a hint
    joined = spark.range(100_000).join(rule_table(spark, [(1, "a")], "id long, name string"), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
