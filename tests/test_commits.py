import os

import pytest
from pyspark.sql import functions as F

from plotwright.operators import select
from plotwright.session import work_path
from plotwright.sources import commits, sinks, tables


def values(df):
    return sorted(r[0] for r in df.collect())


def half_written(path):
    os.makedirs(os.path.join(path.removeprefix("file:"), "_temporary", "0"))


def test_a_half_written_version_is_passed_over_and_published_again(spark):
    path = work_path(spark, "t")
    assert sinks.publish(spark.range(3), path, 1) == 3
    sinks.stage({sinks.TABLE: spark.range(2)}, path, 2)
    half_written(f"{path}/version=3")
    assert values(sinks.read_latest(spark, path)) == [0, 1, 2]
    assert sinks.publish(spark.range(5), path, 2) == 5
    assert sinks.read_latest(spark, path).count() == 5
    assert len(commits.reclaim(spark, path, older_than=-1)) == 2
    assert sinks.read_latest(spark, path).count() == 5 and sinks.drop_versions(spark, path, keep=1) == ["1"]


def test_of_two_writers_of_a_version_one_loses(spark):
    path = work_path(spark, "t")
    first, second = (sinks.stage({sinks.TABLE: spark.range(n)}, path, 1) for n in (1, 2))
    commits.commit(spark, path, "version=1", second)
    with pytest.raises(commits.AlreadyCommitted):
        commits.commit(spark, path, "version=1", first)
    with pytest.raises(commits.AlreadyCommitted):
        sinks.publish(spark.range(3), path, 1)
    assert sinks.read_latest(spark, path).count() == 2
    assert commits.committed(spark, path) == ["version=1"]


def test_a_version_of_two_tables_is_seen_whole_or_not(spark):
    path = work_path(spark, "set")
    sinks.publish_set({"kept": spark.range(4), "garbage": spark.range(0)}, path, 1)
    with pytest.raises(Exception, match="BOOM"):
        sinks.publish_set({"kept": spark.range(3), "garbage": spark.range(1).withColumn("id", F.raise_error(F.lit("BOOM")).cast("long"))}, path, 2)
    assert values(sinks.read_set(spark, path, "kept")) == [0, 1, 2, 3] and values(sinks.read_set(spark, path, "garbage")) == []
    assert sinks.publish_set({"kept": spark.range(3), "garbage": spark.range(3, 4)}, path, 2) == {"kept": 3, "garbage": 1}
    assert values(sinks.read_set(spark, path, "garbage")) == [3]


def test_a_half_written_day_is_passed_over(spark):
    path = work_path(spark, "days")
    rows = spark.createDataFrame([("2024-05-01", 1), ("2024-05-02", 2)], "snapshot_date string, v int")
    sinks.append(rows, path, ["snapshot_date"])
    half_written(f"{path}/snapshot_date=2024-05-03")
    assert values(tables.read_latest_snapshot(spark, path).select("v")) == [2]
    sinks.replace_partition(spark.createDataFrame([("2024-05-04", 4)], "snapshot_date string, v int"), path)
    assert values(tables.read_latest_snapshot(spark, path).select("v")) == [4]
    # A day that was recorded and has lost files since is not whole; nor are days that were never recorded.
    sinks.replace_partition(spark.createDataFrame([("2024-05-05", 5)], "snapshot_date string, v int"), path)
    day = f"{path}/snapshot_date=2024-05-05".removeprefix("file:")
    for name in os.listdir(day):
        os.remove(os.path.join(day, name))
    assert values(tables.read_latest_snapshot(spark, path).select("v")) == [4]


def test_a_half_written_plan_is_passed_over_and_written_again(spark):
    path = work_path(spark, "plans")
    ids = spark.range(10).withColumnRenamed("id", "internal_id")
    sinks.write_batches(select.batches(ids, "internal_id", 5), path, "20240501_090000")
    select.batches(ids.limit(3), "internal_id", 5).withColumn("run", F.lit("20240502_090000")).write.mode("append").partitionBy("run").json(path)
    assert sinks.read_batches(spark, path, "internal_id bigint").count() == 10
    sinks.write_batches(select.batches(ids, "internal_id", 2), path, "20240502_090000")
    plan = sinks.read_batches(spark, path, "internal_id bigint")
    assert plan.count() == 10 and plan.agg(F.max("batch_no")).first()[0] == 4


def test_a_repeated_run_is_in_the_ledgers_once(spark):
    path = work_path(spark, "ledger")
    rows = spark.createDataFrame([(1, "a\nb"), (2, 'say "x"')], "internal_id int, error_message string")
    for run in ("r1", "r2", "r1"):
        sinks.record_failures(rows, path, run)
    assert sorted(map(tuple, sinks.read_failures(spark, path, rows.schema).collect())) == sorted([(1, "a\nb"), (2, 'say "x"')] * 2)
    assert spark.read.json(f"{path}/json").count() == 4
