import os

import pytest

from plotwright.session import work_path
from plotwright.sources import commits, merge

SCHEMA = "a int, b string, v int"


def rows(spark, path):
    return sorted(map(tuple, merge.read_merged(spark, path).collect()), key=str)


def files(path):
    data = path.removeprefix("file:") + "/data"
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(data) for f in fs if f.endswith(".parquet")}


def test_newest_row_of_each_key(spark):
    path = work_path(spark, "m")
    merge.create_merged(spark.createDataFrame([(i, None if i == 3 else "x", i) for i in range(6)], SCHEMA), path, ["a", "b"], 4)
    merge.upsert_rows(spark.createDataFrame([(3, None, 30), (9, "y", 90)], SCHEMA), path)
    merge.upsert_rows(spark.createDataFrame([(9, "y", 91), (1, "z", 10)], SCHEMA), path)
    merge.delete_rows(spark.createDataFrame([("x", 2), ("q", 5)], "b string, a int"), path)
    expected = sorted([(0, "x", 0), (1, "x", 1), (1, "z", 10), (3, None, 30), (4, "x", 4), (5, "x", 5), (9, "y", 91)], key=str)
    assert rows(spark, path) == expected
    merge.compact(spark, path)
    assert rows(spark, path) == expected
    merge.upsert_rows(spark.createDataFrame([(2, "x", 22)], SCHEMA), path)
    assert (2, "x", 22) in rows(spark, path) and merge.read_merged(spark, path).count() == 8


def test_compaction_leaves_untouched_buckets(spark):
    path = work_path(spark, "m")
    merge.create_merged(spark.range(1000).selectExpr("id AS k", "id AS v"), path, ["k"], 16)
    before = files(path)
    assert merge.compact(spark, path) == []
    merge.upsert_rows(spark.range(2).selectExpr("id AS k", "-id - 1 AS v"), path)
    after_update = files(path)
    touched = merge.compact(spark, path)
    assert 1 <= len(touched) <= 2
    new = [f for f in files(path) if f not in after_update]
    assert {f.split("merge_bucket=")[1].split("/")[0] for f in new} == set(touched)
    assert all(files(path)[f] == t for f, t in before.items())
    used = set(merge.read_merged(spark, path).inputFiles())
    assert len({f.split("merge_bucket=")[1].split("/")[0] for f in used}) == 16
    assert merge.read_merged(spark, path).selectExpr("sum(v)").first()[0] == sum(range(2, 1000)) - 3


def test_of_two_updates_one_loses_and_a_dead_one_is_not_seen(spark, monkeypatch):
    path = work_path(spark, "m")
    merge.create_merged(spark.createDataFrame([], SCHEMA), path, ["a"], 4)
    assert rows(spark, path) == []
    state = merge._state(spark, path)
    merge.upsert_rows(spark.createDataFrame([(1, "p", 1)], SCHEMA), path)
    monkeypatch.setattr(merge, "_state", lambda *args: state)
    with pytest.raises(commits.AlreadyCommitted):
        merge.upsert_rows(spark.createDataFrame([(2, "q", 2)], SCHEMA), path)
    monkeypatch.undo()
    assert rows(spark, path) == [(1, "p", 1)]
