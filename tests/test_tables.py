import datetime as dt

import pytest
from pyspark.sql import functions as F

from plotwright.operators import diff, maintain, photos, runlog, select
from plotwright.operators.conform import with_internal_id
from plotwright.schemas import LISTING, RUN_LOG
from plotwright.session import materialized, shared_dir, work_path
from plotwright.sources import sinks, tables
from plotwright.sources.payload import flatten_json

DAY = dt.date(2024, 5, 2)


def ids(df, column="site_id"):
    return sorted(r[column] for r in df.collect())


@pytest.fixture
def held(spark):
    archived = dt.date(2024, 1, 1)
    rows = [("b", 2, True, None), ("c", 3, True, None), ("d", 4, False, archived)]
    return spark.createDataFrame(rows, "site_id string, internal_id long, avalaible boolean, archived_date date")


def test_diff_modes(spark, held):
    feed = spark.createDataFrame([("a",), ("b",), ("b",)], "site_id string")
    for compare in ("active", "all"):
        assert ids(diff.new_listings(feed, held, ["site_id"], compare)) == ["a"]
    assert ids(diff.gone_listings(feed, held, ["site_id"], "active")) == ["c"]
    assert ids(diff.gone_listings(feed, held, ["site_id"], "all")) == ["c", "d"]
    relisted = spark.createDataFrame([("d",)], "site_id string")
    assert ids(diff.new_listings(relisted, held, ["site_id"], "active")) == ["d"]
    assert ids(diff.new_listings(relisted, held, ["site_id"], "all")) == []
    with pytest.raises(ValueError):
        diff.new_listings(feed, held, ["site_id"], "some")


def test_archive_marks_only_the_gone(spark, held):
    gone = spark.createDataFrame([("c",), ("c",)], "site_id string")
    out = {r.site_id: (r.avalaible, r.archived_date) for r in diff.archive(held, gone, ["site_id"], F.lit(DAY)).collect()}
    assert out == {"b": (True, None), "c": (False, DAY), "d": (False, dt.date(2024, 1, 1))}


def test_price_changes_need_the_day_before(spark):
    before, gap = DAY - dt.timedelta(days=1), DAY + dt.timedelta(days=2)
    rows = [(1, 100.0, before), (2, 200.0, before), (3, 300.0, before), (1, 100.0, DAY), (2, 250.0, DAY), (4, 400.0, DAY), (2, 1.0, gap)]
    snapshots = spark.createDataFrame(rows, "internal_id long, price double, snapshot_date date")
    found = [tuple(r) for r in diff.price_changes(snapshots).collect()]
    assert found == [(2, 200.0, 250.0, DAY)]
    assert diff.price_changes(snapshots, [gap]).count() == 0
    assert diff.price_changes(snapshots, [DAY, gap]).count() == 1


def test_price_changes_of_a_day_read_two_partitions(spark):
    path = work_path(spark, "prices")
    rows = [(i, float(i + d), DAY + dt.timedelta(days=d)) for i in range(3) for d in range(5)]
    sinks.append(spark.createDataFrame(rows, "internal_id long, price double, snapshot_date date"), path, ["snapshot_date"])
    found = diff.price_changes(spark.read.parquet(path), [DAY + dt.timedelta(days=4)])
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) >= 2 and all("snapshot_date" in f.split("PartitionFilters: [")[1].split("]")[0] for f in filters)
    newest = tables.read_latest_snapshot(spark, path)
    assert {r.snapshot_date for r in newest.collect()} == {DAY + dt.timedelta(days=4)}
    assert sinks.drop_days(spark, path, str(DAY + dt.timedelta(days=3))) == [str(DAY + dt.timedelta(days=d)) for d in range(3)]
    assert spark.read.parquet(path).select("snapshot_date").distinct().count() == 2


def test_old_versions_go(spark):
    path = work_path(spark, "versions")
    for version in (1, 2, 10):
        sinks.publish(spark.range(version), path, version)
    assert sinks.read_latest(spark, path).count() == 10
    assert sinks.drop_versions(spark, path, keep=1) == ["1", "2"]
    assert tables.partition_values(spark, path, "version") == ["10"]


def test_ledger_keeps_line_breaks_and_quotes(spark):
    path = work_path(spark, "ledger")
    message = 'Traceback "most recent":\n  File "a.py", line 1\n\nValueError: x, y'
    failures = spark.createDataFrame([("1", message), ("2", None)], "internal_id string, error_message string")
    sinks.record_failures(failures, path)
    found = {r.internal_id: r.error_message for r in sinks.read_failures(spark, path, failures.schema).collect()}
    assert found == {"1": message, "2": None}


def test_ids_that_meet_are_hashed_anew(spark):
    rows = [(1, "a", DAY), (1, "b", DAY), (1, None, DAY), (1, None, DAY + dt.timedelta(days=1))]
    new = spark.createDataFrame(rows, "source_id int, site_id string, added_date date").withColumn("internal_id", F.lit(None).cast("long"))
    plain = {r.site_id: r.internal_id for r in with_internal_id(new).collect()}
    held = spark.createDataFrame([(plain["a"],)], "internal_id long")
    again = with_internal_id(new, held).collect()
    assert len({r.internal_id for r in again} | {plain["a"]}) == 5
    assert {r.internal_id for r in again if r.site_id == "b"} == {plain["b"]}


def test_sellers_without_columns_give_none(spark, held):
    sellers = spark.createDataFrame([], "internal_id long, agent_name string, agent_phone string, agent_email string, added_date date")
    feed = spark.createDataFrame([("b",)], "site_id string")
    assert diff.new_sellers(feed, held, sellers, F.lit(DAY)).count() == 0


def test_new_sellers(spark, held):
    sellers = spark.createDataFrame([(2, "n", "p", "old@x", DAY)], "internal_id long, agent_name string, agent_phone string, agent_email string, added_date date")
    rows = [("b", "n", "p", "old@x"), ("b", "n", "p", "new@x"), ("c", None, "p", "new@x"), ("z", "n", "p", "new@x")]
    feed = spark.createDataFrame(rows, "site_id string, agent_name string, agent_phone string, agent_email string")
    assert [(r.internal_id, r.agent_email) for r in diff.new_sellers(feed, held, sellers, F.lit(DAY)).collect()] == [(2, "new@x")]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, w int")
    updates = spark.createDataFrame([(2, "x", None), (9, "y", 1)], "k long, v string, w int")
    once = maintain.upsert_columns(target, updates, ["k"], ["v", "w"])
    twice = maintain.upsert_columns(once, updates, ["k"], ["v", "w"])
    assert sorted(map(tuple, once.collect()), key=str) == [(1, "a", 1), (2, "x", None)]
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_sync_twice_changes_nothing_more(spark):
    source = spark.createDataFrame([(1, True, None), (2, False, DAY), (3, True, None)], "internal_id long, avalaible boolean, archived_date date")
    target = spark.createDataFrame([(1, True, None, "r"), (2, True, None, None), (7, True, None, "s")],
                                   "internal_id long, avalaible boolean, archived_date date, region string")
    watched = ["avalaible", "archived_date"]
    changes = maintain.layer_changes(source, target, "internal_id", watched)
    assert sorted((r.internal_id, r.action) for r in changes.collect()) == [(2, "update"), (3, "insert")]
    synced = maintain.apply_changes(target, changes, "internal_id", watched)
    assert sorted(tuple(r) for r in synced.collect()) == [
        (1, True, None, "r"), (2, False, DAY, None), (3, True, None, None), (7, True, None, "s")]
    again = maintain.layer_changes(source, synced, "internal_id", watched)
    assert again.count() == 0
    assert tuple(maintain.change_summary(again, "geo").first())[1:] == (0, 0)


def test_retention_and_latest(spark):
    days = [DAY - dt.timedelta(days=i) for i in range(4)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    assert ids(maintain.retain(df, F.lit(DAY)), "snapshot_date") == [days[1], days[0]]
    assert ids(tables.latest_snapshot(df), "snapshot_date") == [DAY]
    with pytest.raises(ValueError):
        tables.latest_snapshot(df.limit(0))


def test_versions_and_partitions(spark):
    path = work_path(spark, "t")
    sinks.publish(spark.range(3), path, 1)
    sinks.publish(sinks.read_latest(spark, path).where("id > 0"), path, 2)
    assert ids(sinks.read_latest(spark, path), "id") == [1, 2]
    with pytest.raises(Exception):
        sinks.publish(spark.range(1), path, 2)
    path = work_path(spark, "p")
    sinks.replace_partition(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int"), path, "day")
    sinks.replace_partition(spark.createDataFrame([("d2", 3)], "day string, v int"), path, "day")
    assert sorted((r.day, r.v) for r in spark.read.parquet(path).collect()) == [("d1", 1), ("d2", 3)]


def test_catalog_tables(spark):
    like = spark.createDataFrame([(1, "a")], "id int, `long name` string")
    for name in ("hyper_20240501", "hyper_20240502", "hyper_old"):
        tables_before = tables.table_exists(spark, name)
        sinks.ensure_table(spark, name, like)
        sinks.ensure_table(spark, name, like)
        assert not tables_before and tables.table_exists(spark, name)
    assert tables.latest_table(spark, "hyper") == "hyper_20240502"
    sinks.append_table(like, "hyper_20240502")
    assert spark.table("hyper_20240502").count() == 1
    with pytest.raises(ValueError):
        tables.latest_table(spark, "idnes")
    assert tables.column_exists(like, "id") and not tables.column_exists(like, "x")
    assert tables.empty_like(like).schema == like.schema


def test_ledger(spark):
    failures = spark.createDataFrame([("t", "1", "u,1", "idnes", 'bad "x"'), ("t", "1", "u2", "idnes", "e"), ("t", "2", "u3", "idnes", "e")],
                                     "timestamp string, internal_id string, url string, source_column string, error_message string")
    path = work_path(spark, "ledger")
    sinks.record_failures(failures, path)
    sinks.record_failures(failures, path)
    csv = spark.read.schema(failures.schema).option("header", True).csv(f"{path}/csv")
    json = spark.read.schema(failures.schema).json(f"{path}/json")
    for ledger in (csv, json):
        assert {(r.internal_id, r.n_failures) for r in runlog.failure_counts(ledger).collect()} == {("1", 4), ("2", 2)}
    assert runlog.failures_of(json, "2").count() == 2


def test_ledger_of_repeated_runs(spark):
    schema = "timestamp string, internal_id string, url string, source_column string, error_message string"
    one = spark.createDataFrame([("t", "1", "u1", "idnes", "first\nsecond"), ("t", "2", "u2", None, None)], schema)
    two = spark.createDataFrame([("t", "1", "u1", "idnes", "e")], schema)
    path = work_path(spark, "ledger")

    def kept():
        csv = sinks.read_failures(spark, path, one.schema)
        json = spark.read.schema(one.schema).json(f"{path}/json").select(*one.columns)
        found = [sorted((tuple(r) for r in df.collect()), key=repr) for df in (csv, json)]
        assert found[0] == found[1]
        return found[0]

    def rows(*frames):
        return sorted((tuple(r) for df in frames for r in df.collect()), key=repr)

    sinks.record_failures(one, path, "20240501_060000")
    sinks.record_failures(two, path, "20240502_060000")
    sinks.record_failures(one, path, "20240501_060000")
    assert kept() == rows(one, two)
    sinks.record_failures(two, path, "20240501_060000")
    assert kept() == rows(two, two)
    sinks.record_failures(two.limit(0), path, "20240501_060000")
    assert kept() == rows(two)
    sinks.record_failures(two.limit(0), path, "20240503_060000")
    assert kept() == rows(two)


def test_run_log(spark):
    log = runlog.run_log("p", "t", F.current_timestamp(), spark.range(3), spark.range(2), spark.range(0))
    assert log.columns == RUN_LOG.names
    assert tuple(log.first())[3:9] == (3, 2, 3, 2, 0, "success")


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_row_numbers_without_a_single_task(spark, partitions):
    df = spark.createDataFrame([(i * i,) for i in range(100)], "id long").repartition(5)
    found = select.numbered(df, "id", partitions).orderBy("id").collect()
    assert [r.row_no for r in found] == list(range(100))
    found = select.batches(df, "id", 30, partitions).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [tuple(r) for r in found] == [(0, 30), (1, 30), (2, 30), (3, 10)]


def test_sample_repeats(spark):
    df = spark.range(1000)
    first, second = (ids(select.sample(df.repartition(n), "id", 10, seed=3), "id") for n in (2, 7))
    assert len(first) == 10 and first == second != ids(select.sample(df, "id", 10, seed=4), "id")


def test_photo_links_by_listing(spark):
    feed = spark.createDataFrame([("a", ["u1", "u2", "u1", ""]), ("b", ["u3"])], "site_id string, items array<string>")
    active = spark.createDataFrame([(1, "a"), (2, "b")], "internal_id long, site_id string")
    held = spark.createDataFrame([(1, "u1")], "internal_id long, photo_url string")
    by_url = {(r.internal_id, r.photo_url) for r in photos.photo_links(feed, active, held).collect()}
    by_listing = {(r.internal_id, r.photo_url) for r in photos.photo_links(feed, active, held, per="listing").collect()}
    assert by_url == {(1, "u2"), (2, "u3")} and by_listing == {(2, "u3")}


def test_flatten_nested_payload(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StructType([T.StructField("c", T.LongType())]))])
    df = spark.createDataFrame([(1, '{"a":"x","b":{"c":3}}'), (2, "broken")], "id int, data string")
    out = flatten_json(df, "data", schema)
    assert out.columns == ["id", "a", "b.c"] and sorted(map(tuple, out.collect()))[0] == (1, "x", 3)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    out = materialized(spark.range(5), "five")
    assert out.count() == 5 and out.dtypes == spark.range(5).dtypes
    assert all(shared_dir(spark) in f for f in out.inputFiles())


def test_schema_has_26_columns():
    assert len(LISTING.fields) == 26


@pytest.mark.parametrize("limit", [0, 1, 40, 99, 100, 250])
def test_long_heads_stay_in_their_ranges(spark, monkeypatch, limit):
    monkeypatch.setattr(select, "ONE_TASK_ROWS", 0)
    rows = [(i % 7, i, None if i % 5 else "x") for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(5)
    head = select.first_rows(df, ["a", "b"], limit)
    assert sorted(map(tuple, head.collect()), key=str) == sorted(sorted(rows, key=lambda r: r[:2])[:limit], key=str)
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert limit == 0 or ("TakeOrdered" not in plan and "GlobalLimit" not in plan and "SinglePartition" not in plan.split("Window")[0])


def test_queue_longer_than_a_task(spark, monkeypatch):
    monkeypatch.setattr(select, "ONE_TASK_ROWS", 3)
    df = spark.createDataFrame([(i, None if i % 2 else "d") for i in range(40)], "k int, done string")
    assert sorted(r.k for r in select.pending(df, "done", ["k"], 10).collect()) == list(range(1, 20, 2))
