import re
import uuid

import pytest

from plotwright.operators import diff, maintain
from plotwright.session import work_path
from plotwright.sources.buckets import bucket_count, write_bucketed

SCHEMA = "id long, avalaible boolean, archived_date date, price double"


def shuffles(df):
    """Shuffles of the plan as it is before it runs."""
    return len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture(scope="module")
def tables(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    run = uuid.uuid4().hex
    source = [(i, i % 3 > 0, None, float(i)) for i in range(60)] + [(None, True, None, 0.0)]
    target = [(i, i % 2 > 0, None, float(i)) for i in range(20, 70)] + [(None, True, None, 1.0)]
    plain = [spark.createDataFrame(rows, SCHEMA) for rows in (source, target)]
    names = [f"source_{run}", f"target_{run}"]
    yield plain, [write_bucketed(df, n, ["id"], 4, work_path(spark, n)) for df, n in zip(plain, names, strict=True)], names
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_layer_changes_join_bucket_to_bucket(tables):
    (s, t), (bs, bt), _ = tables
    watched = ["avalaible", "archived_date"]
    plain, changes = maintain.layer_changes(s, t, "id", watched), maintain.layer_changes(bs, bt, "id", watched)
    assert shuffles(plain) == 2 and shuffles(changes) == 0
    assert rows(changes) == rows(plain)
    after = maintain.apply_changes(bt, changes, "id", watched)
    assert shuffles(after) == 0
    assert rows(after) == rows(maintain.apply_changes(t, plain, "id", watched))


def test_daily_diff_shuffles_the_feed_at_most(tables):
    (s, t), (bs, bt), _ = tables
    for feed, shuffled in ((bs, 0), (s, 1)):
        for compare in (diff.new_listings, diff.gone_listings):
            found = compare(feed, bt, ["id"])
            assert shuffles(found) <= shuffled
            assert rows(found) == rows(compare(s, t, ["id"]))


def test_bucket_count_and_names(spark, tables):
    (s, _), _, names = tables
    assert bucket_count(spark, names[0]) == 4
    s.createOrReplaceTempView("unbucketed")
    assert bucket_count(spark, "unbucketed") is None
    with pytest.raises(Exception, match="already exists"):
        write_bucketed(s, names[0], ["id"], 4, work_path(spark, "again"))
