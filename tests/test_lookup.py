from pyspark.sql import functions as F

from plotwright.operators.lookup import ASKED, distinct_keys, lookup_join


def test_hot_missing_and_null_keys(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}", "x") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, c string")
    answers = distinct_keys(df, ["k"]).withColumn(
        "v", F.when(F.col("k").isNull(), "none").when(F.col("k") != "k5", F.upper("k"))
    )
    expected = {(i, None if k == "k5" else "none" if k is None else k.upper()) for i, k, _ in rows}
    for hot_keys in (1, 2, 1000):
        found = lookup_join(df, answers, ["k"], hot_keys=hot_keys).collect()
        assert len(found) == len(rows) and {(r.id, r.v) for r in found} == expected


def test_rows_without_need_stay_empty(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "a", False), (3, "b", None)], "id long, k string, needed boolean")
    answers = spark.createDataFrame([("a", "A", 2), ("b", "B", 1)], f"k string, v string, {ASKED} long")
    for hot_keys in (1, 1000):
        found = lookup_join(df, answers, ["k"], F.col("needed"), hot_keys).collect()
        assert {(r.id, r.v) for r in found} == {(1, "A"), (2, None), (3, None)}


def test_two_key_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, None, None)], "id long, x string, y string")
    answers = distinct_keys(df, ["x", "y"]).withColumn("v", F.concat_ws("-", F.lit("v"), "x", "y"))
    found = lookup_join(df, answers, ["x", "y"], hot_keys=1).collect()
    assert {(r.id, r.v) for r in found} == {(1, "v-a"), (2, "v-a-b"), (3, "v")}
