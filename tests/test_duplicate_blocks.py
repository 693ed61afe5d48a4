import random

from plotwright.operators import duplicates as dups


def _plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def _case(spark, n=400):
    """Listings with up to three signatures out of ten, near to the next one each; a crowd under the first."""
    rnd = random.Random(6)
    carried = {(f"k{i}", f"s{s}") for i in range(n) for s in {0 if i % 4 == 0 else rnd.randrange(10) for _ in range(1 + i % 3)}}
    near = [(f"s{i}", f"s{i + 1}") for i in range(8)]
    rows = [*carried, *list(carried)[:50], ("k1", None), (None, "s1"), ("alone", "s99")]
    images = spark.createDataFrame(rows, "listing string, signature string")
    pairs = spark.createDataFrame([*near, near[0]], "left string, right string")
    wanted = spark.createDataFrame([(f"k{i}",) for i in range(0, n, 2)] * 2 + [("alone",), ("none",), (None,)], "key string")
    reach = {s: {s} | {b for a, b in near if a == s} | {a for a, b in near if b == s} for s in {s for _, s in carried}}
    carriers = {}
    for key, s in carried:
        carriers.setdefault(s, set()).add(key)
    expected = {(k, d) for k, s in carried if int(k[1:]) % 2 == 0 for r in reach[s] for d in carriers.get(r, ()) if d != k}
    return images, pairs, wanted, expected


def test_many_duplicates_are_expanded_by_several_tasks(spark):
    images, pairs, wanted, expected = _case(spark)
    found = dups.duplicates_of(wanted, images, "listing", "signature", pairs)
    assert found.rdd.glom().map(lambda rows: len(rows) > 0).collect().count(True) > 1
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(expected) and set(rows) == expected


def test_blocks_and_joins_find_the_same(spark, monkeypatch):
    images, pairs, wanted, expected = _case(spark, 60)
    carriers = dups.listing_groups(images, "listing", "signature")
    mine = carriers.join(wanted.distinct(), "key").withColumnRenamed("signature", "left")
    edges = dups.both_ways(pairs)
    monkeypatch.setattr(dups, "PAGE", 7)
    for found in (dups._reached(mine, edges, carriers), *(dups._expanded(mine, edges, carriers, a, b) for a, b in ((1, 1), (3, 2), (70, 3)))):
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(expected) and set(rows) == expected


def test_few_duplicates_are_joined(spark):
    images = spark.createDataFrame([(i, f"s{i // 2}") for i in range(40)], "listing long, signature string")
    pairs = spark.createDataFrame([("s0", "s1")], "left string, right string")
    found = dups.duplicates_of(spark.range(3).toDF("key"), images, "listing", "signature", pairs)
    assert "FlatMapGroupsInArrow" not in _plan(found)
    assert sorted(map(tuple, found.collect())) == [(0, 1), (0, 2), (0, 3), (1, 0), (1, 2), (1, 3), (2, 0), (2, 1), (2, 3)]


def test_no_images_and_no_pairs(spark):
    images = spark.createDataFrame([], "listing long, signature string")
    pairs = spark.createDataFrame([], "left string, right string")
    assert dups.duplicates_of(spark.range(3).toDF("key"), images, "listing", "signature", pairs).collect() == []
