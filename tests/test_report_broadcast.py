from plotwright.operators import duplicates as dups


def _plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_duplicates_of_a_report_are_not_shuffled(spark, monkeypatch):
    """Entry 3 is named twice, 4 has no details, 7 and 9 are not held."""
    entries = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "cc"), (4, None), (None, "n")], "id long, url string")
    pairs = [(1, 2), (1, 3), (1, 9), (2, 1), (3, 1), (4, 7), (7, 4)]
    duplicates = spark.createDataFrame(pairs, "key long, duplicate long")
    urls = {1: ["a"], 2: ["b"], 3: ["c", "cc"], 4: [None]}
    counts = {k: sum(a == k for a, _ in pairs) for k, _ in pairs}
    expected = [(d, k, counts[k], own, other, d in urls) for k, d in pairs for own in urls.get(k, []) for other in urls.get(d, [None])]
    order = lambda rows: sorted(map(str, rows))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = dups.duplicate_report(entries, duplicates, "id", ["url"])
        assert report.columns == ["duplicate", "key", "n_duplicates", "own_url", "duplicate_url", "found"]
        assert "hashpartitioning" not in _plan(report)
        assert order(map(tuple, report.collect())) == order(expected)
        monkeypatch.setattr(dups, "BROADCAST_BYTES", 0)
        report = dups.duplicate_report(entries, duplicates, "id", ["url"])
        assert "hashpartitioning" in _plan(report) and "Broadcast" not in _plan(report)
        assert order(map(tuple, report.collect())) == order(expected)
        first = dups.duplicate_report(entries, duplicates, "id", ["url"], 1)
        assert order(map(tuple, first.collect())) == order(r for r in expected if r[1] == 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
