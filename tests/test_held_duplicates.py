import random

from plotwright.checks import queries


def test_crowded_and_lone_signatures_are_expanded(spark, tmp_path):
    """60 listings with one signature, and two that only have each other."""
    rnd = random.Random(4)
    crowd, two = ([rnd.uniform(-1, 1) for _ in range(64)] for _ in range(2))
    ids = [0, *range(5, 63), 100, 200, 201]
    rows = [(2 * n + k, two if n >= 200 else crowd, 0) for n in ids for k in range(2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    pages = [(n, f"https://x.org/{n}") for n in (0, 7, 100, 200)] + [(8, "http://x.org/8")]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    expected = {(a, b) for a in (0, 7, 100) for b in ids[:60] if a != b} | {(200, 201)}

    got = queries()["duplicates_of_held"](spark, str(tmp_path)).collect()
    assert sorted((r["key"], r["duplicate"]) for r in got) == sorted(expected)
    report = queries()["dup_report_held"](spark, str(tmp_path)).collect()
    assert sorted((r["key"], r["duplicate"]) for r in report) == sorted(expected)
    assert all(r["n_duplicates"] == (1 if r["key"] == 200 else 59) and r["found"] == (r["duplicate"] in (0, 7, 100, 200)) for r in report)
    wanted = queries()["duplicates_of"](spark, str(tmp_path)).collect()
    every = {(a, b) for a in ids[:60] for b in ids[:60] if a != b} | {(200, 201), (201, 200)}
    assert sorted((r["key"], r["duplicate"]) for r in wanted) == sorted(every)


def test_the_report_takes_the_first_of_all_listings(spark, tmp_path):
    """No listing here has an id divisible by 100; the third of the first 10 is not held."""
    rnd = random.Random(5)
    vector = [rnd.uniform(-1, 1) for _ in range(64)]
    rows = [(2 * n + k, vector, 0) for n in range(1, 21) for k in range(2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    pages = [(n, f"https://x.org/{n}") for n in range(1, 21) if n != 3]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    report = queries()["dup_report"](spark, str(tmp_path)).collect()
    expected = {(a, b, 19, b != 3) for a in range(1, 11) for b in range(1, 21) if a not in (3, b)}
    assert sorted((r["key"], r["duplicate"], r["n_duplicates"], r["found"]) for r in report) == sorted(expected)
