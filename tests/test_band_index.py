import random

import pytest
from pyspark.sql import functions as F

from plotwright.operators import band_index
from plotwright.session import work_path
from plotwright.sources.commits import AlreadyCommitted


def signatures(seed, number, n_bits, flips):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(n_bits) for _ in range(8)]
    out = set()
    while len(out) < number:
        x = rnd.choice(centres)
        for _ in range(rnd.randrange(flips)):
            x ^= 1 << rnd.randrange(n_bits)
        out.add(f"{x:0{n_bits // 4}x}")
    return sorted(out, key=lambda s: rnd.random())


def table(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "signature string")


def near(some, others, k):
    pairs = {(min(a, b), max(a, b)) for a in some for b in others if a != b}
    return sorted(p for p in pairs if bin(int(p[0], 16) ^ int(p[1], 16)).count("1") <= k)


@pytest.mark.parametrize("n_bits, similarity, k, flips", [(64, 0.9, 6, 9), (32, 0.85, 4, 5)])
def test_new_against_stored_as_brute_force(spark, n_bits, similarity, k, flips):
    rows = signatures(n_bits, 240, n_bits, flips)
    path = work_path(spark, "index")
    band_index.create_index(spark, path, n_bits, similarity, expected=10_000, parts=16)
    for start, stop in ((0, 100), (100, 180), (180, 240)):
        given = table(spark, rows[start:stop] + rows[max(0, start - 20) : start] + [rows[start], None])
        found = [(r["left"], r["right"]) for r in band_index.probe(given, path).collect()]
        assert sorted(found) == near(rows[start:stop], rows[:stop], k)
        band_index.file_signatures(given, path)
    assert band_index.probe(table(spark, rows), path).count() == 0
    assert band_index.probe(table(spark, []), path).count() == 0


def test_only_probed_parts_are_read(spark):
    rows = signatures(3, 200, 64, 12)
    path = work_path(spark, "index")
    band_index.create_index(spark, path, 64, 0.95, expected=200, parts=64)
    band_index.file_signatures(table(spark, rows[1:]), path)
    made = band_index._settings(spark, path)
    keys = band_index._filed(table(spark, rows[:1]), made, True)
    parts = sorted({r["part"] for r in keys.select("part").collect()})
    stored = band_index.stored_entries(spark, path, parts)
    read = {f.split("part=")[1].split("/")[0] for f in stored.where("true").select("signature").inputFiles()}
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert len(parts) < 64 and "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["part"] for r in stored.select("part").distinct().collect()} <= set(parts) and read
    found = [(r["left"], r["right"]) for r in band_index.probe(table(spark, rows[:1]), path).collect()]
    assert sorted(found) == near(rows[:1], rows, made["k"])


def test_a_dead_filing_is_not_seen_and_one_of_two_loses(spark, monkeypatch):
    rows = signatures(5, 40, 64, 6)
    path = work_path(spark, "index")
    band_index.create_index(spark, path, 64, 0.9, expected=100)
    with pytest.raises(AlreadyCommitted):
        band_index.create_index(spark, path, 64, 0.9, expected=100)
    commit = band_index.commit

    def dies(*args):
        raise RuntimeError("dead")

    monkeypatch.setattr(band_index, "commit", dies)
    with pytest.raises(RuntimeError):
        band_index.file_signatures(table(spark, rows), path)
    monkeypatch.setattr(band_index, "commit", commit)
    assert band_index.unseen(table(spark, rows), path).count() == 40
    assert band_index.file_signatures(table(spark, rows[:20]), path) == 1
    assert band_index.unseen(table(spark, rows).where(F.col("signature").isNotNull()), path).count() == 20
