import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plotwright.functions import bits, grids
from plotwright.operators import duplicates as dups
from plotwright.operators import neighbors


def apart(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def signatures(seed, n_bits, n):
    rnd = random.Random(seed)
    centers = [rnd.getrandbits(n_bits) for _ in range(12)]

    def near(x):
        for _ in range(rnd.randint(0, n_bits // 4)):
            x ^= 1 << rnd.randrange(n_bits)
        return x

    return sorted({format(near(rnd.choice(centers)), f"0{n_bits // 4}x") for _ in range(n)})


def frame(spark, items):
    return spark.createDataFrame([(s,) for s in items], "signature string")


@pytest.mark.parametrize(
    "n_bits, similarity, expected, hot",
    [(64, 0.85, None, 5000), (64, 0.7, 10**7, 20), (16, 0.85, None, 10), (256, 0.85, None, 5000), (256, 0.9, 10**6, 20)],
)
def test_pairs_are_exact_and_single(spark, n_bits, similarity, expected, hot):
    items = signatures(n_bits, n_bits, 200)
    k = bits.max_distance(n_bits, similarity)
    wanted = {(a, b, apart(a, b)) for a in items for b in items if a < b and apart(a, b) <= k}
    found = neighbors.near_pairs(frame(spark, items), n_bits, similarity, expected, hot).collect()
    assert Counter((r.left, r.right, r.distance) for r in found) == Counter(wanted)


def test_distance_of_cut_off():
    assert bits.max_distance(256, 0.85) == 38
    assert bits.max_distance(64, 0.85) == 9
    assert bits.max_distance(20, 0.9) == 2


def test_more_signatures_get_wider_bands():
    few, many = neighbors.band_plan(256, 38, 10**3), neighbors.band_plan(256, 38, 10**9)
    assert len(many) < len(few)
    for plan in (few, many):
        assert sum(w for _, w, _ in plan) == 256
        assert sum(r + 1 for _, _, r in plan) == 38 + 1


def test_lsh_keeps_near_buckets_only(spark):
    items = signatures(5, 16, 300)

    def bucket(s):
        return int(format(int(s, 16), "016b")[:8][::-1], 2)

    wanted = {
        (a, b) for a in items for b in items if a != b and apart(a, b) <= 2 and bin(bucket(a) ^ bucket(b)).count("1") <= 1
    }
    found = neighbors.lsh_pairs(frame(spark, items), 16, 0.85).collect()
    assert Counter((r.left, r.right) for r in found) == Counter(wanted)


def images(seed, n):
    """(listing, signature): a third of the images are copies of one signature."""
    rnd = random.Random(seed)
    pool = signatures(seed, 16, 80)
    return [(rnd.randrange(n // 2), pool[0] if rnd.random() < 0.33 else rnd.choice(pool)) for _ in range(n)]


def listing_pairs(rows, k):
    best = {}
    for a, x in set(rows):
        for b, y in set(rows):
            if a != b and apart(x, y) <= k:
                best[a, b] = min(best.get((a, b), 99), apart(x, y))
    return best


def test_nearest_with_many_copies(spark):
    rows = images(7, 120)
    df = spark.createDataFrame(rows, "listing long, signature string")
    of = defaultdict(list)
    for (a, b), d in listing_pairs(rows, 2).items():
        of[a].append((d, b))
    wanted = {(a, b, d, i) for a, found in of.items() for i, (d, b) in enumerate(sorted(found)[:4], 1)}
    found = neighbors.nearest(df, "listing", "signature", 16, 0.85, 4).collect()
    assert {(r.key, r.neighbor, r.distance, r.rank) for r in found} == wanted


def test_duplicates_include_equal_signatures(spark):
    rows = images(9, 60) + [(900, "abcd"), (901, "abcd")]
    df = spark.createDataFrame(rows, "listing long, signature string")
    pairs = neighbors.near_pairs(neighbors.signature_groups(df, "listing", "signature"), 16, 0.85)
    wanted = df.select(F.col("listing").alias("key"))
    found = dups.duplicates_of(wanted, df, "listing", "signature", pairs).collect()
    assert Counter((r.key, r.duplicate) for r in found) == Counter(list(listing_pairs(rows, 2)))
    assert (900, 901) in {(r.key, r.duplicate) for r in found}


def test_counts_per_signature(spark):
    rows = images(11, 60)
    df = spark.createDataFrame(rows, "listing long, signature string")
    carriers = defaultdict(set)
    for listing, s in rows:
        carriers[s].add(listing)
    pairs = neighbors.near_pairs(neighbors.signature_groups(df, "listing", "signature"), 16, 0.85)
    found = {r.signature: (r.n_copies, r.n_near) for r in dups.duplicate_counts(df, "listing", "signature", pairs).collect()}
    assert found == {
        s: (len(c) - 1, sum(len(o) for t, o in carriers.items() if t != s and apart(s, t) <= 2)) for s, c in carriers.items()
    }


def test_adjacency_pages_hold_everything(spark):
    edges = [("hub", f"n{i:03}") for i in range(250)] + [("n001", "n002")]
    lists = dups.adjacency(spark.createDataFrame(edges, "left string, right string"), page=40).collect()
    of = defaultdict(list)
    for r in lists:
        of[r.id] += r.neighbors
        assert len(r.neighbors) < 100
    assert sorted(of["hub"]) == sorted(b for a, b in edges if a == "hub")
    assert sorted(of["n001"]) == ["hub", "n002"] and sorted(of["n002"]) == ["hub", "n001"]


def test_small_adjacency(spark):
    lists = dups.adjacency(spark.createDataFrame([(1, 2), (2, 3)], "left long, right long")).collect()
    assert {r.id: r.neighbors for r in lists} == {1: [2], 2: [1, 3], 3: [2]}


def test_report_keeps_missing_duplicates(spark):
    entries = spark.createDataFrame([(1, "u1"), (2, "u2")], "internal_id long, url string")
    pairs = spark.createDataFrame([(1, 2), (1, 9), (2, 1)], "key long, duplicate long")
    rows = dups.duplicate_report(entries, pairs, "internal_id", ["url"], 1).collect()
    assert {(r.key, r.duplicate, r.n_duplicates, r.duplicate_url, r.found) for r in rows} == {
        (1, 2, 2, "u2", True),
        (1, 9, 2, None, False),
    }


def test_hash_codes(spark):
    df = spark.createDataFrame([("a0" + "0" * 62,), ("0f" + "0" * 62,), ("1",), ("no hex",), (None,)], "s string")
    rows = df.select("s", bits.bits(F.col("s")).alias("b"), bits.bucket(bits.bits(F.col("s"))).alias("k")).collect()
    assert [r.k for r in rows] == [5, 240, 0, 0, 0]
    assert rows[2].b == "0" * 255 + "1" and rows[3].b == "0" * 256
    near = df.select(bits.neighbor_buckets(bits.bucket(bits.bits(F.col("s")))).alias("n")).first().n
    assert sorted(near) == sorted([5] + [5 ^ (1 << i) for i in range(8)])


def test_similarity_and_bytes(spark):
    df = spark.createDataFrame([("ffff0000ffff0000", "ffff0000ffff0001")], "a string, b string")
    a, b = (bits.words(F.col(c), 64) for c in "ab")
    row = df.select(
        bits.similarity(a, b, 64).alias("s"),
        bits.from_bytes(bits.to_bytes(F.col("b"), 64), 64).alias("same"),
        bits.from_bytes(bits.to_bytes(F.col("b"), 64), 72).alias("longer"),
        bits.from_bytes(bits.to_bytes(F.col("b"), 64), 8).alias("shorter"),
        bits.bits(F.col("b"), 64).alias("b"),
    ).first()
    assert row.s == 0.984375
    assert (row.same, row.longer, row.shorter) == (row.b, row.b + "0" * 8, row.b[:8])


def test_grid_signatures_of_a_ramp(spark):
    ramp = [float(i) for i in range(64)]
    df = spark.createDataFrame([(ramp,), (None,)], "g array<double>")
    found = {k: [r[0] for r in df.select(grids.grid_signature(F.col("g"), 8, s, k)).collect()] for k, s in
             (("ahash", 8), ("dhash", 8), ("whash", 4), ("phash", 4))}
    assert found["ahash"][0] == "0" * 32 + "1" * 32
    assert found["dhash"][0] == "1" * 64
    small = df.select(grids.grid_signature(F.col("g"), 8, 4, "dhash")).first()[0]
    assert small == "1" * 16
    with pytest.raises(ValueError):
        grids.grid_signature(F.col("g"), 8, 8, "other")
    assert found["whash"][0] == "0" * 8 + "1" * 8
    assert len(found["phash"][0]) == 16 and found["phash"][1] is None
