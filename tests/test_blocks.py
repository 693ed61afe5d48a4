import random
from collections import Counter

import pytest

from plotwright.functions import bits
from plotwright.operators import band_index, neighbors
from plotwright.session import work_path


def apart(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def frame(spark, items):
    return spark.createDataFrame([(s,) for s in items], "signature string")


def uneven(seed, n_bits, n):
    """Signatures around few centers, most of whose bits are 0."""
    rnd = random.Random(seed)
    centers = [rnd.getrandbits(n_bits) & rnd.getrandbits(n_bits) & rnd.getrandbits(n_bits) for _ in range(12)]

    def near(x):
        for _ in range(rnd.randint(0, n_bits // 4)):
            x ^= 1 << rnd.randrange(n_bits)
        return x

    return sorted({format(near(rnd.choice(centers)), f"0{-(-n_bits // 4)}x") for _ in range(n)})


@pytest.mark.parametrize("n_bits, similarity", [(16, 0.85), (64, 0.7), (100, 0.8), (256, 0.85), (320, 0.8)])
def test_blocks_and_bands_find_every_pair_once(spark, monkeypatch, n_bits, similarity):
    monkeypatch.setattr(neighbors, "SMALL_BLOCK", 20)
    monkeypatch.setattr(neighbors, "TILE", 16)
    monkeypatch.setattr(neighbors, "BATCH", 7)
    items = uneven(n_bits, n_bits, 220)
    k = bits.max_distance(n_bits, similarity)
    wanted = {(a, b, apart(a, b)) for a in items for b in items if a < b and apart(a, b) <= k}
    rows = frame(spark, [*items, None])
    blocks = neighbors._compared(rows, n_bits, k, len(items), block=30).collect()
    assert wanted and Counter((r.left, r.right, r.distance) for r in blocks) == Counter(wanted)
    bands = neighbors._joined(rows, n_bits, k, len(items), neighbors.band_plan(n_bits, k, 10**6)).collect()
    assert Counter(bands) == Counter(blocks)


def test_blocks_of_near_buckets_only(spark):
    items = uneven(7, 64, 300)
    bucket = {s: int(format(int(s, 16), "064b")[:8][::-1], 2) for s in items}
    wanted = {(a, b) for a in items for b in items if a < b and apart(a, b) <= 12 and bin(bucket[a] ^ bucket[b]).count("1") <= 1}
    found = neighbors._compared(frame(spark, items), 64, 12, len(items), 8, block=16).collect()
    assert wanted and Counter((r.left, r.right) for r in found) == Counter(wanted)


def test_low_similarity_and_uneven_bits_go_by_blocks(spark, monkeypatch):
    """Bands would file each of these under hundreds of keys, or let most pairs meet by chance."""

    def no_bands(*args):
        raise AssertionError("bands")

    monkeypatch.setattr(neighbors, "_joined", no_bands)
    for n_bits, similarity, expected in ((256, 0.85, 200_000), (64, 0.7, 600_000)):
        assert neighbors.near_pairs(frame(spark, uneven(1, n_bits, 60)), n_bits, similarity, expected).count() > 0


def test_random_bits_keep_bands_and_uneven_ones_need_more(spark):
    assert not neighbors.blocks_are_cheaper(64, neighbors.band_plan(64, 9, 10**8), 10**8, 5 * 10**7)
    few = neighbors.band_plan(64, 9, 10**8, 1, 0.3)
    assert neighbors.blocks_are_cheaper(64, few, 10**8, 5 * 10**7, 1, 0.3)
    rnd = random.Random(2)
    even = neighbors._evenness(frame(spark, [f"{rnd.getrandbits(64):016x}" for _ in range(300)]), 64)
    skewed = neighbors._evenness(frame(spark, [f"{rnd.getrandbits(64) & rnd.getrandbits(64) & rnd.getrandbits(64):016x}" for _ in range(300)]), 64)
    assert even > 0.9 and skewed < 0.7


def test_index_without_keys(spark):
    """Where an index would file hundreds of keys a signature it holds the signatures alone."""
    rows = uneven(3, 256, 200)
    random.Random(1).shuffle(rows)
    path = work_path(spark, "index")
    band_index.create_index(spark, path, 256, 0.85, expected=100_000)
    assert band_index._settings(spark, path)["plan"] is None
    for start, stop in ((0, 90), (90, 150), (150, len(rows))):
        given = frame(spark, [*rows[start:stop], *rows[max(0, start - 10) : start], rows[start], None])
        wanted = {(min(a, b), max(a, b)) for a in rows[start:stop] for b in rows[:stop] if a != b and apart(a, b) <= 38}
        found = [(r["left"], r["right"]) for r in band_index.probe(given, path).collect()]
        assert Counter(found) == Counter(wanted)
        band_index.file_signatures(given, path)
    assert band_index.probe(frame(spark, rows), path).count() == 0
