import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwright.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors):
    """Straight from the definition, in whole numbers."""
    scaled = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        scaled.append((n, i, label, [math.floor(256 * x) for x in v]))
    out = []
    for n, i, label, v in scaled:
        if not anchors(i):
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=True)), j, g) for m, j, g, w in scaled if m != n and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scores if s[2] == label][:5]:
            hard = [s for s in scores if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(i, j, k + 1, x, p, s) for k, (s, x, _) in enumerate(hard)]
    return sorted(out)


def mined(frame, rows, **settings):
    out = N.hard_negatives(frame(rows, SCHEMA), F.col("vec_id") % 10 == 0, **settings)
    return sorted(tuple(r) for r in out.collect())


def some_rows(seed, number, size=8, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(size)
    return [(i, (centre + spread * rng.standard_normal(size)).tolist(), int(rng.integers(3))) for i in range(number)]


@pytest.mark.parametrize("spread", [0.2, 1.0, 5.0])
@pytest.mark.parametrize("bucket_rows", [40, 4096])
def test_as_brute_force(frame, spread, bucket_rows):
    rows = some_rows(4, 300, spread=spread)
    assert mined(frame, rows, bucket_rows=bucket_rows) == brute(rows, lambda i: i % 10 == 0)


def test_ties_copies_and_repeated_ids(frame):
    rnd = random.Random(1)
    rows = [(rnd.randrange(60), [float(rnd.randrange(1, 3)), float(rnd.randrange(1, 3))], rnd.randrange(3)) for _ in range(150)]
    assert mined(frame, rows, bucket_rows=20) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows_take_no_part(frame):
    rows = some_rows(5, 80, 4, 0.3)
    odd = [(None, [1.0] * 4, 1), (10, None, 1), (20, [1.0, None, 1.0, 1.0], 1), (30, [1.0, math.nan, 1.0, 1.0], 2), (40, [math.inf] * 4, 0), (50, [1.0] * 4, None)]
    other = [(60, [0.0] * 4, 1), (61, [0.0] * 4, 2), (70, [], 1), (71, [], 1), (72, [], 2), (90, [1.0, 2.0], 1), (91, [2.0, 1.0], 1), (92, [1.0, 1.0], 2)]
    assert mined(frame, rows + odd + other) == brute(rows + odd + other, lambda i: i % 10 == 0)
    assert mined(frame, rows + [(100, [1e300] * 4, 1)]) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_are_exact(frame):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.random(6) * 2**18).tolist(), int(rng.integers(2))) for i in range(60)]
    assert mined(frame, rows) == brute(rows, lambda i: i % 10 == 0)


def test_no_rows_no_anchors_and_clashing_columns(frame):
    assert mined(frame, []) == []
    assert mined(frame, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    given = frame([(i, v, g, 1, 2) for i, v, g in some_rows(6, 40)], SCHEMA + ", bucket int, rank int")
    assert sorted(tuple(r) for r in N.hard_negatives(given, F.col("vec_id") % 10 == 0).collect()) == brute(some_rows(6, 40), lambda i: i % 10 == 0)


def test_candidates_miss_nothing():
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * rng.standard_normal((500, 12))).astype(np.int64)
    bucket = N.Bucket(vectors, np.arange(500), np.arange(500), np.zeros(500, np.int64))
    pruned = 0
    for query in vectors[:60]:
        scores = vectors @ query
        for least in np.quantile(scores, [0.5, 0.9, 0.99]).astype(int).tolist():
            found = bucket.candidates(query, least)
            assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
            pruned += 500 - len(found)
    assert pruned > 0
