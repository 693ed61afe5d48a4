from itertools import product

import numpy as np

from plotwright.llm.lattice import SHORTEST, near_vectors, nearest_point, settings


def brute(rows, threshold=0.98):
    good = {}
    for i, v, label in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        if x is not None and len(x) and label is not None and np.isfinite(x).all() and x.any():
            good[i] = (x / np.sqrt(x @ x), label)
    linked = {i: set() for i, _, _ in rows}
    for a in good:
        for b in good:
            if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= threshold:
                linked[a].add(b)
                linked[b].add(a)
    out = {}
    for i in linked:
        reach, todo = {i}, [i]
        while todo:
            for n in linked[todo.pop()] - reach:
                reach.add(n)
                todo.append(n)
        out[i] = (len(linked[i]), min(reach), min(reach) == i)
    return out


def run(frame, rows, **more):
    df = near_vectors(frame(rows, "vec_id long, embedding array<float>, label int"), **more)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def made(seed, groups, size, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = rng.standard_normal(64)
        for _ in range(size):
            rows.append([float(c) for c in np.float32(base + noise * rng.standard_normal(64))])
    order = rng.permutation(len(rows))
    return [(int(k), rows[j], int(j % 2)) for k, j in enumerate(order)]


def test_recall_against_brute_force(frame):
    rows = made(1, 60, 8, 0.14)
    expected, got = brute(rows), run(frame, rows)
    links, found = sum(v[0] for v in expected.values()), sum(v[0] for v in got.values())
    assert links > 300 and found >= 0.98 * links
    assert all(got[i][0] <= expected[i][0] for i in expected)


def test_crowds_are_split_into_blocks(frame):
    rows = made(2, 2, 80, 0.05)
    assert run(frame, rows, block=10) == brute(rows)


def test_copies_scaled_vectors_and_odd_rows(frame):
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    rows = [(5, v, 1), (3, v, 1), (9, [2 * x for x in v], 1), (4, v, 2), (6, None, 1), (7, [0.0] * 8, 1), (8, [float("nan"), *v[1:]], 1)]
    rows += [(10, [None, *v[1:]], 1), (11, v, None), (12, [], 1), (13, [float("inf"), *v[1:]], 1), (14, v[:7], 1), (15, [-x for x in v], 1)]
    assert run(frame, rows) == brute(rows)
    twice = near_vectors(frame([(1, v, 1), (1, v, 1), (None, v, 1)], "vec_id long, embedding array<float>, label int"))
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in twice.collect()) == [("1", 1, True), ("1", 1, True), ("None", 0, True)]


def test_vectors_of_two_lengths_under_one_label(frame):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in np.float32(rng.standard_normal(4 + i % 2))], 1) for i in range(600)]
    expected, got = brute(rows), run(frame, rows)
    links, found = sum(v[0] for v in expected.values()), sum(v[0] for v in got.values())
    assert links > 100 and found >= 0.98 * links
    assert all(got[i][0] <= expected[i][0] for i in expected)


def test_empty_table_and_clashing_columns(frame):
    assert run(frame, []) == {}
    df = near_vectors(frame([(1, [1.0, 2.0], 1, True)], "vec_id long, embedding array<double>, label long, kept boolean"))
    assert [tuple(r) for r in df.collect()] == [(1, 0, 1, True)]


def test_nearest_lattice_point():
    assert len(SHORTEST) == 240 and np.allclose((SHORTEST**2).sum(axis=1), 2)
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (200, 8))
    points = nearest_point(x)
    whole = np.array([p for p in product((-1, 0, 1), repeat=8) if sum(p) % 2 == 0], float)
    half = np.array([p for p in product((-0.5, 0.5), repeat=8) if sum(p) % 2 == 0], float)
    best = np.minimum(((x[:, None] - whole) ** 2).sum(2).min(1), ((x[:, None] - half) ** 2).sum(2).min(1))
    assert np.all(((x - points) ** 2).sum(1) <= best + 1e-9)
    assert np.all(points.sum(axis=1) % 2 == 0)


def test_extremes_of_double_precision_link(frame):
    schema = "vec_id long, embedding array<double>, label int"
    pairs = [([1e200, 2e200], [2e200, 4.1e200]), ([1e-200, 2e-200], [1e-200, 2.01e-200]), ([5e-324, 5e-324], [1.0, 1.0]), ([1e308, -1e308], [3.0, -3.1])]
    rows = [(2 * k + j, v, k) for k, pair in enumerate(pairs) for j, v in enumerate(pair)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame(rows, schema)).collect()}
    assert got == {i: (1, i - i % 2) for i in range(8)}


def test_settings_follow_the_crowd_and_keep_the_recall(frame):
    assert settings(0) == settings(10_000_000) == (1, 4) and settings(10_000_001) == (2, 5) and settings(10**12)[0] == 3
    rows = made(4, 60, 8, 0.14)
    expected = brute(rows)
    for projections, tables in ((2, 5), (3, 6)):
        got = run(frame, rows, projections=projections, tables=tables)
        assert sum(v[0] for v in got.values()) >= 0.97 * sum(v[0] for v in expected.values())
