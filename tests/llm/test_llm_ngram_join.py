import random
from itertools import combinations
from math import comb

import numpy as np

from plotwright.llm.common import words_of
from plotwright.llm.ngram_join import HASHES, STEP, least_matches, near_duplicates, one_of_each, shingle_sets


def grams(text):
    w = words_of(text)
    size = min(5, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else frozenset()


def brute(rows):
    """id -> (class, links, component), for distinct ids that are not null."""
    sets = {i: grams(t) for i, t in rows}
    linked = {i: set() for i in sets}
    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
            linked[a].add(b)
            linked[b].add(a)
    out = {}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            for n in linked[todo.pop()] - reach:
                reach.add(n)
                todo.append(n)
        same = [j for j in sets if sets[j] == sets[i] and sets[i]] or [i]
        out[i] = (min(same), len(linked[i]), min(reach))
    return out


def copies(rnd, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"n{rnd.randrange(10**6)}"
    return " ".join(words)


def corpus(groups, size, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(30, 150)))
        rows += [copies(rnd, base, rnd.randrange(0, 6)) for _ in range(size)]
    rows += [" ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(0, 8))) for _ in range(60)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def answers(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"], r["component_id"]) for r in df.collect()}


def test_as_brute_force(frame):
    rows = corpus(12, 9, 1)
    df = near_duplicates(frame(rows, "doc_id long, text string"))
    expected = brute(rows)
    assert answers(df) == expected
    assert {r["doc_id"] for r in df.where("kept").collect()} == {i for i, (_, _, c) in expected.items() if c == i}


def test_crowds_are_split_into_blocks(frame):
    rows = corpus(2, 90, 4)
    assert answers(near_duplicates(frame(rows, "doc_id long, text string"), block=8)) == brute(rows)


def test_pruning_bounds_are_those_of_the_posterior():
    least = least_matches(0.8, 1e-6)
    for k, m in enumerate(least):
        n = (k + 1) * STEP
        below = lambda m: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(m + 1))  # noqa: B023, E731
        assert below(m) >= 1e-6 and (m == 0 or below(m - 1) < 1e-6)
    assert len(least) == HASHES // STEP


def test_null_empty_repeated_and_clashing(frame):
    a = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(3, a, 1), (3, a, 1), (5, a.upper() + "!", 2), (None, a, 3), (6, None, 4), (7, "", 5), (8, "?!", 6), (9, "hi", 7), (10, "HI", 8)]
    df = near_duplicates(frame(rows, "doc_id long, text string, kept int"))
    got = sorted((str(r["doc_id"]), r["class_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())
    assert got == sorted(
        [
            ("3", 3, 2, 3, True),
            ("3", 3, 2, 3, True),
            ("5", 3, 2, 3, False),
            ("None", None, 0, None, True),
            ("6", 6, 0, 6, True),
            ("7", 7, 0, 7, True),
            ("8", 8, 0, 8, True),
            ("9", 9, 1, 9, True),
            ("10", 9, 1, 9, False),
        ]
    )
    left = one_of_each(frame(rows, "doc_id long, text string, kept int"))
    assert left.columns == ["doc_id", "text", "kept"]
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["3", "3", "None", "6", "7", "8", "9"])


def test_empty_table_and_long_texts(frame):
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    got = answers(near_duplicates(frame([(1, long), (2, long + " end"), (3, "w1 w2")], "doc_id long, text string")))
    assert got == {1: (1, 1, 1), 2: (2, 1, 1), 3: (3, 0, 3)}


def test_shingles_do_not_depend_on_their_neighbors():
    texts = ["a b c d e f", "x", None, "a b c d e f g"]
    together = shingle_sets(texts)
    assert all(np.array_equal(s, shingle_sets([t])[0]) for s, t in zip(together, texts, strict=True))
    assert len(np.intersect1d(together[0], together[3])) == 2
