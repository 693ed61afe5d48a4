import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwright.llm.toxicity import Model, fit, score_texts, train

BAD = ["gronk", "blarfing", "snivel"]


def make(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("aeioumnrst") for _ in range(rnd.randrange(2, 8))) for _ in range(rnd.randrange(20, 120))]
        toxic = int(i % 5 == 0)
        for _ in range(max(1, len(words) // 30) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(BAD)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = make(1200, 1)
    return train([t for _, t, _ in rows], [y for _, _, y in rows])


def test_held_out_texts(model):
    rows = make(500, 2)
    score = model.score([t for _, t, _ in rows])
    toxic = np.array([y for _, _, y in rows])
    assert ((score >= 0.5) == toxic).mean() > 0.97


def test_unseen_misspellings_share_subwords(model):
    rnd = random.Random(8)
    clean = " ".join("".join(rnd.choice("aeioumnrst") for _ in range(5)) for _ in range(30))
    plain, spelt = model.score([clean, clean + " gronkk blarfingg snivvel"])
    assert plain < 0.5 < spelt


def test_null_empty_long_and_clashing(frame, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "?!", "x"), (4, "gronk " * 200_000, "x"), (5, "tea", "x"), (5, "tea", "x")]
    df = score_texts(frame(rows, "doc_id long, text string, SCORE string"), model)
    assert df.columns == ["doc_id", "text", "score", "predicted"]
    got = df.collect()
    prior = 1 / (1 + np.exp(-model.offset))
    assert [r["score"] for r in got[:3]] == pytest.approx([prior] * 3)
    assert got[3]["predicted"] == 1 and got[4] == got[5]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert score_texts(frame([], "doc_id long, text string"), model).count() == 0


def test_fit_takes_usable_rows_only(frame):
    rows = make(300, 3)
    docs = frame([(i, t) for i, t, _ in rows] + [(None, "gronk"), (900, None)], "doc_id long, text string")
    right = [(i, y) for i, _, y in rows if i % 2]
    wrong = [(i, 1 - y) for i, _, y in rows if not i % 2] + [(None, 1), (900, 1), (1, None)]
    both = fit(docs, frame(right + wrong, "doc_id long, toxic int"), F.col("doc_id") % 2 == 1)
    only = fit(docs, frame(right, "doc_id long, toxic int"), F.lit(True))
    texts = [t for _, t, _ in make(100, 4)]
    assert np.allclose(both.score(texts), only.score(texts))


def test_nothing_to_learn(frame):
    docs = frame([(1, "a"), (2, "b")], "doc_id long, text string")
    none = fit(docs, frame([], "doc_id long, toxic int"), F.lit(True))
    clean = fit(docs, frame([(1, 0), (2, 0)], "doc_id long, toxic int"), F.lit(True))
    assert isinstance(none, Model) and none.score(["a"])[0] < 0.5 and clean.score([""])[0] < 0.5
    assert 0.5 < fit(docs, frame([(1, 1), (2, 1)], "doc_id long, toxic int"), F.lit(True)).score(["a"])[0]


def test_long_texts_do_not_end_the_sample(frame):
    rows = make(400, 6)
    long = [(1000 + i, "tea " * 50_000, 0) for i in range(5)]
    chars = sum(len(t) for _, t, _ in rows)
    texts = [t for _, t, _ in make(100, 7)]
    scores = []
    for order in (long + rows, rows[::-1] + long):
        docs = frame([(i, t) for i, t, _ in order], "doc_id long, text string").coalesce(1)
        labels = frame([(i, y) for i, _, y in order], "doc_id long, toxic int")
        scores.append(fit(docs, labels, F.lit(True), sample_chars=chars).score(texts))
        few = fit(docs, labels, F.lit(True), sample_chars=chars // 2).score(texts)
        scores.append(few)
    toxic = np.array([y for _, _, y in make(100, 7)])
    assert ((scores[0] >= 0.5) == toxic).mean() > 0.95
    assert np.array_equal(scores[0], scores[2]) and np.array_equal(scores[1], scores[3])
