import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwright.llm.language import Model, fit, label_languages, marginals, train

SOUNDS = {"aa": ["ba", "ko", "tu", "ri"], "bb": ["schl", "erz", "ung", "itt"], "cc": ["éau", "ois", "ent", "çu"]}


def sentence(lang, n, rnd):
    return " ".join("".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    langs = [lang for lang in SOUNDS for _ in range(80)]
    return train([sentence(lang, 40, rnd) for lang in langs], langs)


def test_forward_backward_as_enumeration():
    rng = np.random.default_rng(4)
    emissions, follow = rng.standard_normal((5, 3)), rng.standard_normal((3, 3))
    docs = [np.array([0, 3, 3, 1]), np.array([], np.int64), np.array([4]), np.array([2, 1])]
    likely, pairs, logs = marginals(emissions, follow, docs)
    at, all_pairs = 0, np.zeros((3, 3))
    for d, doc in enumerate(docs):
        chance, total = np.zeros((len(doc), 3)), 0.0
        expected = np.zeros((3, 3))
        for path in product(range(3), repeat=len(doc)):
            s = sum(emissions[w, k] for w, k in zip(doc, path, strict=True)) + sum(follow[a, b] for a, b in zip(path, path[1:], strict=False))
            weight = np.exp(s)
            total += weight
            for i, k in enumerate(path):
                chance[i, k] += weight
            for a, b in zip(path, path[1:], strict=False):
                expected[a, b] += weight
        assert np.allclose(likely[at : at + len(doc)], chance / total)
        all_pairs += expected / total
        at += len(doc)
        best = sum(emissions[w].max() for w in doc) + follow.max() * max(0, len(doc) - 1)
        assert np.isclose(logs[d] + best, np.log(total)) or not len(doc)
    assert np.allclose(pairs, all_pairs)


def test_held_out_texts_and_switches(frame, model):
    rnd = random.Random(2)
    rows = [(i, sentence(lang, rnd.randrange(3, 60), rnd), lang) for i, lang in enumerate(list(SOUNDS) * 40)]
    df = label_languages(frame(rows, "doc_id long, text string, lang string"), model)
    assert df.where("lang = lang_pred").count() >= 0.98 * len(rows)
    mixed = sentence("bb", 8, rnd) + " " + sentence("cc", 6, rnd)
    spans = label_languages(frame([(1, mixed)], "doc_id long, text string"), model).first()["spans"]
    assert [(s["first"], s["last"], s["lang"]) for s in spans] == [(0, 7, "bb"), (8, 13, "cc")]


def test_null_empty_long_and_clashing(frame, model):
    rnd = random.Random(3)
    long = sentence("aa", 60_000, rnd)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 ?! 3", "x"), (4, long, "x"), (5, "schlung 9", "x"), (5, "schlung 9", "x")]
    df = label_languages(frame(rows, "doc_id long, text string, Spans string"), model)
    assert df.columns == ["doc_id", "text", "lang_pred", "score", "spans"]
    got = df.collect()
    assert [(r["lang_pred"], r["score"], r["spans"]) for r in got[:3]] == [("und", 0.0, [])] * 3
    assert got[3]["lang_pred"] == "aa" and got[3]["spans"][-1]["last"] == 59_999
    assert got[4] == got[5] and got[4]["lang_pred"] == "bb" and 0 <= got[4]["score"] <= 1
    assert label_languages(frame([], "doc_id long, text string"), model).count() == 0


def test_fit_takes_usable_rows_only(frame):
    rnd = random.Random(6)
    rows = [(i, sentence(lang, 30, rnd), lang) for i, lang in enumerate(list(SOUNDS) * 20)]
    more = [(100, "x y", "never"), (None, "x", "never"), (3, "x", None), (4, None, "aa")]
    schema = "doc_id long, text string, lang string"
    learned = fit(frame(rows + more, schema), F.col("doc_id") < 100)
    assert learned.labels == list(SOUNDS)
    empty = fit(frame([], schema), F.lit(True))
    assert isinstance(empty, Model)
    assert label_languages(frame([(1, "abc")], "doc_id long, text string"), empty).first()["lang_pred"] == "und"


def test_model_does_not_depend_on_partitions(frame):
    rnd = random.Random(8)
    rows = [(i // 2, sentence(lang, 20, rnd), lang) for i, lang in enumerate(list(SOUNDS) * 15)]
    rows += rows[:7]
    given = frame(rows, "doc_id long, text string, lang string")
    a, b = (fit(given.repartition(n, F.rand(n)), F.lit(True), sample_rows=40) for n in (1, 7))
    assert a.labels == b.labels and a.lexicon == b.lexicon
    assert (a.weights == b.weights).all() and (a.follow == b.follow).all()


def test_rare_languages_are_learned_within_the_bounds(frame):
    rnd = random.Random(9)
    first, second = list(SOUNDS)[:2]
    rows = [(i, sentence(first, 10, rnd), first) for i in range(300)] + [(500, sentence(second, 10, rnd), second)]
    rows += [(600 + i, "w " * 3000, "huge") for i in range(3)]
    given = frame(rows, "doc_id long, text string, lang string")
    assert fit(given, F.lit(True), sample_rows=20, sample_chars=2000).labels == sorted([first, second])


def test_equal_sums_take_the_first_language(frame):
    model = Model(["aa", "bb"], {}, np.zeros((1 << 18, 2)), np.zeros((2, 2)))
    assert label_languages(frame([(1, "word")], "doc_id long, text string"), model).first()["lang_pred"] == "aa"
