import random

import pytest

import corpus_pipeline
from plotwright.llm.common import words_of
from plotwright.llm.ngram_join import shingle_sets

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage leaves of the smallest tables."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, SF_DIR), "stage")
        out.append((name, docs.collect()))
    return out


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in kept[1:]] == [n for n, _ in corpus_pipeline.STAGES]
    for _, rows in kept[:-1]:
        assert [*rows[0].asDict()] == COLUMNS
    assert len(kept[0][1]) > len(kept[-1][1]) > 0.7 * len(kept[0][1])


def test_no_near_copy_is_left(kept):
    before, after = kept[2][1], kept[3][1]
    sets = dict(zip([r["doc_id"] for r in before], shingle_sets([r["text"] for r in before]), strict=True))
    left = {r["doc_id"] for r in after}

    def near(a, b):
        x, y = set(sets[a].tolist()), set(sets[b].tolist())
        return bool(x) and len(x & y) >= 0.8 * len(x | y) - 1e-9

    ids = sorted(sets)
    linked = {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if near(a, b)}
    assert not any(a in left and b in left for a, b in linked)
    assert set(ids) - left <= {x for pair in linked for x in pair}


def test_no_test_item_is_left(spark, kept):
    items = [words_of(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(len(w) - 9)}
    has = lambda t: any(tuple(w[i : i + 10]) in windows for w in [words_of(t)] for i in range(len(w) - 9))
    before, after = kept[3][1], kept[4][1]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not has(r["text"])}


def test_ids_decode_to_the_texts(kept):
    assert {r["doc_id"] for r in kept[5][1]} == {r["doc_id"] for r in kept[4][1]}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in kept[5][1])


def test_run_gives_what_the_stages_give(spark, kept):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {r["doc_id"]: r["ids"] for r in kept[5][1]}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_in_every_stage(spark, frame, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, spans string"
    rnd = random.Random(1)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(30_000))
    rows = [(1, None, None, None, None), (None, "no id", None, "s", 5), (2, "", "en", "s", 0), (3, long, "en", "s", len(long))]
    rows += [(4, "twice", "en", "s", 5)] * 2
    out = stage(spark, frame([(*r, "x", 1, "y") for r in rows], schema), SF_DIR)
    got = out.collect()
    if stage is not corpus_pipeline.token_ids:
        assert out.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(str(r["doc_id"]) for r in got) == sorted(["1", "None", "2", "3", "4", "4"])
    assert stage(spark, frame([], schema), SF_DIR).count() == 0


def test_one_of_a_group_of_copies_reaches_the_end(spark, frame):
    copy = "\n".join(f"line {n} speaks of matter {n * 7} and of no other" for n in range(6))
    rows = [(i, copy, "en", "s", len(copy)) for i in range(10, 40)]
    # Blank lines and a rule of its own do not make another text.
    rows += [(50, f"\n{copy}\n \n", "en", "s", 5), (51, f"{copy}\n-- ! --", "en", "s", 5), (None, copy, "en", "s", 5)]
    stay = [(1, "quite alone\nin its\nthree lines", "en", "s", 5), (2, "", "en", "s", 0), (3, None, "en", "s", 0), (4, "!\n!\n!\n!", "en", "s", 7)]
    docs = frame(rows + stay, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, SF_DIR), "stage")
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 2, 3, 4, 10]
