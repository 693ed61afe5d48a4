import os
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plotwright.llm.token_counts import Counter, count_tokens, read_cache

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "hello world", "hello world", "Ünïcödé 中文 \U0001f600", "a <|endoftext|> b", "  \n\t x", "word " * 60_000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def run(frame, path, texts, **more):
    df = count_tokens(frame(list(enumerate(texts)), "doc_id long, text string"), PATH, str(path), **more)
    return {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect()}


def test_as_the_library(frame, tmp_path, library):
    expected = {}
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i] = (len((t or "").encode()), n, n > 512)
    assert run(frame, tmp_path / "a", TEXTS) == expected
    assert run(frame, tmp_path / "b", TEXTS, chunk_chars=5) == expected


def test_pieces_add_up_to_the_library_count(library):
    with open(PATH, encoding="utf-8") as file:
        counter = Counter(file.read())
    assert counter.split is not None
    rnd = random.Random(4)
    kinds = [(32, 127), (9, 14), (0x1C, 0x20), (0x80, 0x3000), (0x4E00, 0xD7FF), (0x1F300, 0x1F700)]
    texts = ["".join(chr(rnd.randrange(*rnd.choice(kinds))) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts += [f"a{chr(c)}1 {chr(c)}b" for c in range(0x3100) if c != 0] + ["it's we'll'x 's", "<|endoftext|>", "x<|endoftext|>  y", ""]
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_tokenizers_go_whole():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        counter = Counter(file.read())
    assert counter.split is None
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some Words, here", "", "ÀÉ x"]
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_only_misses_are_encoded_and_appended(spark, frame, tmp_path, library):
    path = tmp_path / "cache"
    run(frame, path, ["one", "two", "two"])
    first = read_cache(spark, str(path)).collect()
    assert len(first) == 2
    # A stored count is believed: this one is wrong on purpose.
    wrong = [(r["version"], r["digest"], 77) for r in first]
    changed = tmp_path / "changed"
    frame(wrong, "version binary, digest binary, n_tokens long").write.parquet(str(changed))
    got = run(frame, changed, ["one", "three three", "one"])
    assert got[0][1] == got[2][1] == 77
    assert got[1][1] == len(library.encode("three three").ids)
    assert read_cache(spark, str(changed)).count() == 3
    before = sorted(os.listdir(changed))
    run(frame, changed, ["one", "two", "three three"])
    added = [f for f in os.listdir(changed) if f not in before and f.endswith(".parquet")]
    assert read_cache(spark, str(changed)).count() == 3
    assert all(spark.read.parquet(str(changed / f)).count() == 0 for f in added)


def test_other_tokenizers_do_not_share_counts(spark, frame, tmp_path):
    path = tmp_path / "cache"
    run(frame, path, ["some words here"])
    count_tokens(frame([(0, "some words here")], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"), str(path)).collect()
    assert read_cache(spark, str(path)).select("version").distinct().count() == 2


def test_empty_table_and_clashing_columns(frame, tmp_path):
    assert run(frame, tmp_path / "e", []) == {}
    df = count_tokens(frame([(1, "x", "y", 2)], "doc_id long, text string, N_Tokens string, digest int"), PATH, str(tmp_path / "c"))
    assert df.columns == ["doc_id", "digest", "n_bytes", "n_tokens", "over_limit"]
    assert tuple(df.first()) == (1, 2, 1, 1, False)
