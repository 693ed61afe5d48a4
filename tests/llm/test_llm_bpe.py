import base64
import random

import public_tokenizers
import pytest
import tiktoken

from plotwright.llm.bpe import decode, encode, load_ranks, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks(spark):
    return load_ranks(spark, PATH)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def check(frame, ranks, library, texts, **more):
    df = frame(list(enumerate(texts)), "doc_id long, text string")
    out = decode(encode(df, ranks, public_tokenizers.PATTERN, **more), ranks).collect()
    for r in out:
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]] or "")
        assert bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode()
    assert len(out) == len(texts)


def test_as_the_library(frame, ranks, library):
    rnd = random.Random(11)
    kinds = [(32, 127), (9, 14), (0x1C, 0x20), (0x80, 0x3000), (0x4E00, 0xD7FF), (0x1F300, 0x1F700)]
    texts = ["".join(chr(rnd.randrange(*rnd.choice(kinds))) for _ in range(rnd.randrange(60))) for _ in range(800)]
    texts += ["".join(rnd.choice("aeilnorst") for _ in range(200)) for _ in range(50)]
    texts += [None, "", " ", "\n\n", "<|endoftext|>", "it's we'LL", "same", "same"]
    check(frame, ranks, library, texts)
    check(frame, ranks, library, texts[-300:], chunk_chars=50)


def test_long_words(frame, ranks, library):
    check(frame, ranks, library, ["a" * 20_000, "ab" * 10_000, "=" * 3000, " " * 3000, "word " * 100_000])


def test_empty_table_and_clashing_columns(frame, ranks):
    assert encode(frame([], "doc_id long, text string"), ranks, public_tokenizers.PATTERN).count() == 0
    df = encode(frame([(1, "hi", "x")], "doc_id long, text string, IDS string"), ranks, public_tokenizers.PATTERN)
    assert df.columns == ["doc_id", "text", "ids"] and df.first()["ids"]
    assert decode(frame([(1, None)], "doc_id long, ids array<int>"), ranks).first()["decoded"] == b""


def test_lower_rank_after_a_higher_one(frame, spark, tmp_path):
    """`bc` merges late, but then `a` + `bc` has a lower rank than other merges of the word."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"cd", b"bcd"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" " + str(i).encode() + b"\n" for i, t in enumerate(tokens)))
    made = read_ranks(path.read_bytes())
    library = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=made, special_tokens={})
    rnd = random.Random(2)
    check(frame, load_ranks(spark, str(path)), library, ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 30))) for _ in range(300)])
