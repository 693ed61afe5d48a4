import math
import random
from collections import Counter

import pytest

from plotwright.llm.common import words_of
from plotwright.llm.lm_scores import score_documents


def brute(rows, order, backoff):
    docs = [words_of(t) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i - k : i]) for k in range(order + 1) for i in range(max(k, 1), len(w) + 1))
    every = sum((grams(w) for w in docs), Counter())
    out = []
    for (i, _), w in zip(rows, docs, strict=True):
        own = grams(w)
        n = lambda g: every[g] - own[g]  # noqa: B023, E731
        total = 0.0
        for p in range(1, len(w) + 1):
            longest = min(order, p)
            for k in range(longest, 0, -1):
                g = tuple(w[p - k : p])
                if n(g) > 0:
                    s = n(g) / max(n(g[:-1]), 1)
                    break
            else:
                k, s = 1, backoff / max(n(()), 1)
            total += math.log(s) + (longest - k) * math.log(backoff)
        out.append((str(i), len(w), total))
    return sorted(out)


def run(frame, rows, **more):
    df = score_documents(frame(rows, "doc_id long, text string"), **more)
    got = df.collect()
    for r in got:
        assert (r["mean_score"] is None) == (r["n_words"] == 0)
    return sorted((str(r["doc_id"]), r["n_words"], r["log_score"]) for r in got)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_as_brute_force(frame, order):
    rnd = random.Random(order)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 40)))) for i in range(60)]
    rows += [(70, rows[3][1]), (70, rows[3][1]), (None, "A b, c"), (71, None), (72, ""), (73, "unheard of")]
    expected = brute(rows, order, 0.4)
    for chars in (10**9, 200):
        got = run(frame, rows, order=order, block_chars=chars)
        assert [g[:2] for g in got] == [e[:2] for e in expected]
        assert [g[2] for g in got] == pytest.approx([e[2] for e in expected])


def test_single_document_empty_table_long_and_clashing(frame):
    assert run(frame, [(1, "a b")]) == [("1", 2, pytest.approx(3 * math.log(0.4)))]
    assert run(frame, []) == []
    long = [(1, "a b c " * 50_000), (2, "a b c")]
    assert run(frame, long)[0][1] == 150_000
    df = score_documents(frame([("x", "a b", 1)], "doc_id string, text string, n_words int"))
    assert df.columns == ["doc_id", "n_words", "log_score", "mean_score"] and df.first()["doc_id"] == "x"
