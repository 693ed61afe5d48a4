import random
import re
from collections import Counter

import numpy as np
import pytest

from plotwright.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, threshold, longest=5, top=2000):
    words, f = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    out = []
    for (lang, w), a in found.items():
        if any(
            g == lang and len(x) > len(w) and b >= a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))
            for (g, x), b in found.items()
        ):
            continue
        cuts = [(1000 * a * words[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], words[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranks, rows = Counter(), []
    for lang, phrase, a, left, right, n, score in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase, a, left, right, n, score))
    return sorted(rows)


def mined(frame, rows, **settings):
    out = C.collocations(frame(rows, "text string, lang string"), **settings)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def some_rows(seed, number, vocabulary):
    rnd = random.Random(seed)
    marks = [" ", " ", " ", "  ", "\t", ". ", "\n", ","]
    return [
        ("".join(rnd.choice(vocabulary) + rnd.choice(marks) for _ in range(rnd.randrange(0, 40))), rnd.choice(["en", "de", None]))
        for _ in range(number)
    ]


@pytest.mark.parametrize("threshold, top", [(3, 2000), (6, 5)])
def test_as_brute_force(frame, threshold, top):
    rows = some_rows(1, 150, ["a", "A", "be", "ce", "Öl", "x-y", "x", "e"])
    assert mined(frame, rows, threshold=threshold, top=top) == brute(rows, threshold, top=top)


def test_small_chunks_and_few_counters_change_nothing(frame):
    rows = some_rows(2, 200, ["a", "b", "c", "d", "e", "f"])
    assert mined(frame, rows, threshold=8, chunk_bytes=300, counters=1) == brute(rows, 8)


def test_a_contained_phrase_goes_also_where_the_longer_one_goes(frame):
    rows = [("p q r s", "en")] * 5 + [("q r", "en")]
    assert [r[2] for r in mined(frame, rows, threshold=5)] == ["p q r s", "q r"]


def test_nulls_empties_ties_and_no_rows(frame):
    rows = [(None, "en"), ("", "en"), ("b a. a b", None), ("a b;b a", None), ("word", "fr")]
    assert mined(frame, rows, threshold=2) == [("und", 1, "a b", 2, 4, 4, 8, 1000), ("und", 2, "b a", 2, 4, 4, 8, 1000)]
    assert mined(frame, [], threshold=1) == []


def test_long_text_and_clashing_columns(frame):
    text = "ab cd " * 40_000
    out = C.collocations(frame([(text, "en", 1, 2)], "text string, lang string, score long, rank long"), threshold=39_999, longest=2)
    assert sorted(r["phrase"] for r in out.collect()) == ["ab cd", "cd ab"]


def test_products_beyond_64_bits(frame):
    n, a = 3_000_000_000_000, 2_000_000_000
    phrases = frame([("en", "", 0, n), ("en", "p", 1, a), ("en", "q", 1, a + 1), ("en", "p q", 2, a)], "lang string, phrase string, size int, f long")
    original = C.frequent_phrases
    C.frequent_phrases = lambda *args: phrases
    try:
        (row,) = C.collocations(frame([], "text string, lang string")).collect()
    finally:
        C.frequent_phrases = original
    assert row["score"] == 1000 * a * n // (a * (a + 1))


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    for capacity in (20, 60):
        draws = [rng.zipf(1.5, 400).clip(max=5000).astype(np.uint32) for _ in range(30)]
        parts = [tuple(np.unique(d, return_counts=True)) for d in draws]
        keys, counts, lost = C.summary_of(parts, capacity)
        total = Counter(np.concatenate(draws).tolist())
        kept = dict(zip(keys.tolist(), counts.tolist(), strict=True))
        assert len(kept) <= capacity and lost <= 12_000 / (capacity + 1)
        for key, n in total.items():
            assert n - lost <= kept.get(key, 0) <= n
