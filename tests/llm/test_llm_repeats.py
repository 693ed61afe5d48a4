import random

import pytest

from plotwright.llm.repeats import WINDOW, remove_repeats


def brute(rows, window=WINDOW):
    """(id, text) -> kept words and removed places, windows compared one by one."""
    top = 1 << 63
    first = {}
    docs = [(top if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for (name, _), (i, w) in zip(rows, docs, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((name, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def removed(frame, rows, **settings):
    out = remove_repeats(frame(rows, "doc_id long, text string"), **settings).collect()
    for r in out:
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out), key=str)


def words(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


def test_maximal_repeat_goes_from_the_later_document(frame):
    rows = [(5, f"x {words(0, 20)} y"), (2, f"p q r {words(0, 20)}"), (9, f"{words(3, 15)} z")]
    assert removed(frame, rows) == [(2, 23, 0, rows[1][1]), (5, 22, 20, "x y"), (9, 13, 0, rows[2][1])]


@pytest.mark.parametrize("offset", range(13))
def test_thirteen_words_at_any_offset(frame, offset):
    rows = [(1, f"{words(100, 100 + offset)} {words(0, 13)} end"), (2, f"a b {words(0, 13)} c"), (3, f"a {words(0, 12)} c")]
    assert removed(frame, rows) == brute(rows)


def test_own_repeats_equal_ids_nulls_and_empties(frame):
    text = words(0, 15)
    rows = [(4, f"{text} {text}"), (4, text), (4, text), (None, text), (None, text), (7, None), (8, ""), (None, words(50, 70)), (None, words(50, 70)), (-3, "short")]
    assert removed(frame, rows) == brute(rows)


@pytest.mark.parametrize("window, vocabulary", [(13, 2), (4, 3), (5, 4), (1, 30)])
def test_random_texts_as_brute_force(frame, window, vocabulary):
    rnd = random.Random(window)
    rows = [(rnd.randrange(0, 250), " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäöüßéèêñãõ"[:vocabulary]) for _ in range(rnd.randrange(0, 40)))) for _ in range(200)]
    assert removed(frame, rows, window=window) == brute(rows, window)


def test_chunks_change_nothing(frame):
    rows = [(i, f"own{i} {words(i % 7, 30)} tail{i}") for i in range(80)]
    assert removed(frame, rows, chunk_chars=400) == removed(frame, rows) == brute(rows)


def test_other_blanks_stay_in_words(frame):
    rows = [(1, "a b\x1cc d e\tf\x0bg\rh")]
    assert removed(frame, rows) == [(1, 5, 0, "a b\x1cc d e f g h")]


def test_long_text_empty_table_and_clashing_columns(frame):
    long = words(0, 60_000)
    (short, whole) = removed(frame, [(2, long), (1, words(20_000, 40_000))])
    assert short[2] == 0 and whole[1:3] == (60_000, 20_000)
    assert removed(frame, []) == []
    given = frame([(1, "t", 3, "x", 1)], "doc_id long, text string, n_words int, spans string, chunk int")
    assert [tuple(r) for r in remove_repeats(given).collect()] == [(1, 1, 0, [], "t")]
