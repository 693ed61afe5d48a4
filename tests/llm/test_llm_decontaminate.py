import random
import re

from plotwright.llm.decontaminate import Search, find_test_items

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items, window=10):
    have = words(text)
    hit, owners = set(), set()
    for item, body in items:
        w = words(body)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(have) - size + 1):
                if have[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    owners.add(str(item) if item is not None else "")
    return len(have), len(hit), sorted(owners)


def run(frame, docs, items, **more):
    df = find_test_items(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), **more)
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], [(s["first"], s["last"]) for s in r["spans"]]) for r in df.collect()}


def test_as_brute_force_with_one_table_and_many(frame):
    rnd = random.Random(5)
    vocabulary = ["a", "b", "Ça", "été", "x1"]
    text = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", ",", "."]) for _ in range(n))
    docs = [(i, text(rnd.randrange(0, 60))) for i in range(60)]
    items = [(i, text(rnd.choice([0, 1, 3, 4, 5, 6, 12]))) for i in range(25)]
    expected = {i: brute(t, items, 4) for i, t in docs}
    for table_words in (10_000, 20):
        got = run(frame, docs, items, window=4, table_words=table_words)
        assert {i: g[:3] for i, g in got.items()} == expected
        for _, n_hit, _, spans in got.values():
            assert sum(b - a + 1 for a, b in spans) == n_hit
            assert all(y[0] > x[1] + 1 for x, y in zip(spans, spans[1:], strict=False))


def test_window_of_ten_and_short_items(frame):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, f"x {ten.upper()}! y"), (2, ten.replace("five", "5")), (3, "short item here"), (4, None), (5, "")]
    got = run(frame, docs, [(7, ten), (7, ten), (None, "Short Item"), (8, None), (9, "")])
    assert got == {
        1: (12, 10, ["7"], [(1, 10)]),
        2: (10, 0, [], []),
        3: (3, 2, [""], [(0, 1)]),
        4: (0, 0, [], []),
        5: (0, 0, [], []),
    }


def test_search_moves_past_words_no_pattern_has():
    pattern = tuple(str(i).encode() for i in range(10))
    search = Search({pattern: {"p"}}, 10, 2)
    assert search.shift[(b"8", b"9")] == 0 and search.furthest == 9
    text = [b"z"] * 1000 + list(pattern) + [b"z"] * 7
    assert [at for at, _ in search.occurrences(text)] == [1000]


def test_empty_tables_long_text_and_clashing_columns(frame):
    ten = "one two three four five six seven eight nine ten"
    assert run(frame, [], [(1, ten)]) == {}
    assert run(frame, [(1, ten)], []) == {1: (10, 0, [], [])}
    got = run(frame, [(1, "pad " * 200_000 + ten)], [(1, ten)])
    assert got[1][:3] == (200_010, 10, ["1"])
    df = find_test_items(frame([(1, ten, "mine")], "doc_id long, text string, Spans string"), frame([(1, ten)], "item_id long, text string"))
    assert df.columns == ["doc_id", "text", "n_words", "n_hit", "spans", "items"]
