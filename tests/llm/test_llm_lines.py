import random
from collections import defaultdict

from plotwright.llm.lines import dedup_lines


def brute(rows):
    """(id, text) -> text after removal, by going through all windows in order."""
    import hashlib

    docs = sorted({(i is None, i or 0, hashlib.md5((t or "").encode()).digest(), t) for i, t in rows if t is not None})
    seen, gone = {}, defaultdict(set)
    for no_id, i, key, text in docs:
        filled = [(n, x.strip(" \t\r")) for n, x in enumerate(text.split("\n")) if x.strip(" \t\r")]
        for j in range(len(filled) - 2):
            window = tuple(x for _, x in filled[j : j + 3])
            if window in seen:
                gone[(no_id, i, key)].update(range(filled[j][0], filled[j + 2][0] + 1))
            seen.setdefault(window, (no_id, i, key, j))
    out = {}
    for no_id, i, key, text in docs:
        drop = gone[(no_id, i, key)]
        out[(None if no_id else i, text)] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in drop)
    return out


def run(frame, rows):
    return [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(frame(rows, "doc_id long, text string")).collect()]


def test_later_window_goes(frame):
    out = dict((i, (t, n, k)) for i, t, n, k in run(frame, [(2, "x\na\nb\nc\ny"), (1, "a\nb\nc"), (3, "a\nb\nd")]))
    assert out == {1: ("a\nb\nc", 3, 0), 2: ("x\ny", 5, 3), 3: ("a\nb\nd", 3, 0)}


def test_overlaps_blanks_and_own_repeats(frame):
    out = dict((i, t) for i, t, _, _ in run(frame, [(1, "a\na\na\na\na"), (2, "p\n\n q \nr"), (3, "p\nq\n\n\nr\nz"), (4, "\n\n\n\n")]))
    assert out == {1: "a", 2: "p\n\n q \nr", 3: "z", 4: "\n\n\n\n"}


def test_nulls_empties_and_repeats(frame):
    rows = [(1, None), (None, "a\nb\nc"), (None, "a\nb\nc"), (5, "a\nb\nc"), (5, "a\nb\nc"), (7, "")]
    out = sorted(run(frame, rows), key=str)
    assert out == sorted(
        [(1, None, 0, 0), (None, "", 3, 3), (None, "", 3, 3), (5, "a\nb\nc", 3, 0), (5, "a\nb\nc", 3, 0), (7, "", 1, 0)], key=str
    )


def test_random_texts_as_brute_force(frame):
    rnd = random.Random(3)
    rows = [(i if i % 17 else None, "\n".join(rnd.choice(["a", "b", "c", "", " b"]) for _ in range(rnd.randrange(0, 14)))) for i in range(300)]
    expected = brute(rows)
    given = dedup_lines(frame(rows, "doc_id long, text string"))
    originals = sorted((str(i), expected[(i, t)]) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["text"]) for r in given.collect()) == originals


def test_long_text_empty_table_and_clashing_columns(frame):
    long = "\n".join(f"line {i % 40000}" for i in range(60000))
    out = run(frame, [(1, long)])
    assert out[0][2] == 60000 and out[0][3] == 20000
    assert dedup_lines(frame([], "doc_id long, text string")).count() == 0
    df = dedup_lines(frame([(1, "a", "x", 5)], "doc_id long, text string, N_Lines string, extra int"))
    assert df.columns == ["doc_id", "text", "extra", "n_lines", "n_removed", "n_windows"]
    assert df.first()["n_lines"] == 1
