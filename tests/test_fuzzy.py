import random

import pytest

from plotwright.functions.similarity import partial_ratios, ratios, register
from plotwright.operators.fuzzy import fuzzy_top1, partial_top1


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b))


def one_way(short, long):
    m = len(short)
    cuts = [long[i : i + m] for i in range(len(long) - m + 1)]
    cuts += [long[:i] for i in range(1, m)] + [long[-i:] for i in range(1, m)]
    return max(ratio(short, c) for c in cuts)


def partial(a, b):
    a, b = sorted((a, b), key=len)
    return max(one_way(a, b), one_way(b, a)) if len(a) == len(b) else one_way(a, b)


def best(queries, choices, score, reached):
    out = {}
    for q in set(queries) - {""}:
        s, c = min((-score(q, c), c) for c in set(choices) - {""})
        if reached(-s):
            out[q] = (c, round(-s, 6))
    return out


def texts(seed):
    rnd = random.Random(seed)

    def word(low, high):
        return "".join(rnd.choice("abcď") for _ in range(rnd.randint(low, high)))

    def mangled(text):
        chars = list(text)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(chars))
            if rnd.random() < 0.4:
                chars.insert(at, rnd.choice("abcď"))
            elif chars:
                chars.pop(min(at, len(chars) - 1))
        return "".join(chars)

    choices = [word(1, 16) for _ in range(150)]
    queries = [mangled(rnd.choice(choices)) for _ in range(200)]
    titles = [word(0, 6) + mangled(rnd.choice(choices)) + word(0, 8) for _ in range(100)]
    return choices, queries, titles


def collected(df):
    return {r.query: (r.choice, round(r.score, 6)) for r in df.collect()}


@pytest.mark.parametrize("cut_off", [67, 80, 85, 90, 95])
def test_no_partial_match_is_lost(spark, cut_off):
    from itertools import product

    from plotwright.operators.fuzzy import partial_candidates

    rnd = random.Random(3)

    def word(low, high):
        return "".join(rnd.choice("ab") for _ in range(rnd.randint(low, high)))

    choices = sorted({word(1, 24) for _ in range(100)} | {"abbabaa"})
    queries = sorted({word(0, 9) + rnd.choice(choices)[1:] + word(0, 9) for _ in range(120)} - {""} | {"bbababa"})
    pairs = list(product(queries, choices))
    scores = partial_ratios([a for a, _ in pairs], [b for _, b in pairs])
    wanted = {p for p, s in zip(pairs, scores) if s >= cut_off}
    q, c = (spark.createDataFrame([(x,) for x in t], "t string") for t in (queries, choices))
    found = {(r.query, r.choice) for r in partial_candidates(q, "t", c, "t", cut_off).collect()}
    assert wanted and wanted <= found


def test_a_long_text_costs_no_more_than_the_longest_choice(spark):
    from plotwright.operators.fuzzy import ratio_candidates

    choices = spark.createDataFrame([("praha",), ("brno venkov",)], "name string")
    queries = spark.createDataFrame([("x" * 2000,), ("praha " * 300,), ("prahax",)], "text string")
    assert [tuple(r) for r in ratio_candidates(queries, "text", choices, "name", 90).collect()] == [("", "prahax", "praha")]


def test_scores():
    assert ratios(["hl.m. praha", "stredocesky kraj", "abc", ""], ["hl m praha", "stredocesky", "abd", ""]).round(3).tolist() == [
        85.714,
        81.481,
        66.667,
        100.0,
    ]
    pairs = [("kladno", "byt kladno centrum"), ("abcd", "bcda"), ("ab", ""), ("praha", "prah"), ("x" * 30 + "brno", "brn")]
    found = partial_ratios([a for a, _ in pairs], [b for _, b in pairs])
    assert [round(f, 6) for f in found] == [round(partial(a, b), 6) if a and b else 0.0 for a, b in pairs]


def native_indel_ratio(left, right):
    """The ratio from array functions alone, one table row of the LCS per step."""
    from pyspark.sql import functions as F

    chars = F.split(right, "")
    start = F.array_repeat(F.lit(0), F.length(right) + 1)

    def step(row, letter):
        def cell(done, j):
            up, corner, before = F.get(row, j + 1), F.get(row, j), F.get(done, j)
            here = F.when(F.get(chars, j) == letter, corner + 1).otherwise(F.greatest(up, before))
            return F.concat(done, F.array(here))

        return F.aggregate(F.sequence(F.lit(0), F.length(right) - 1), F.array(F.lit(0)), cell)

    rows = F.aggregate(F.split(left, ""), start, step)
    total = F.length(left) + F.length(right)
    return (
        F.when(total == 0, F.lit(100.0))
        .when((F.length(left) == 0) | (F.length(right) == 0), F.lit(0.0))
        .otherwise(F.lit(200.0) * F.get(rows, F.length(right)) / total)
    )


def test_native_ratio_agrees(spark):
    choices, queries, _ = texts(3)
    pairs = [(a, b) for a, b in zip(choices, queries)] + [("", "a"), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", native_indel_ratio(*_columns()).alias("s"))
    expected = ratios([a for a, _ in pairs], [b for _, b in pairs])
    assert sorted((r.a, r.b, round(r.s, 9)) for r in df.collect()) == sorted(
        (a, b, round(e, 9)) for (a, b), e in zip(pairs, expected)
    )


def _columns():
    from pyspark.sql import functions as F

    return F.col("a"), F.col("b")


def test_sql_functions(spark):
    register(spark)
    row = spark.sql("SELECT indel_ratio('abc', 'abd') AS r, indel_partial_ratio('brno', 'byt brno') AS p").first()
    assert (round(row.r, 3), row.p) == (66.667, 100.0)


@pytest.mark.parametrize("cut_off, strict", [(90, False), (90, True), (70, False)])
def test_top1_is_exact(spark, cut_off, strict):
    choices, queries, _ = texts(cut_off)
    q, c = (spark.createDataFrame([(x,) for x in xs], "t string") for xs in (queries, choices))
    expected = best(queries, choices, ratio, lambda s: s > cut_off if strict else s >= cut_off)
    assert expected and collected(fuzzy_top1(q, "t", c, "t", cut_off, strict)) == expected


@pytest.mark.parametrize("cut_off", [85, 72])
def test_partial_top1_is_exact(spark, cut_off):
    choices, _, titles = texts(cut_off)
    q, c = (spark.createDataFrame([(x,) for x in xs], "t string") for xs in (titles, choices))
    expected = best(titles, choices, partial, lambda s: s >= cut_off)
    assert expected and collected(partial_top1(q, "t", c, "t", cut_off)) == expected


def test_blocks_keep_choices_apart(spark):
    q = spark.createDataFrame([("x", "lidicka"), ("y", "lidicka"), ("z", "lidicka")], "b string, t string")
    c = spark.createDataFrame([("x", "lidicka"), ("x", "lidicke"), ("y", "lidick")], "b string, t string")
    found = fuzzy_top1(q, "t", c, "t", 89, True, "b", "b").collect()
    assert {(r.block, r.choice) for r in found} == {("x", "lidicka"), ("y", "lidick")}


def test_cut_off_is_checked(spark):
    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(ValueError):
        fuzzy_top1(df, "t", df, "t", 50)
