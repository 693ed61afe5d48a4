"""Best fuzzy match against a list of choices, by equi-join instead of all pairs.

Two texts whose score reaches the cut-off differ by at most D inserted or deleted
characters. A choice cut into D + 1 segments therefore keeps one of them intact
inside every text it matches: segments are the join keys, and no match is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import indel_partial_ratio, indel_ratio
from ..session import spread

# Below this cut-off a short text could be left with no intact segment.
LOWEST_CUT_OFF = 67


def _check(cut_off: int) -> None:
    if int(cut_off) != cut_off or not LOWEST_CUT_OFF <= cut_off <= 100:
        raise ValueError(f"cut_off must be a whole number from {LOWEST_CUT_OFF} to 100")


def _segment_count(length: str, t: int) -> str:
    """SQL for D + 1, D taken against the longest text that can still match."""
    return f"(({100 - t} * ({length} + ({length} * {200 - t}) div {t})) div 100 + 1)"


def _choice_keys(text: str, block: str, t: int) -> Column:
    m = f"length({text})"
    n = _segment_count(m, t)
    return F.expr(
        f"""transform(sequence(0, {n} - 1), i ->
              xxhash64({block}, cast({m} as int), cast(i as int), substr({text}, (i * {m}) div {n} + 1,
                       ((i + 1) * {m}) div {n} - (i * {m}) div {n})))"""
    )


def _query_keys(text: str, block: str, t: int) -> Column:
    """Every placement of every segment that has to be tried, for each length of a matching choice.

    Only lengths in `_lengths`, those that some choice has, are tried, so a long text costs no more
    than the longest choice allows.

    Count the differences before each segment. From segment to segment the count minus
    the segment number starts at 0, ends below 0 and falls by at most 1, so some intact
    segment i has exactly i differences before it and at most D - i after it. Its shift
    is then one of -i, -i + 2 .. i, and the rest of the length difference is at most D - i.
    """
    r = f"length({text})"
    n = _segment_count("m", t)
    begin, size = f"((i * m) div {n})", f"(((i + 1) * m) div {n} - (i * m) div {n})"
    budget = f"(({100 - t} * (m + {r})) div 100)"
    tried = f"abs({r} - m - s) <= {budget} - i AND {begin} + s >= 0 AND {begin} + s <= {r} - {size}"
    shifts = f"filter(sequence(-i, i, 2), s -> {tried})"
    return F.expr(
        f"""flatten(transform(
              filter(_lengths, m -> m >= ceil({r} * {t} / {200 - t}) AND m <= ({r} * {200 - t}) div {t}), m ->
              flatten(transform(sequence(0, cast({n} as int) - 1), i ->
              transform({shifts}, s -> xxhash64({block}, cast(m as int), cast(i as int),
                        substr({text}, cast({begin} + s as int) + 1, cast({size} as int))))))))"""
    )


def _distinct_texts(df: DataFrame, text: str, block: str | None, name: str) -> DataFrame:
    key = F.col(block) if block else F.lit("")
    out = df.select(key.cast("string").alias(f"_{name}_block"), F.col(text).alias(name))
    return out.where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def _unbroadcast(keyed: DataFrame) -> DataFrame:
    """Keep a key join shuffled: Spark guesses sizes from before the texts were multiplied into keys.

    A key that many texts share then makes a large partition, which Spark splits at run time.
    """
    return keyed.hint("merge")


def _best(scored: DataFrame, cut_off: int, strict: bool) -> DataFrame:
    """Highest score per query, the first name in order among equals."""
    kept = scored.where(F.col("score") > cut_off if strict else F.col("score") >= cut_off)
    best = kept.groupBy("block", "query").agg(F.min(F.struct((-F.col("score")).alias("s"), "choice")).alias("b"))
    return best.select("block", "query", F.col("b.choice").alias("choice"), (-F.col("b.s")).alias("score"))


def ratio_candidates(
    queries: DataFrame, query: str, choices: DataFrame, choice: str, cut_off: int,
    query_block: str | None = None, choice_block: str | None = None,
) -> DataFrame:
    """(block, query, choice): all pairs at or above the cut-off, and few below it."""
    _check(cut_off)
    t = int(cut_off)
    q = _distinct_texts(queries, query, query_block, "query")
    c = _distinct_texts(choices, choice, choice_block, "choice")
    lengths = c.agg(F.collect_set(F.length("choice"))).scalar()
    q = spread(q, "query").withColumn("_lengths", lengths)
    q = q.select("_query_block", "query", F.explode(_query_keys("query", "_query_block", t)).alias("_qk"))
    c = c.select("*", F.explode(_choice_keys("choice", "_choice_block", t)).alias("_ck"))
    budget = F.expr(f"({100 - t} * (length(query) + length(choice))) div 100")
    pairs = _unbroadcast(q).join(c, (q["_qk"] == c["_ck"]) & (q["_query_block"] == c["_choice_block"]))
    # An edit script of insertions and deletions is never shorter than the Levenshtein distance.
    pairs = pairs.where(F.levenshtein("query", "choice") <= budget)
    return pairs.select(F.col("_query_block").alias("block"), "query", "choice").distinct()


def fuzzy_top1(
    queries: DataFrame, query: str, choices: DataFrame, choice: str, cut_off: int, strict: bool = False,
    query_block: str | None = None, choice_block: str | None = None,
) -> DataFrame:
    """(block, query, choice, score): the best choice by ratio for each distinct query text.

    With block columns only choices of the query's own block compete. `strict` asks for
    a score above, not at, the cut-off.
    """
    pairs = ratio_candidates(queries, query, choices, choice, cut_off, query_block, choice_block)
    return _best(pairs.withColumn("score", indel_ratio("query", "choice")), cut_off, strict)


def partial_damage(length: int, t: int) -> int:
    """Most insertions and deletions between a text and a window that still score t."""
    full = 2 * ((100 - t) * length // 100)
    shorter = (100 - t) * (2 * length - 1) // 100
    return max(full, shorter if shorter % 2 else shorter - 1, 0)


def _partial_damage_sql(m: str, t: int) -> str:
    shorter = f"(({100 - t} * (2 * {m} - 1)) div 100)"
    return f"greatest(2 * (({100 - t} * {m}) div 100), {shorter} - if({shorter} % 2 = 1, 0, 1), 0)"


def _partial_segments(text: str, t: int) -> Column:
    """(segment, place) of each segment."""
    m = f"length({text})"
    n = f"cast({_partial_damage_sql(m, t)} + 1 as int)"
    return F.expr(
        f"""transform(sequence(0, {n} - 1), i -> struct(
              substr({text}, cast((i * {m}) div {n} + 1 as int),
                     cast(((i + 1) * {m}) div {n} - (i * {m}) div {n} as int)) as segment,
              cast((i * {m}) div {n} + 1 as int) as place))"""
    )


def _segment_lengths(t: int) -> list[int]:
    """Segment lengths that occur.

    A text of m characters has at least 2 * ((100 - t) * m // 100) + 1 segments. With m = q * 100 / (100 - t) + r
    that is 2 * q + 1, so the mean segment is near 50 / (100 - t) characters and the farther from it the
    smaller q is: all lengths occur while q is 0 to 3, that is up to 400 / (100 - t) characters.
    """
    found = set()
    for m in range(1, 4 * -(-100 // (100 - t)) + 1):
        n = partial_damage(m, t) + 1
        found |= {m // n, -(-m // n)}
    return sorted(found)


def _substrings(text: str, t: int) -> Column:
    """(segment, place) of every substring that can be a segment of a shorter text."""
    parts = [
        f"if(length({text}) >= {size}, transform(sequence(1, length({text}) - {size - 1}), p -> struct(substr({text}, p, {size})"
        f" as segment, p as place)), cast(array() as array<struct<segment:string,place:int>>))"
        for size in _segment_lengths(t)
    ]
    return F.expr(f"concat({', '.join(parts)})")


def partial_candidates(queries: DataFrame, query: str, choices: DataFrame, choice: str, cut_off: int) -> DataFrame:
    """(block, query, choice): all pairs whose best window reaches the cut-off, and some below it.

    The shorter text of a pair is the one cut into segments, so the join runs once for
    choices no longer than the query and once for those no shorter; of two texts of one
    length, either may have its best window in the other.
    """
    _check(cut_off)
    if cut_off == 100:
        raise ValueError("a cut-off of 100 is containment; use a plain join")
    t = int(cut_off)
    q = spread(_distinct_texts(queries, query, None, "query"), "query")
    c = spread(_distinct_texts(choices, choice, None, "choice"), "choice")

    def keyed(df: DataFrame, keys: Column) -> DataFrame:
        return df.select(df.columns[1], F.inline(keys))

    def role(short: str, short_rows: DataFrame, long: str, long_rows: DataFrame, lengths: Column) -> DataFrame:
        """Pairs whose shorter text keeps a segment intact, and may find its letters around that place."""
        b, p, m, whole = F.col("_short_place"), F.col("_long_place"), F.length(short), F.length(long)
        begin = p - b + 1

        def around(shift: Column) -> Column:
            """The part of the longer text that a window can lie in, if the segment moved by `shift` at most."""
            first = F.greatest(F.lit(1), begin - shift)
            return F.substr(F.col(long), first, begin + m + shift - first)

        def missing(part: Column) -> Column:
            return F.length(F.call_function("translate", F.col(short), part, F.lit("")))

        def broken(part: Column) -> Column:
            """Neighboring letters that the part does not have: a dropped letter breaks two pairs, an inserted one breaks one."""
            places = F.sequence(F.lit(1), F.greatest(m - 1, F.lit(1)))
            return F.size(F.filter(places, lambda i: ~F.contains(part, F.substr(F.col(short), i, F.lit(2)))))

        # A window of the text's length drops as many letters as it inserts. A shorter one, at either end of the
        # longer text, drops more than it inserts.
        same = F.floor((100 - t) * m / 100).cast("int")
        most = F.floor((200 - 2 * t) * m / (200 - t)).cast("int")
        inner = (missing(around(same)) <= same) & (broken(around(same)) <= 3 * same)
        at_end = (begin <= 1 + most) | (begin + m - 1 + most >= whole)
        outer = at_end & (missing(around(most)) <= most) & (broken(around(most)) <= F.greatest(3 * most - 1, F.lit(0)))
        reachable = inner | outer
        left = long_rows.withColumnRenamed("place", "_long_place")
        right = short_rows.select(short, F.col("segment").alias("_segment"), F.col("place").alias("_short_place"))
        pairs = _unbroadcast(left).join(right, left["segment"] == right["_segment"]).where(lengths & reachable)
        return pairs.select(F.lit("").alias("block"), "query", "choice")

    inside = role(
        "choice", keyed(c, _partial_segments("choice", t)), "query", keyed(q, _substrings("query", t)),
        F.length("choice") <= F.length("query"),
    )
    around = role(
        "query", keyed(q, _partial_segments("query", t)), "choice", keyed(c, _substrings("choice", t)),
        F.length("choice") >= F.length("query"),
    )
    return inside.union(around).distinct()


def partial_top1(
    queries: DataFrame, query: str, choices: DataFrame, choice: str, cut_off: int, strict: bool = False
) -> DataFrame:
    """(block, query, choice, score): the best choice by best-window ratio for each distinct query text."""
    pairs = partial_candidates(queries, query, choices, choice, cut_off)
    return _best(pairs.withColumn("score", indel_partial_ratio("query", "choice")), cut_off, strict)
