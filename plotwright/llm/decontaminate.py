"""Benchmark decontamination: multi-pattern search for word windows with block shift tables."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .common import with_fields, words_of

WINDOW = 10
BLOCK = 2
# Words of test items that one search table may hold, about 100 bytes each.
TABLE_WORDS = 400_000

FOUND = "n_words long, n_hit long, spans array<struct<first:long,last:long>>, items array<string>"


class Search:
    """Finds every occurrence of patterns of one length in a list of words.

    `shift` says for a block of words how far the window may move when it ends in that
    block; blocks that no pattern holds allow the longest move. Where the shift is 0, the
    patterns whose last block hashes to the same bucket are compared word by word.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], length: int, block: int) -> None:
        self.length = length
        self.block = block = min(block, length)
        self.furthest = length - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list[tuple[tuple[bytes, ...], set[str]]]]] = defaultdict(lambda: defaultdict(list))
        for pattern, owners in patterns.items():
            for end in range(block, length + 1):
                key = pattern[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.furthest), length - end)
            self.buckets[pattern[length - block :]][pattern[0]].append((pattern, owners))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(place of the first word, items that have the window) in order of place."""
        length, block, furthest, shift = self.length, self.block, self.furthest, self.shift
        end, count = length, len(words)
        while end <= count:
            key = tuple(words[end - block : end])
            step = shift.get(key, furthest)
            if step:
                end += step
                continue
            start = end - length
            for pattern, owners in self.buckets[key].get(words[start], ()):
                if all(words[start + i] == w for i, w in enumerate(pattern)):
                    yield start, owners
            end += 1


def _searches(items: list[tuple[str, str]], window: int, block: int) -> list[Search]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item_id, text in items:
        words = tuple(words_of(text))
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            by_length[size][words[i : i + size]].add(item_id)
    return [Search(patterns, size, block) for size, patterns in sorted(by_length.items())]


def _find(texts: pa.Array, searches: list[Search]) -> pa.Array:
    n_words, n_hit, spans, items = [], [], [], []
    for text in texts.to_pylist():
        words = words_of(text)
        owners: set[str] = set()
        found = []
        for search in searches:
            for start, whose in search.occurrences(words):
                found.append((start, start + search.length - 1))
                owners |= whose
        merged: list[list[int]] = []
        for first, last in sorted(found):
            if merged and first <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        n_words.append(len(words))
        n_hit.append(sum(b - a + 1 for a, b in merged))
        spans.append([{"first": a, "last": b} for a, b in merged])
        items.append(sorted(owners))
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
        ["n_words", "n_hit", "spans", "items"],
    )


def _finder(items: list[tuple[str, str]], window: int, block: int):
    built: list[Search] = []

    @F.arrow_udf(FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not built:
            built.extend(_searches(items, window, block))
        for texts in batches:
            yield _find(texts, built)

    return find


def _merged(old: Column, new: Column) -> Column:
    """Two sorted lists of disjoint spans as one, overlapping and touching spans joined."""
    both = F.array_sort(F.concat(old, new))
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def add(acc: Column, span: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"))
        meets = (F.size(acc) > 0) & (span["first"] <= F.try_element_at(acc, F.lit(-1))["last"] + 1)
        return F.when(meets, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(span)))

    return F.aggregate(both, empty, add)


def find_test_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """`docs` with the word windows of test `items` that their texts hold.

    A-Z are lower-cased; words are runs of digits, a-z and characters beyond ASCII. A window is
    `window` consecutive words of an item; an item with fewer words, but not none, is one window.
    Adds `n_words`, `n_hit` (words inside any occurrence), `spans` (those words as merged places,
    counted from 0) and `items` (ids, as strings in order, of items with an occurring window);
    input columns of these names are replaced. Null and empty texts have no words, null and
    empty items no windows, an item with a null id is called by the empty string; repeated rows
    of either side change nothing.

    The test items are searched in tables of about `table_words` words: small sets take one pass,
    larger ones are dealt by hash to as many tables as they need, which the texts go through one
    after the other, written to the shared folder in between. Driver and workers hold one table at a time, which
    is bounded, but for a single item beyond it; the documents are never shuffled.
    """
    known = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")).where(
        F.col("text").isNotNull() & (F.col("text") != "")
    )
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    # A word has at least two characters with its separator, so this bounds the words.
    tables = max(1, math.ceil(total / (2 * table_words)))
    fields = ["n_words", "n_hit", "spans", "items"]
    out = None
    for part in range(tables):
        chosen = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(tables)) == part).distinct()
        rows = [(r["id"], r["text"]) for r in chosen.collect()]
        answer = _finder(rows, window, block)(F.col(text_col))
        if out is None:
            out = with_fields(docs, answer, fields)
            # The next table is collected once this one's answers are written, so neither driver nor workers hold two.
            out = materialized(out, "test-items") if tables > 1 else out
            continue
        out = out.withColumn("__more", answer)
        spans = _merged(F.col("spans"), F.col("__more.spans"))
        out = (
            out.withColumn("spans", spans)
            .withColumn("items", F.array_sort(F.array_union("items", F.col("__more.items"))))
            .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1))
            .drop("__more")
        )
        out = materialized(out, "test-items") if part + 1 < tables else out
    return out
