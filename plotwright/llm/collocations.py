"""Phrase collocations: Misra-Gries summaries of hash partitions find what may be frequent, a second pass counts exactly."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import ASKED, lookup_join
from ..session import materialized
from .common import shuffle_partitions

THRESHOLD = 100
LONGEST = 5
TOP = 2000
# Bytes of text counted together; bounds a worker's memory.
CHUNK_BYTES = 4_000_000
# Words of text for each hash partition of the summaries, on average.
BUCKET_WORDS = 2_000_000
# Counters of a summary at least; twice its mass divided by the threshold where that is more.
COUNTERS = 1 << 16
# Bits of the filter that survivors are kept in, over all partitions. It does not grow with the data: when it fills up
# more phrases are counted exactly that turn out rare, and no result changes.
FILTER_BITS = 1 << 27
# Phrases that a task counts before it sends them on.
HELD = 200_000
# Parts of a language whose first phrases are ranked on their own before they are ranked together.
SALTS = 64

_UNKNOWN = "und"
# A-Z in lower case; the marks that end a piece become 0xFF, which no UTF-8 text holds, and tabs blanks.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_END = b"\xff"


def tokens_of(text: bytes) -> list[bytes]:
    """The words of a text and `_END` after each piece. No other blank than space is left to split at."""
    return (text.translate(_BYTES) + _END).replace(_END, b" \xff ").split()


class Chunk:
    """The words of some texts as numbers (0: end of a piece), with a hash for each; languages share no number."""

    def __init__(self, texts: list[bytes | None], langs: list[bytes]) -> None:
        counter = count(1)
        numbers: defaultdict[bytes, defaultdict[bytes, int]] = defaultdict(partial(_numbering, counter))
        parts = []
        for text, lang in zip(texts, langs, strict=True):
            parts.append(np.fromiter(map(numbers[lang].__getitem__, tokens_of(text or b"")), np.int64))
        self.ids = np.concatenate([*parts, np.zeros(1, np.int64)])
        size = next(counter)
        self.words, self.langs, self.hashes = [b""] * size, [b""] * size, np.zeros(size, np.uint64)
        for lang, known in numbers.items():
            for word, i in known.items():
                if i:
                    self.words[i], self.langs[i] = word, lang
                    self.hashes[i] = xxhash.xxh64_intdigest(lang + b"\0" + word)

    def phrase(self, at: int, size: int) -> tuple[bytes, bytes]:
        ids = self.ids[at : at + size].tolist()
        return self.langs[ids[0]], b" ".join([self.words[i] for i in ids])


def _numbering(counter: Iterator[int]) -> defaultdict[bytes, int]:
    known: defaultdict[bytes, int] = defaultdict(counter.__next__)
    known[_END] = 0
    return known


class Survivors:
    """A bitmap of the phrases that may be frequent, a stretch of it for each hash partition."""

    def __init__(self, buckets: int, bits: int) -> None:
        self.buckets = buckets
        self.stretch = max(8, bits // buckets // 8 * 8)
        self.bits = np.zeros(self.buckets * self.stretch // 8, np.uint8)

    def add(self, bucket: int, stretch: bytes) -> None:
        at = bucket * self.stretch // 8
        self.bits[at : at + self.stretch // 8] |= np.frombuffer(stretch, np.uint8)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        bucket, low = _dealt(hashes, self.buckets)
        at = bucket * self.stretch + _spot(low, self.stretch)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition of each hash, by its upper half, and the lower half that names it there."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return bucket.astype(np.int64), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _spot(low: np.ndarray, stretch: int) -> np.ndarray:
    return ((low.astype(np.uint64) * np.uint64(stretch)) >> np.uint64(32)).astype(np.int64)


def levels(chunk: Chunk, longest: int, known: Survivors | None, upto: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, hashes, counts, where each first stands) of the distinct phrases of 1 to `longest` words.

    A phrase is looked at only if the two it holds that are one word shorter were; up to `upto` words those
    that `known` cannot hold are passed over.
    """
    ids, words = chunk.ids, np.int64(len(chunk.words))
    starts = np.flatnonzero(ids)
    number, hashes = np.zeros(len(ids), np.int64), np.zeros(1, np.uint64)
    for size in range(1, longest + 1):
        key = number[starts] * words + ids[starts + size - 1]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
        first = starts[order[begins]]
        counts = np.diff(np.append(begins, len(ranked)))
        hashes = _mixed(hashes[number[first]] * np.uint64(0x9E3779B97F4A7C15) + chunk.hashes[ids[first + size - 1]] + np.uint64(size))
        good = known.may_hold(hashes) if known is not None and size <= upto else np.ones(len(hashes), bool)
        yield size, hashes[good], counts[good], first[good]
        which = np.repeat(np.arange(len(begins)), counts)
        number[starts[order]] = which
        stays = np.zeros(len(ids) + 1, bool)
        stays[starts[order][good[which]]] = True
        starts = np.flatnonzero(stays[:-1] & stays[1:])
        # The next word must belong to the piece; the last number of all is an end.
        starts = starts[ids[np.minimum(starts + size, len(ids) - 1)] != 0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    """Texts and languages of the batches, about `size` bytes at a time."""
    texts, langs, held = [], [], 0
    for batch in batches:
        names = batch.column(1).cast(pa.binary())
        for at in range(0, batch.num_rows, 500):
            part = batch.column(0).slice(at, 500).cast(pa.binary()).to_pylist()
            for text, lang in zip(part, names.slice(at, 500).to_pylist(), strict=True):
                texts.append(text)
                langs.append(lang)
                held += len(text or b"")
                if held >= size:
                    yield Chunk(texts, langs)
                    texts, langs, held = [], [], 0
    if texts:
        yield Chunk(texts, langs)


SUMMARY = "bucket int, keys binary, counts binary"
STRETCH = "bucket int, bits binary"
PARTS = "bucket int, langs array<string>, phrases array<string>, sizes array<int>, counts array<long>"
COUNTED = "lang string, phrase string, size int, f long"


def _summarizer(sizes: range, known: Survivors | None, buckets: int, chunk_bytes: int):
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            found = [(h, c) for n, h, c, _ in levels(chunk, sizes[-1], known, sizes[0] - 1) if n in sizes]
            hashes, counts = np.concatenate([h for h, _ in found]), np.concatenate([c for _, c in found])
            order = np.argsort(hashes)
            bucket, low = _dealt(hashes[order], buckets)
            counts = counts[order].astype(np.uint32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            parts = [slice(cuts[b], cuts[b + 1]) for b in full.tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(full, pa.int32()),
                    "keys": pa.array([low[p].tobytes() for p in parts], pa.binary()),
                    "counts": pa.array([counts[p].tobytes() for p in parts], pa.binary()),
                }
            )

    return summarize


def merged(keys: list[np.ndarray], counts: list[np.ndarray], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries summaries as one of `capacity` counters, and by how much its counts may be too low.

    Equal keys are added up; where more than `capacity` counters are left, the largest of those too many is
    taken from each, and what is not above 0 goes. The counts of one merge are too low by no more than
    (mass that went) / (capacity + 1).
    """
    every, number = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    begins = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
    every, number = every[begins], np.add.reduceat(number, begins) if len(begins) else number
    if len(every) <= capacity:
        return every, number, 0
    lost = int(np.partition(number, len(number) - capacity - 1)[len(number) - capacity - 1])
    stays = number > lost
    return every[stays], number[stays] - lost, lost


def summary_of(parts: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """All parts merged into one summary, some at a time."""
    keys, counts, lost = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    waiting, size = [], 0
    for i, part in enumerate(parts):
        waiting.append(part)
        size += len(part[0])
        if size >= 4 * capacity or i + 1 == len(parts):
            keys, counts, more = merged([keys, *[k for k, _ in waiting]], [counts, *[c for _, c in waiting]], capacity)
            lost += more
            waiting, size = [], 0
    return keys, counts, lost


def _merger(threshold: int, stretch: int, counters: int):
    def merge(table: pa.Table) -> pa.Table:
        parts = [
            (np.frombuffer(k, np.uint32), np.frombuffer(c, np.uint32).astype(np.int64))
            for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)
        ]
        mass = sum(int(c.sum()) for _, c in parts)
        keys, counts, lost = summary_of(parts, max(counters, 2 * mass // threshold + 1))
        bits = np.zeros(stretch, bool)
        if lost >= threshold:
            # Cannot be by the capacity; were it so, all would go on to be counted.
            bits[:] = True
        bits[_spot(keys[counts + lost >= threshold], stretch)] = True
        return pa.table({"bucket": table["bucket"][:1].cast(pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return merge


def _counter(longest: int, known: Survivors, buckets: int, chunk_bytes: int):
    """Counts of a task's texts, added up over its chunks; sent on in parts where there are more than HELD of them."""

    def rows(counts: dict[tuple[bytes, bytes, int], int]) -> pa.RecordBatch:
        langs, phrases, sizes = zip(*counts, strict=True) if counts else ((), (), ())
        names = np.fromiter((xxhash.xxh64_intdigest(lang + b"\0" + p) for lang, p in zip(langs, phrases, strict=True)), np.uint64, len(langs))
        bucket, _ = _dealt(names, buckets)
        order = np.argsort(bucket, kind="stable")
        full = np.unique(bucket)
        cuts = pa.array(np.append(np.searchsorted(bucket[order], full), len(order)), pa.int32())
        columns = {
            "langs": pa.array(langs, pa.binary()).cast(pa.string()),
            "phrases": pa.array(phrases, pa.binary()).cast(pa.string()),
            "sizes": pa.array(sizes, pa.int32()),
            "counts": pa.array(counts.values(), pa.int64()),
        }
        lists = {n: pa.ListArray.from_arrays(cuts, c.take(pa.array(order))) for n, c in columns.items()}
        return pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int32())} | lists)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: defaultdict[tuple[bytes, bytes, int], int] = defaultdict(int)
        for chunk in _chunks(batches, chunk_bytes):
            number, times = np.unique(chunk.ids, return_counts=True)
            for i, n in zip(number.tolist(), times.tolist(), strict=True):
                if i:
                    counts[chunk.langs[i], b"", 0] += n
            for size, _, times, first in levels(chunk, longest, known, longest):
                for at, n in zip(first.tolist(), times.tolist(), strict=True):
                    counts[*chunk.phrase(at, size), size] += n
            if len(counts) > HELD:
                yield rows(counts)
                counts.clear()
        yield rows(counts)

    return exact


def _adder(threshold: int):
    def add(table: pa.Table) -> pa.Table:
        lists = {n: table[c].combine_chunks().flatten() for n, c in (("lang", "langs"), ("phrase", "phrases"), ("size", "sizes"), ("f", "counts"))}
        total = pa.table(lists).group_by(["lang", "phrase", "size"]).aggregate([("f", "sum")]).rename_columns(["lang", "phrase", "size", "f"])
        return total.filter((pc.field("size") == 0) | (pc.field("f") >= threshold))

    return add


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    chunk_bytes: int = CHUNK_BYTES,
    counters: int = COUNTERS,
) -> DataFrame:
    """(lang, phrase, size, f): phrases of 1 to `longest` words that occur `threshold` times or more in a language.

    The empty phrase of size 0 has the number of all words of the language.
    """
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(_UNKNOWN)).alias("lang"))
    spark = docs.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word has a byte and one that ends it at least, mostly more; this only settles the number of partitions.
    buckets = max(shuffle_partitions(spark), 32, size // (4 * BUCKET_WORDS))
    known = Survivors(buckets, FILTER_BITS)
    earlier = None
    for sizes in (range(1, min(2, longest) + 1), range(3, longest + 1)):
        if not sizes:
            continue
        parts = texts.mapInArrow(_summarizer(sizes, earlier, buckets, chunk_bytes), SUMMARY)
        stretches = parts.groupBy("bucket").applyInArrow(_merger(threshold, known.stretch, counters), STRETCH)
        # All stretches together are FILTER_BITS, whatever the data.
        for row in stretches.collect():
            known.add(row["bucket"], row["bits"])
        earlier = known
    counted = texts.mapInArrow(_counter(longest, known, buckets, chunk_bytes), PARTS)
    return materialized(counted.groupBy("bucket").applyInArrow(_adder(threshold), COUNTED), "phrases")


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,0)")


def _inner(words: Column, size: Column, width: int) -> Column:
    """The phrases of `width` words inside one of more than that; none in a shorter one."""
    last = F.when(size > width, size - width)
    phrases = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, width), " "))
    return F.coalesce(phrases, F.array().cast("array<string>"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
    counters: int = COUNTERS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` collocations of each language.

    A-Z are lower-cased; `.,;:!?` and the line ends \\n to \\r cut texts into pieces, spaces and tabs pieces into words.
    A candidate is a phrase of 2 to `longest` words with `a` >= `threshold` occurrences within pieces, overlaps
    included. Of its cuts into a first part (`l` occurrences) and a rest (`r`), the one of the lowest score
    floor(1000 a n / (l r)) counts, of equal ones the first; `n` is the number of words of the language. Candidates that
    lie within a longer candidate of as many occurrences go, dropped or not. Ranks go by score, then `a`,
    downwards, then by phrase in byte order. Products are exact decimals, for counts below 10^18 and words below 10^16.

    Null languages are `und`; null and empty texts have no words; a language without words has no rows. Rows that repeat
    count as often as they stand there. Other columns are not looked at; `lang` is always text.

    A first pass summarizes phrases by hash partition: each chunk of texts sends its counts to the partitions, which
    merge them into Misra-Gries summaries with more counters than mass / threshold, so that no phrase of
    `threshold` occurrences is lost; first for one and two words, then for longer phrases whose pairs of words survived. What
    survives is kept in a bitmap of fixed size, all that passes through the driver. A second pass counts exactly what the
    bitmap lets through, by the phrase itself, in the same partitions; a frequent phrase is an entry a task. Chunks and partitions
    grow in number with the input, not in size, but for single texts beyond a chunk.
    """
    phrases = frequent_phrases(docs, text_col, lang_col, threshold, longest, chunk_bytes, counters)
    # One language may have most of the phrases, so it is looked up as a hot key.
    words = phrases.where("size = 0").select("lang", F.col("f").alias("n"), F.col("f").alias(ASKED))
    counts = phrases.where("size > 0")
    split = F.split("phrase", " ")
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), split.alias("words"))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.array_join(F.slice("words", 1, F.col("k")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " "))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = lookup_join(cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]), words, ["lang"])
    above = F.lit(1000).cast("decimal(4,0)") * (_exact("a") * F.col("n").cast("decimal(16,0)"))
    cuts = cuts.withColumns({"above": above, "below": _exact("l") * _exact("r")}).withColumn("score", F.expr("above div below"))
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    parts = [_inner(F.col("words"), F.col("size"), width) for width in range(2, longest)]
    if parts:
        within = found.select("lang", "a", F.explode(F.array_distinct(F.concat(*parts))).alias("phrase"))
        within = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        lowest = lowest.join(within, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    rows = lowest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
