"""Substring dedup: non-overlapping blocks anchor exact repeats, rolling windows find them, hits grow to whole repeats."""

from __future__ import annotations

from collections import defaultdict
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

WINDOW = 13
# Characters of the documents that are probed together; bounds a worker's memory.
CHUNK_CHARS = 6_000_000
# Chunks whose anchors one bucket of the index takes, on average.
CHUNKS_A_BUCKET = 2

_FACTOR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# An anchor's entry in the index: 30 bits of its hash, is it a block, is it in several documents of its chunk.
_BLOCK, _SEVERAL = np.uint32(2), np.uint32(1)


class Words(NamedTuple):
    """The words of a chunk: two hashes each, the document they are in, their place there and how many words are left."""

    hashes: tuple[np.ndarray, np.ndarray]
    doc: np.ndarray
    place: np.ndarray
    left: np.ndarray
    sizes: np.ndarray


def words_of(text: bytes | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+`, unchanged: bytes are split at just these six."""
    return text.split() if text else []


def read_words(texts: list[bytes | None]) -> Words:
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts = [np.fromiter(map(numbers.__getitem__, words_of(t)), np.int32) for t in texts]
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), np.uint64).reshape(-1, 2)
    number = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    place = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return Words(
        (halves[number, 0], halves[number, 1]),
        np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
        place.astype(np.int32),
        (np.repeat(sizes, sizes) - place).astype(np.int32),
        sizes,
    )


def rolled(words: Words, width: int, half: int = 0) -> np.ndarray:
    """For each place the hash of the `width` words from there on (of no meaning where fewer are left)."""
    word = words.hashes[half]
    out = np.zeros(len(word), np.uint64)
    for k in range(min(width, len(word))):
        stop = len(word) - k
        out[:stop] = out[:stop] * _FACTOR[half] + word[k:]
    out = (out ^ (out >> np.uint64(30))) * _MIX[0]
    out = (out ^ (out >> np.uint64(27))) * _MIX[1]
    return out ^ (out >> np.uint64(31))


def _runs(ranked: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)


def _cuts(ranked: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted hashes are dealt to buckets by their upper half, so each bucket is a stretch of them."""
    bucket = ((ranked >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


class Probes(NamedTuple):
    """The distinct anchor hashes of a chunk, sorted; `starts[k]` has the one numbered `which[k]`."""

    found: np.ndarray
    entries: np.ndarray
    starts: np.ndarray
    which: np.ndarray


def probes_of(words: Words, window: int, block: int) -> Probes:
    """Every rolling window of `block` words, in documents that have a window at all."""
    starts = np.flatnonzero((words.left >= block) & (words.place + words.left >= window))
    hashes = rolled(words, block)[starts]
    order = np.argsort(hashes)
    ranked, starts = hashes[order], starts[order]
    begins = _runs(ranked)
    if not len(begins):
        return Probes(ranked, np.zeros(0, np.uint32), starts, np.zeros(0, np.int64))
    doc = words.doc[starts]
    several = np.maximum.reduceat(doc, begins) != np.minimum.reduceat(doc, begins)
    is_block = np.logical_or.reduceat(words.place[starts] % block == 0, begins)
    found = ranked[begins]
    entries = (found << np.uint64(2)).astype(np.uint32) | np.where(is_block, _BLOCK, 0).astype(np.uint32) | several.astype(np.uint32)
    which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(ranked))))
    return Probes(found, entries, starts, which)


class Hits(NamedTuple):
    """The distinct windows around a chunk's anchors, sorted by hash; `starts[k]` has the one numbered `which[k]`."""

    hashes: np.ndarray
    checks: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    which: np.ndarray


def extended(words: Words, ids: np.ndarray, anchored: np.ndarray, window: int, block: int) -> Hits:
    """Anchors grow to every window that holds them; `first` is the smallest id of the chunk with the window."""
    marks = np.zeros(len(words.doc) + 1, np.int64)
    marks[anchored + 1] = 1
    marks = np.cumsum(marks)
    starts = np.flatnonzero(words.left >= window)
    starts = starts[marks[starts + window - block + 1] > marks[starts]]
    hashes, checks = rolled(words, window)[starts], (rolled(words, window, 1)[starts] >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(hashes)
    hashes, checks, starts = hashes[order], checks[order], starts[order]
    if not len(starts):
        return Hits(hashes, checks, np.zeros(0, np.int64), starts, np.zeros(0, np.int64))
    begins = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1]))))
    first = np.minimum.reduceat(ids[words.doc[starts]], begins)
    which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(starts))))
    return Hits(hashes[begins], checks[begins], first, starts, which)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(parts: list[bytes], cuts: np.ndarray) -> np.ndarray:
    """The bits of all buckets, in order; each bucket has as many as its stretch is long."""
    if not parts:
        return np.zeros(0, bool)
    return np.concatenate(
        [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(parts, np.diff(cuts).tolist(), strict=True)]
    ).astype(bool)


def _texts(table: pa.Table) -> list[bytes | None]:
    return table["text"].cast(pa.binary()).to_pylist()


ASKED = "bucket int, chunk int, entries binary"
ANCHORED = "chunk int, bucket int, anchors binary"
GROWN = "bucket int, chunk int, anchors binary, hashes binary, checks binary, firsts binary"
EARLIER = "chunk int, bucket int, anchors binary, earlier binary"


def _asker(window: int, block: int, buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        probes = probes_of(read_words(_texts(table)), window, block)
        cuts = _cuts(probes.found, buckets).tolist()
        return pa.table(
            {
                "bucket": pa.array(range(buckets), pa.int32()),
                "chunk": pa.array([table["chunk"][0].as_py()] * buckets, pa.int32()),
                "entries": pa.array([probes.entries[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            }
        )

    return ask


def _meet(table: pa.Table) -> pa.Table:
    """A bucket of the index: an anchor is a hash that some document has as a block and another one anywhere."""
    asked = [np.frombuffer(e, np.uint32) for e in table["entries"].to_pylist()]
    every = np.concatenate(asked)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    begins = _runs(ranked >> np.uint32(2))
    flags = np.zeros(len(every), bool)
    if len(begins):
        kinds, sizes = np.bitwise_or.reduceat(ranked, begins), np.diff(np.append(begins, len(ranked)))
        good = ((kinds & _BLOCK) > 0) & (((kinds & _SEVERAL) > 0) | (sizes > 1))
        flags[order] = np.repeat(good, sizes)
    ends = np.cumsum([len(a) for a in asked])
    return pa.table(
        {
            "chunk": table["chunk"].cast(pa.int32()),
            "bucket": table["bucket"].cast(pa.int32()),
            "anchors": pa.array([_bits(f) for f in np.split(flags, ends[:-1])], pa.binary()),
        }
    )


def _anchored(words: Words, answers: pa.Table, window: int, block: int, buckets: int) -> np.ndarray:
    probes = probes_of(words, window, block)
    flags = _flags(answers["anchors"].to_pylist(), _cuts(probes.found, buckets))
    return probes.starts[flags[probes.which]] if len(flags) else probes.starts


def _in_order(answers: pa.Table) -> pa.Table:
    return answers.take(pc.sort_indices(answers["bucket"]))


def _grower(window: int, block: int, buckets: int):
    def grow(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = _in_order(answers)
        words = read_words(_texts(table))
        hits = extended(words, table["id"].to_numpy(), _anchored(words, answers, window, block, buckets), window, block)
        cuts = _cuts(hits.hashes, buckets).tolist()
        parts = [slice(i, j) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table(
            {
                "bucket": answers["bucket"].cast(pa.int32()),
                "chunk": answers["chunk"].cast(pa.int32()),
                "anchors": answers["anchors"],
                "hashes": pa.array([hits.hashes[p].tobytes() for p in parts], pa.binary()),
                "checks": pa.array([hits.checks[p].tobytes() for p in parts], pa.binary()),
                "firsts": pa.array([hits.first[p].tobytes() for p in parts], pa.binary()),
            }
        )

    return grow


def _compare(table: pa.Table) -> pa.Table:
    """Which windows of each chunk start in a document of a smaller id than any that the chunk has them in."""
    parts = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
    hashes = np.concatenate(parts)
    checks = np.frombuffer(b"".join(table["checks"].to_pylist()), np.uint32)
    firsts = np.frombuffer(b"".join(table["firsts"].to_pylist()), np.int64)
    order = np.lexsort((checks, hashes))
    ranked, check = hashes[order], checks[order]
    earlier = np.zeros(len(hashes), bool)
    if len(hashes):
        begins = np.flatnonzero(np.concatenate(([True], (ranked[1:] != ranked[:-1]) | (check[1:] != check[:-1]))))
        least = np.repeat(np.minimum.reduceat(firsts[order], begins), np.diff(np.append(begins, len(ranked))))
        earlier[order] = least < firsts[order]
    ends = np.cumsum([len(p) for p in parts])
    return pa.table(
        {
            "chunk": table["chunk"].cast(pa.int32()),
            "bucket": table["bucket"].cast(pa.int32()),
            "anchors": table["anchors"],
            "earlier": pa.array([_bits(f) for f in np.split(earlier, ends[:-1])], pa.binary()),
        }
    )


def covered(words: Words, hits: Hits, ids: np.ndarray, earlier: np.ndarray, window: int) -> np.ndarray:
    """For each word, does it lie in a window that starts in a document of a smaller id."""
    repeated = earlier[hits.which] | (hits.first[hits.which] < ids[words.doc[hits.starts]])
    edges = np.zeros(len(words.doc) + 1, np.int64)
    starts = hits.starts[repeated]
    edges[starts] += 1
    np.subtract.at(edges, starts + window, 1)
    return np.cumsum(edges[:-1]) > 0


def _remover(window: int, block: int, buckets: int, id_type: pa.DataType):
    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = _in_order(answers)
        texts, ids = _texts(table), table["id"].to_numpy()
        words = read_words(texts)
        hits = extended(words, ids, _anchored(words, answers, window, block, buckets), window, block)
        earlier = _flags(answers["earlier"].to_pylist(), _cuts(hits.hashes, buckets))
        gone = covered(words, hits, ids, earlier, window)
        ends = np.cumsum(words.sizes)
        removed, spans, kept = [], [], []
        for text, start, stop in zip(texts, (ends - words.sizes).tolist(), ends.tolist(), strict=True):
            mine = gone[start:stop]
            removed.append(int(mine.sum()))
            turns = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist() if removed[-1] else []
            spans.append([{"first": a, "last": b - 1} for a, b in zip(turns[::2], turns[1::2], strict=True)])
            kept.append(b" ".join(compress(words_of(text), (~mine).tolist()) if removed[-1] else words_of(text)))
        return pa.table(
            {
                "id": table["name"].cast(id_type),
                "n_words": pa.array(words.sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    return remove


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """(`id_col`, n_words, n_removed, spans, `text_col`) for each row of `docs`, without passages of earlier documents.

    Words are runs of anything but space and \\t to \\r, unchanged. A word goes if it lies in `window`
    consecutive words of its document whose sequence also starts in a document of a smaller id; this is
    judged on the input, not on what is left. `spans` are the places of the removed words, counted from 0 and
    merged to maximal repeats; `text_col` has the kept words, joined by one space. Windows that repeat within
    one document alone, or among rows of equal ids, stay. Null and empty texts, and those of fewer
    words than `window`, lose nothing; a null text becomes empty. Rows without an id come after
    all others and not before each other. Ids are whole numbers. Other columns are not looked at.

    A repeat of `window` words holds one whole block of each text that is cut into non-overlapping
    blocks of (window + 1) / 2 words. The index takes the blocks of all documents and is probed by every rolling
    window of that size. Hits grow to all windows of full length that hold them, of which the smallest id is found by
    96-bit hashes; those that start in an earlier document are merged.

    Documents are dealt by hash to chunks of about `chunk_chars` characters. A chunk sends each hash once to its bucket
    of the index and gets a bit back, so copies and frequent passages cost an entry a chunk, never
    pairs. Chunks and buckets grow in number with the input, not in size, but for single texts beyond a chunk; a chunk sends
    a row to each bucket, and the index is never larger than one entry a word.
    """
    block = (window + 1) // 2
    keyed = docs.select(F.col(id_col).alias("name"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    # At least as many as there are tasks to share the work.
    chunks = max(shuffle_partitions(docs.sparkSession), -(-chars // chunk_chars))
    buckets = max(shuffle_partitions(docs.sparkSession), chunks // CHUNKS_A_BUCKET)
    dealt = keyed.select(
        "name",
        F.coalesce(F.col("name").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        "text",
        F.pmod(F.xxhash64("name", "text"), F.lit(chunks)).cast("int").alias("chunk"),
    )
    anchors = dealt.groupBy("chunk").applyInArrow(_asker(window, block, buckets), ASKED).groupBy("bucket").applyInArrow(_meet, ANCHORED)
    by_chunk = dealt.groupBy("chunk")
    grown = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(_grower(window, block, buckets), GROWN)
    answers = grown.groupBy("bucket").applyInArrow(_compare, EARLIER)
    id_type = keyed.schema["name"].dataType.simpleString()
    out = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        _remover(window, block, buckets, _arrow_type(id_type)),
        f"id {id_type}, n_words long, n_removed long, spans array<struct<first:long,last:long>>, text string",
    )
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", F.col("text").alias(text_col))


def _arrow_type(name: str) -> pa.DataType:
    return {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32()}.get(name, pa.int64())
