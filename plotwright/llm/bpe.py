"""Byte-level BPE encoding and decoding: merges replayed in rank order over all words of a batch."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import with_fields, without

# Characters whose words are gathered before one replay; bounds a worker's memory.
CHUNK_CHARS = 3_000_000
ROWS_AT_ONCE = 500


class Merges:
    """The ranks of a vocabulary as arrays: which pairs of tokens merge, and into what."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs: list[tuple[int, int]] = []
        # Tokens that can become part of a token of lower rank: after such a merge, the
        # word has to go back to that lower rank before its other merges go on.
        self.reverting: set[int] = set()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(((a << 32) | b, rank))
                    self.reverting.update(x for x in (a, b) if x > rank)
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank at which each pair merges, -1 where it never does."""
        if not len(self.pair_keys):
            return np.full(len(left), -1, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(-1))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def replay(merges: Merges, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all words, one after the other, and where each word's begin (one more at the end).

    An inverted index holds for each rank the places whose pair merges at it. Ranks are taken
    from the lowest; all places of one are merged at once, and only their neighbors get new
    ranks and index entries. Words that are tokens themselves need no merge.
    """
    whole = np.array([merges.ranks.get(w, -1) for w in words], np.int32)
    rest = [w if k < 0 else b"\0" for w, k in zip(words, whole.tolist(), strict=True)]
    lengths = np.fromiter(map(len, rest), np.int64, len(rest))
    tokens = merges.byte_ids[np.frombuffer(b"".join(rest), np.uint8)]
    size = len(tokens)
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    ends = np.cumsum(lengths)
    filled = lengths > 0
    right = np.arange(1, size + 1, dtype=np.int32)
    right[ends[filled] - 1] = -1
    left = np.arange(-1, size - 1, dtype=np.int32)
    left[(ends - lengths)[filled]] = -1
    alive = np.ones(size, bool)

    rank = np.full(size, -1, np.int32)
    inner = np.flatnonzero(right >= 0)
    rank[inner] = merges.rank_of(tokens[inner], tokens[right[inner]])
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray) -> None:
        places = places[rank[places] >= 0]
        if not len(places):
            return
        found = rank[places]
        order = np.argsort(found, kind="stable")
        found, places = found[order], places[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for r, group in zip(found[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts), strict=True):
            if r in index:
                index[r].append(group)
            else:
                index[r] = [group]
                heapq.heappush(queue, r)

    enter(inner)
    while queue:
        r = heapq.heappop(queue)
        groups = index.pop(r)
        places = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
        places = places[rank[places] == r]
        if not len(places):
            continue
        if r in merges.reverting:
            first = np.concatenate(([True], word_of[places[1:]] != word_of[places[:-1]]))
            if not first.all():
                index[r] = [places[~first]]
                heapq.heappush(queue, r)
            places = places[first]
        else:
            chained = right[places[:-1]] == places[1:]
            if chained.any():
                # In a run of overlapping pairs the first, third, ... merge.
                begins = np.concatenate(([True], ~chained))
                numbers = np.arange(len(places))
                places = places[(numbers - np.maximum.accumulate(np.where(begins, numbers, 0))) % 2 == 0]
        gone = right[places]
        after = right[gone]
        tokens[places] = r
        alive[gone] = False
        rank[gone] = -1
        right[places] = after
        left[after[after >= 0]] = places[after >= 0]
        rank[places] = -1
        ahead = places[after >= 0]
        before = left[places]
        before = before[before >= 0]
        rank[ahead] = merges.rank_of(tokens[ahead], tokens[right[ahead]])
        rank[before] = merges.rank_of(tokens[before], tokens[right[before]])
        enter(np.unique(np.concatenate((ahead, before))))
    tokens[(ends - lengths)[whole >= 0]] = whole[whole >= 0]
    starts = np.concatenate(([0], np.cumsum(np.bincount(word_of[alive], minlength=len(words)))))
    return tokens[alive], starts


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _gather(flat: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, int]:
    """The pieces of `flat` numbered `chosen`, one after the other."""
    sizes = starts[chosen + 1] - starts[chosen]
    total = int(sizes.sum())
    shift = np.repeat(starts[chosen] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) if total else np.zeros(0, np.int64)
    return flat[np.arange(total) + shift], total


def _encode_chunk(merges: Merges, pattern: regex.Pattern, texts: list[str | None]) -> pa.ListArray:
    numbers: dict[str, int] = {}
    docs = []
    for text in texts:
        found = pattern.findall(text or "")
        docs.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int32, len(found)))
    flat, starts = replay(merges, [w.encode("utf-8") for w in numbers])
    pieces = [_gather(flat, starts, doc) for doc in docs]
    ids = np.concatenate([p for p, _ in pieces]) if pieces else np.zeros(0, np.int32)
    return _lists(ids, np.array([n for _, n in pieces], np.int64))


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file `path` (known to the driver) for all executors; a vocabulary is a few MB at most."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


@lru_cache(maxsize=2)
def _merges(ranks: bytes) -> Merges:
    """Built once in a worker, for the vocabularies used last."""
    return Merges(read_ranks(ranks))


def encode(
    docs: DataFrame, ranks: Broadcast, pattern: str, text_col: str = "text", ids_col: str = "ids", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """`docs` with the token ids of each text in `ids_col` (array of int, replaces a column of that name).

    Each match of `pattern` is encoded by itself. Null and empty texts have no ids. The merges
    are replayed over the distinct words of a batch of rows, cut where it passes `chunk_chars`
    characters; a single text beyond that is a batch of its own. Nothing is shuffled.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, compiled = _merges(ranks.value), regex.compile(pattern)
        for chunk in _chunks(batches, chunk_chars):
            yield _encode_chunk(merges, compiled, chunk)

    return with_fields(docs, F.struct(ids(F.col(text_col)).alias(ids_col)), [ids_col])


def _chunks(batches: Iterator[pa.Array], chunk_chars: int) -> Iterator[list[str | None]]:
    """Texts of a batch, about `chunk_chars` characters at a time. Their answers leave at once; they need not come in
    the batches of the texts."""
    for texts in batches:
        chunk, chars = [], 0
        for at in range(0, len(texts), ROWS_AT_ONCE):
            for text in texts[at : at + ROWS_AT_ONCE].to_pylist():
                if chunk and chars + len(text or "") > chunk_chars:
                    yield chunk
                    chunk, chars = [], 0
                chunk.append(text)
                chars += len(text or "")
        if chunk:
            yield chunk


def transcode(
    docs: DataFrame,
    ranks: Broadcast,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
    bytes_col: str = "decoded",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """`docs` with the ids of `encode` and the bytes that `decode` makes of them, in one pass through one worker a task."""

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, compiled = _merges(ranks.value), regex.compile(pattern)
        for chunk in _chunks(batches, chunk_chars):
            ids = _encode_chunk(merges, compiled, chunk)
            yield pa.StructArray.from_arrays([ids, pa.array(_decoded(merges, ids), pa.binary())], ["ids", "decoded"])

    answer = F.col("__both")
    kept = without(docs, [ids_col, bytes_col])
    named = [F.col(f"`{c}`") for c in kept.columns]
    out = docs.withColumn("__both", both(F.col(text_col)))
    return out.select(*named, answer["ids"].alias(ids_col), answer["decoded"].alias(bytes_col))


def _decoded(merges: Merges, lists: pa.ListArray) -> Iterator[bytes]:
    token = merges.token
    for at in range(0, len(lists), ROWS_AT_ONCE):
        part = lists[at : at + ROWS_AT_ONCE]
        flat = part.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
        if len(flat) and flat.min() < 0:
            raise ValueError("a negative token id")
        for a, b in pairwise(np.concatenate(([0], np.cumsum(sizes))).tolist()):
            yield b"".join([token[i] for i in flat[a:b].tolist()])


def decode(df: DataFrame, ranks: Broadcast, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """`df` with the bytes that the token ids stand for in `bytes_col` (binary, replaces a column of that name).

    A null list gives no bytes. Ids without a token fail the job, as they cannot come from this vocabulary.
    """

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = _merges(ranks.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                yield pa.array(_decoded(merges, batch[at : at + ROWS_AT_ONCE]), pa.binary())

    return with_fields(df, F.struct(decoded(F.col(ids_col)).alias(bytes_col)), [bytes_col])

