"""Language-model scores: stupid backoff over n-gram counts of all other documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, words_of

ORDER = 3
BACKOFF = 0.4
# Characters of the documents that are counted and scored together; bounds a worker's memory.
BLOCK_CHARS = 12_000_000
# Bits of an n-gram's hash. A gram is counted with another by a chance of (distinct grams) / 2^60: 1 in 10^9 for
# a billion of them. Sorted and as differences, four bits less make a sixth of the bytes sent.
HASH_BITS = 60

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


@dataclass
class Grams:
    """The n-grams of a block of documents.

    `found` are the distinct hashes of all orders, sorted, and `counts` how often the block
    has each. `number[k]` says for each word which of them ends there with k words (`number[0]` is
    the empty gram, whose count is that of the words), `place` counts words within their document.
    """

    found: np.ndarray
    counts: np.ndarray
    number: list[np.ndarray]
    doc: np.ndarray
    place: np.ndarray
    sizes: np.ndarray


def grams_of(texts: list[str | None], order: int) -> Grams:
    numbers: dict[bytes, int] = {}
    parts = []
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    total = int(sizes.sum())
    word = hashes[np.concatenate(parts)] if total else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = (np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    # The empty gram has hash 0; it is asked for by every block, also by one without words.
    found, counts, number = [np.zeros(1, np.uint64)], [np.array([total], np.int64)], [np.zeros(total, np.int32)]
    rolled = np.zeros(total, np.uint64)
    for k in range(1, order + 1):
        # What ended one word before with k - 1 words, and this word.
        before = np.concatenate((np.zeros(1, np.uint64), rolled[:-1])) if total else rolled
        rolled = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k))
        whole = np.flatnonzero(place >= k - 1).astype(np.int32)
        short = rolled[whole] >> np.uint64(64 - HASH_BITS)
        order_of = np.argsort(short).astype(np.int32)
        ranked = short[order_of]
        begins = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
        at = np.full(total, -1, np.int32)
        at[whole[order_of]] = np.cumsum(begins, dtype=np.int32) - 1
        found.append(ranked[begins])
        counts.append(np.diff(np.append(np.flatnonzero(begins), len(ranked))))
        number.append(at)
        del whole, short, order_of, ranked, begins
    # One sorted list for all orders; hashes of different orders are as distinct as any two.
    offsets = np.cumsum([0] + [len(f) for f in found])
    every = np.concatenate(found)
    ranking = np.argsort(every, kind="stable")
    where = np.empty(len(every), np.int32)
    where[ranking] = np.arange(len(every), dtype=np.int32)
    last = len(every) - 1
    number = [np.where(n >= 0, where[np.minimum(np.maximum(n, 0) + o, last)], -1) for n, o in zip(number, offsets, strict=False)]
    return Grams(every[ranking], np.concatenate(counts)[ranking], number, doc, place, sizes)


def _packed(sorted_values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte: the upper bytes are alike and compress."""
    steps = np.diff(sorted_values, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _narrow(counts: np.ndarray) -> tuple[bytes, int]:
    """Counts in as few bytes as the largest needs, byte by byte."""
    top = int(counts.max()) if len(counts) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), width


def _wide(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


ASKED = "bucket int, block int, hashes binary, counts binary, width int"
ANSWERED = "block int, bucket int, totals binary, width int"


def _asker(order: int, buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        grams = grams_of(table["text"].to_pylist(), order)
        block = table["block"][0].as_py()
        # Hashes are dealt by their upper half, so a bucket is a stretch of the sorted list.
        bucket = ((grams.found >> np.uint64(HASH_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if j > i:
                data, width = _narrow(grams.counts[i:j])
                rows.append((b, block, _packed(grams.found[i:j]), data, width))
        columns = list(zip(*rows, strict=True))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32())
        names = ("bucket", "block", "hashes", "counts", "width")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    return ask


def _add_up(table: pa.Table) -> pa.Table:
    """The count table of one bucket, joined to what each block asked for."""
    asked = [_unpacked(h) for h in table["hashes"].to_pylist()]
    counts = [_wide(c, w) for c, w in zip(table["counts"].to_pylist(), table["width"].to_pylist(), strict=True)]
    every = np.concatenate(asked)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    begins = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    which = np.empty(len(every), np.int64)
    which[order] = np.cumsum(begins) - 1
    totals = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(begins))[which]
    answers, at = [], 0
    for hashes in asked:
        answers.append(_narrow(totals[at : at + len(hashes)]))
        at += len(hashes)
    return pa.table(
        {
            "block": table["block"].cast(pa.int32()),
            "bucket": table["bucket"].cast(pa.int32()),
            "totals": pa.array([d for d, _ in answers], pa.binary()),
            "width": pa.array([w for _, w in answers], pa.int32()),
        }
    )


def _own(grams: Grams, k: int) -> np.ndarray:
    """For each word, how often its own document has the k-gram that ends there."""
    at = grams.number[k]
    if k == 0:
        return grams.sizes[grams.doc].astype(np.int32)
    # Words without such a gram have -1, which must not meet the last gram of the document before.
    key = grams.doc.astype(np.int64) * (len(grams.found) + 1) + at + 1
    order = np.argsort(key).astype(np.int32)
    ranked = key[order]
    begins = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    counts = np.diff(np.append(np.flatnonzero(begins), len(key))).astype(np.int32)
    out = np.empty(len(key), np.int32)
    out[order] = np.repeat(counts, counts)
    return out


def word_scores(grams: Grams, totals: np.ndarray, order: int, backoff: float) -> np.ndarray:
    """The log of each word's stupid-backoff score by the counts of all other documents.

    The longest n-gram that others have counts relative to its context; each word by which
    it is shorter than it could be costs a factor `backoff`. A word that no other document has
    is scored `backoff` times a count of one.
    """

    def others(k: int) -> np.ndarray:
        return np.where(grams.number[k] >= 0, totals[np.maximum(grams.number[k], 0)] - _own(grams, k), 0)

    all_words, now = np.maximum(others(0), 1), others(1)
    score = np.log(np.where(now > 0, now, backoff) / all_words)
    del all_words
    for k in range(2, order + 1):
        whole = grams.place >= k - 1
        context = np.concatenate((np.zeros(1, np.int64), now[:-1])) if len(now) else now
        now = others(k)
        seen = whole & (now > 0)
        score[whole & ~seen] += np.log(backoff)
        score[seen] = np.log(now[seen] / context[seen])
    return score


def _scorer(order: int, backoff: float):
    def score(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = grams_of(docs["text"].to_pylist(), order)
        ids = docs["id"]
        del docs
        answers = answers.take(pc.sort_indices(answers["bucket"]))
        parts = [_wide(t, w) for t, w in zip(answers["totals"].to_pylist(), answers["width"].to_pylist(), strict=True)]
        words = word_scores(grams, np.concatenate(parts), order, backoff)
        sums = np.bincount(grams.doc, weights=words, minlength=len(grams.sizes))
        return pa.table(
            {"id": ids, "n_words": pa.array(grams.sizes, pa.int64()), "log_score": pa.array(sums, pa.float64())}
        )

    return score


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    backoff: float = BACKOFF,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(`id_col`, n_words, log_score, mean_score) for each row of `docs`.

    `log_score` is the sum over a document's words of the natural logarithm of their stupid-backoff
    score, by the counts of all n-grams up to `order` words in all other rows; `mean_score` is its
    mean over the words. Words are digits, a-z and characters beyond ASCII, A-Z in lower case; n-grams do not
    cross documents. Null and empty texts have 0 words, a sum of 0 and a null mean. Copies and repeated rows are
    documents like any other, so each raises the score of the rest. Ids may be null or repeat.

    Documents are dealt by hash to blocks of `block_chars` characters at most or so. A block sends each n-gram
    once, with its count, to the count table of its hash bucket, and gets back the total; a frequent
    word or passage is thus one entry a block. Blocks and buckets both grow in number with the input,
    not in size, but for single texts beyond a block.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    # At least as many as there are tasks to share the work.
    blocks = max(shuffle_partitions(docs.sparkSession), -(-chars // block_chars))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    dealt = keyed.withColumn("block", block)
    asked = dealt.groupBy("block").applyInArrow(_asker(order, blocks), ASKED)
    answered = asked.groupBy("bucket").applyInArrow(_add_up, ANSWERED)
    id_type = keyed.schema["id"].dataType.simpleString()
    scored = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        _scorer(order, backoff), f"id {id_type}, n_words long, log_score double"
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select(F.col("id").alias(id_col), "n_words", "log_score", mean.alias("mean_score"))
