"""Toxicity scores: averaged subword-bag embeddings under a linear softmax, trained together."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_fields

# Bounds of the labelled sample a model is fitted on.
SAMPLE_ROWS = 6000
SAMPLE_CHARS = 40_000_000
# Texts whose subwords are held at once while fitting.
CHUNK_TEXTS = 400
BUCKETS = 1 << 20
DIM = 8
GRAMS = (3, 4, 5, 6)
LEAST_Z = 4.0
LEAST_TEXTS = 5
STEPS = 150
RATE = 1.0
# Characters whose words are looked up at once; bounds a worker's memory.
CHUNK_CHARS = 2_000_000

FIELDS = ["score", "predicted"]
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…—–¿¡"


def _subwords(tokens: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte n-grams of `<token>`, and the number of the token each belongs to."""
    data = [b"<" + t.encode("utf-8", "surrogatepass") + b">" if t else b"" for t in tokens]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    word_of = np.repeat(np.arange(len(data)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    grams, owners = [], []
    rolled = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            break
        rolled = rolled[: len(raw) - n + 1] * np.uint64(0x100000001B3) + raw[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            whole = left[: len(rolled)] >= n
            mixed = (rolled[whole] ^ (rolled[whole] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            grams.append((mixed >> np.uint64(32)).astype(np.int64) % buckets)
            owners.append(word_of[: len(rolled)][whole])
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(grams)[order], owner[order]


def _tokens(texts: list[str | None]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of the texts, and each text's words by number. Words are split at white
    space, lower-cased, and lose punctuation at their ends; what has nothing else is no word."""
    raw: dict[str, int] = {}
    docs = []
    for text in texts:
        found = (text or "").lower().split()
        docs.append(np.fromiter((raw.setdefault(w, len(raw)) for w in found), np.int64, len(found)))
    words: dict[str, int] = {"": 0}
    number = np.fromiter((words.setdefault(w.strip(_EDGES), len(words)) for w in raw), np.int64, len(raw))
    docs = [number[d] for d in docs]
    return list(words), [d[d > 0] for d in docs]


def _sums(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Row sums of `values` by sorted `owner`."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(owner):
        begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        out[owner[begins]] = np.add.reduceat(values, begins, axis=0)
    return out


def _bags(words: list[str], docs: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subword bags of texts as (text, bucket, share), sorted: a text is the mean of its words, a word of its subwords.

    A word that a text repeats counts by the root of its number, so that a repeated line does not fill the mean.
    """
    grams, owner = _subwords(words, buckets)
    begins = np.searchsorted(owner, np.arange(len(words) + 1))
    sizes = np.diff(begins)
    rows, chosen, shares = [], [], []
    for i, doc in enumerate(docs):
        word, count = np.unique(doc, return_counts=True)
        if not len(word):
            continue
        weight = np.sqrt(count)
        size = sizes[word]
        at = np.arange(size.sum()) + np.repeat(begins[word] - (np.cumsum(size) - size), size)
        bucket, place = np.unique(grams[at], return_inverse=True)
        share = np.bincount(place, weights=np.repeat(weight / weight.sum() / np.maximum(size, 1), size), minlength=len(bucket))
        rows.append(np.full(len(bucket), i))
        chosen.append(bucket)
        shares.append(share)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(chosen), np.concatenate(shares)


@dataclass
class Model:
    """What scoring needs: each subword bucket's share in the log-odds, and their offset."""

    weights: np.ndarray
    offset: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        words, docs = _tokens(texts)
        grams, owner = _subwords(words, len(self.weights))
        counts = np.bincount(owner, minlength=len(words))
        per_word = np.bincount(owner, weights=self.weights[grams], minlength=len(words)) / np.maximum(counts, 1)
        odds = np.full(len(docs), self.offset)
        for i, doc in enumerate(docs):
            if len(doc):
                word, count = np.unique(doc, return_counts=True)
                weight = np.sqrt(count)
                odds[i] += per_word[word] @ weight / weight.sum()
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = 7) -> Model:
    """Embeddings of subword buckets and the softmax over two classes, by Adam on the mean log loss.

    Buckets that occur in at least LEAST_TEXTS texts and in a share of the labelled ones that
    differs from the others' by LEAST_Z standard errors have embeddings, all others stay zero:
    most subwords are far too rare to be told from chance.
    """
    y = np.array(labels, np.int64)
    toxic, clean = int(y.sum()), int(len(y) - y.sum())
    offset = float(np.log((toxic + 0.5) / (clean + 1.5)))
    weights = np.zeros(BUCKETS)
    if not toxic or not clean:
        return Model(weights, offset)
    chunks = range(0, len(texts), CHUNK_TEXTS)
    with_it, in_toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in chunks:
        rows, buckets, _ = _bags(*_tokens(texts[at : at + CHUNK_TEXTS]), BUCKETS)
        with_it += np.bincount(buckets, minlength=BUCKETS)
        in_toxic += np.bincount(buckets, weights=y[at + rows], minlength=BUCKETS)
    rate = with_it / len(y)
    error = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / toxic + 1 / clean))
    apart = np.abs(in_toxic / toxic - (with_it - in_toxic) / clean) / error
    chosen = np.flatnonzero((apart >= LEAST_Z) & (with_it >= LEAST_TEXTS))
    if not len(chosen):
        return Model(weights, offset)
    number = np.full(BUCKETS, -1)
    number[chosen] = np.arange(len(chosen))
    parts = []
    for at in chunks:
        rows, buckets, shares = _bags(*_tokens(texts[at : at + CHUNK_TEXTS]), BUCKETS)
        used = number[buckets] >= 0
        parts.append((at + rows[used], number[buckets[used]], shares[used]))
    rows, grams, shares = (np.concatenate(p) for p in zip(*parts, strict=True))
    shares = shares[:, None]
    by_gram = np.argsort(grams, kind="stable")

    rng = np.random.default_rng(seed)
    embed = rng.standard_normal((len(chosen), DIM)) * 0.1
    head = rng.standard_normal((DIM, 2)) * 0.5
    bias = np.array([0.0, offset])
    params, rates = [embed, head, bias], [RATE, RATE / 20, RATE / 20]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.eye(2)[y]
    for step in range(1, steps + 1):
        text = _sums(embed[grams] * shares, rows, len(y))
        logits = text @ head + bias
        soft = np.exp(logits - logits.max(1, keepdims=True))
        wrong = (soft / soft.sum(1, keepdims=True) - target) / len(y)
        to_gram = _sums(((wrong @ head.T)[rows] * shares)[by_gram], grams[by_gram], len(chosen))
        for p, g, m, v, r in zip(params, [to_gram, text.T @ wrong, wrong.sum(0)], first, second, rates, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= r * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-12)
    weights[chosen] = embed @ (head[:, 1] - head[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """A model from a bounded sample of the labelled documents for which `usable` (on `labels`) holds.

    The sample is taken from the texts of the first `sample_rows` labelled ids in hash order, in that
    order: a text that would bring more than `sample_chars` characters together is passed over, whatever
    the order of the table. This is settled on ids, labels and lengths; only chosen texts are fetched.
    An id labelled more than once takes its highest label; a row repeated with its text teaches once;
    rows without an id, label or text teach nothing. Without rows of both classes the model
    gives every text the (smoothed) share of toxic rows.
    """
    known = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    texts = texts.withColumn("__text", F.xxhash64("text"))
    # At most `sample_rows` ids and labels.
    sizes = texts.join(F.broadcast(chosen), "__id").select(
        "__id", "__text", F.col("label").cast("int").alias("label"), F.length("text").alias("chars")
    )
    sizes = sizes.dropDuplicates(["__id", "__text"]).orderBy(F.xxhash64("__id"), "__id", "__text").limit(sample_rows)
    wanted, chars = {}, 0
    for row in sizes.collect():
        if chars + row["chars"] <= sample_chars:
            chars += row["chars"]
            wanted[row["__id"], row["__text"]] = int(row["label"] > 0)
    if not wanted:
        return train([], [])
    kind = texts.select("__id", "__text").schema
    keys = docs.sparkSession.createDataFrame(list(wanted), kind)
    sample = texts.join(F.broadcast(keys), ["__id", "__text"]).groupBy("__id", "__text").agg(F.any_value("text").alias("text"))
    found = {(r["__id"], r["__text"]): r["text"] for r in sample.toLocalIterator()}
    return train([found[k] for k in wanted], list(wanted.values()))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: toxic likelier) and `predicted` (1 if score >= 0.5).

    Whole texts are scored; null and empty texts, and those without a word, get the score of the
    model's offset. Input columns of these names are replaced. Nothing is shuffled; the model
    has a fixed size.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def scored(known: Model, chunk: list[str | None]) -> pa.StructArray:
        score = known.score(chunk)
        return pa.StructArray.from_arrays([pa.array(score), pa.array((score >= 0.5).astype(np.int32))], FIELDS)

    @F.arrow_udf("score double, predicted int")
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            chunk, chars = [], 0
            for at in range(0, len(texts), 500):
                for text in texts[at : at + 500].to_pylist():
                    if chunk and chars + len(text or "") > chunk_chars:
                        yield scored(shared.value, chunk)
                        chunk, chars = [], 0
                    chunk.append(text)
                    chars += len(text or "")
            if chunk:
                yield scored(shared.value, chunk)

    return with_fields(docs, answer(F.col(text_col)), FIELDS)
