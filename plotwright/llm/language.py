"""Language of texts, word by word: a linear-chain conditional random field over affixes, n-grams and a lexicon."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import with_fields

UNKNOWN = "und"
# Bounds of the sample a model is fitted on: documents of all languages, their characters, and consecutive words of each.
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 20_000_000
SAMPLE_WORDS = 60
# Parts of a language whose first documents are taken on their own before they are taken together.
SALTS = 64
# Runs of different documents in one training sequence, so that transitions see switches.
RUNS = 3
BUCKETS = 1 << 18
# N-grams and affixes are byte n-grams of `<word>`; words this frequent in the sample are the lexicon.
GRAMS = (2, 3, 4)
LEXICON_COUNT = 5
STEPS = 40
RATE = 0.3
DECAY = 1e-4
# Characters of texts that are labelled at once; bounds a worker's memory.
CHUNK_CHARS = 4_000_000

FIELDS = ["lang_pred", "score", "spans"]
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…—–¿¡0123456789"


def _has_letter(word: str) -> bool:
    return any(c.isalpha() for c in word)


def numbered_words(texts: list[str | None]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of the texts and each text's words by number: runs without white space that
    hold a letter, lower-cased, less punctuation and digits at their ends."""
    raw: dict[str, int] = {}
    docs = []
    for text in texts:
        found = (text or "").lower().split()
        docs.append(np.fromiter((raw.setdefault(w, len(raw)) for w in found), np.int32, len(found)))
    words: dict[str, int] = {}
    number = np.empty(len(raw), np.int32)
    for token, i in raw.items():
        word = token.strip(_EDGES)
        number[i] = words.setdefault(word, len(words)) if _has_letter(word) else -1
    docs = [number[d] for d in docs]
    return list(words), [d[d >= 0] for d in docs]


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each word and the word they belong to, sorted by word."""
    data = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    word_of = np.repeat(np.arange(len(data)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    known = [(BUCKETS + lexicon[w], i) for i, w in enumerate(words) if w in lexicon]
    found = [np.array([k for k, _ in known], np.int64)]
    owners = [np.array([i for _, i in known], np.int64)]
    rolled = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            break
        rolled = rolled[: len(raw) - n + 1] * np.uint64(0x100000001B3) + raw[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            whole = left[: len(rolled)] >= n
            mixed = (rolled[whole] ^ (rolled[whole] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(32)).astype(np.int64) % BUCKETS)
            owners.append(word_of[: len(rolled)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], owner[order]


@dataclass
class Model:
    """Weights of features by label, and of label following label."""

    labels: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    follow: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Each word's score for each label, as the mean over its features; every word has some."""
        if not words:
            return np.zeros((0, len(self.labels)))
        found, owner = features(words, self.lexicon)
        begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sums = np.add.reduceat(self.weights[found], begins, axis=0)
        return sums / np.diff(np.append(begins, len(owner)))[:, None]


def marginals(
    emissions: np.ndarray, follow: np.ndarray, docs: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By forward-backward: label probabilities of every word (texts one after the other), expected
    numbers of label pairs, and the log of each text's normaliser less its words' largest emissions.

    All texts move on together, the longest first, so that those still running head the arrays.
    """
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.concatenate(docs) if len(docs) else np.zeros(0, np.int32)
    order = np.argsort(-sizes, kind="stable")
    begins, lengths = (np.cumsum(sizes) - sizes)[order], sizes[order]
    weight = np.exp(emissions - emissions.max(axis=1, keepdims=True)) if len(emissions) else emissions
    step = np.exp(follow - follow.max())
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest + 1), side="left")
    forward = np.zeros((len(flat), follow.shape[0]))
    norm = np.zeros(len(docs))
    state = np.full((len(docs), follow.shape[0]), 1.0)
    for t in range(longest):
        k = running[t]
        at = begins[:k] + t
        state = (state[:k] @ step if t else state[:k]) * weight[flat[at]]
        total = state.sum(axis=1, keepdims=True)
        state /= total
        norm[:k] += np.log(total[:, 0])
        forward[at] = state
    pairs = np.zeros_like(follow)
    back = np.ones((len(docs), follow.shape[0]))
    for t in range(longest - 2, -1, -1):
        k = running[t + 1]
        at = begins[:k] + t
        ahead = weight[flat[at + 1]] * back[:k]
        joint = forward[at].T @ (ahead / ((forward[at] @ step) * ahead).sum(axis=1, keepdims=True)) * step
        pairs += joint
        new = ahead @ step.T
        back[:k] = new / new.sum(axis=1, keepdims=True)
        forward[at] *= back[:k]
    forward /= np.maximum(forward.sum(axis=1, keepdims=True), 1e-300)
    logs = np.empty(len(docs))
    logs[order] = norm
    return forward, pairs, logs


def train(texts: list[str], langs: list[str], steps: int = STEPS, seed: int = 5, run_words: int = SAMPLE_WORDS) -> Model:
    """A model by Adam on the log-likelihood of sequences that switch between runs of several texts.

    A run is up to `run_words` consecutive words from any place of a text, all of the text's language. The same texts in the
    same order give the same model.
    """
    labels = sorted(set(langs))
    if not labels:
        return Model([], {}, np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    rng = np.random.default_rng(seed)
    words, docs = numbered_words(texts)
    runs = []
    for doc, lang in zip(docs, langs, strict=True):
        if len(doc):
            at = int(rng.integers(0, max(1, len(doc) - run_words + 1)))
            runs.append((doc[at : at + run_words], labels.index(lang)))
    rng.shuffle(runs)
    sequences, targets = [], []
    for at in range(0, len(runs), RUNS):
        group = runs[at : at + RUNS]
        sequences.append(np.concatenate([d for d, _ in group]))
        targets.append(np.concatenate([np.full(len(d), k) for d, k in group]))
    if not sequences:
        return Model(labels, {}, np.zeros((BUCKETS, len(labels))), np.zeros((len(labels), len(labels))))
    flat, gold = np.concatenate(sequences), np.concatenate(targets)
    used, flat = np.unique(flat, return_inverse=True)
    counts = np.bincount(flat)
    chosen = [words[i] for i in used]
    lexicon = {w: n for n, w in enumerate(w for w, c in zip(chosen, counts.tolist(), strict=True) if c >= LEXICON_COUNT)}
    found, owner = features(chosen, lexicon)
    seen, found = np.unique(found, return_inverse=True)
    word_begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    share = 1 / np.diff(np.append(word_begins, len(owner)))[:, None]
    by_feature = np.argsort(found, kind="stable")
    feature_begins = np.flatnonzero(np.concatenate(([True], np.diff(found[by_feature]) > 0)))
    by_word = np.argsort(flat, kind="stable")
    token_begins = np.flatnonzero(np.concatenate(([True], np.diff(flat[by_word]) > 0)))
    cuts = np.cumsum([len(s) for s in sequences])[:-1]
    parts = np.split(flat, cuts)
    inner = np.ones(len(flat), bool)
    inner[np.concatenate(([0], cuts))] = False
    at = np.flatnonzero(inner)
    gold_pairs = np.zeros((len(labels), len(labels)))
    np.add.at(gold_pairs, (gold[at - 1], gold[at]), 1)
    target = np.eye(len(labels))[gold]

    weights, follow = np.zeros((len(seen), len(labels))), np.zeros((len(labels), len(labels)))
    params, first, second = [weights, follow], [0, 0], [0, 0]
    for step in range(1, steps + 1):
        emissions = np.add.reduceat(weights[found], word_begins, axis=0) * share
        likely, pairs, _ = marginals(emissions, follow, parts)
        by = np.add.reduceat((likely - target)[by_word], token_begins, axis=0) * share
        slope = np.add.reduceat(by[owner][by_feature], feature_begins, axis=0) / len(flat) + DECAY * weights / len(flat)
        for i, g in enumerate((slope, (pairs - gold_pairs) / len(flat))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-9)
    every = np.zeros((BUCKETS + len(lexicon), len(labels)))
    every[seen] = weights
    return Model(labels, lexicon, every, follow)


def fit(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    run_words: int = SAMPLE_WORDS,
) -> Model:
    """A model from a bounded sample of the documents for which `usable` holds.

    Each of the n languages gives its first sample_rows / n documents (one at least) in the order of a hash of the id, then by id
    and text; in that order texts that would bring more than `sample_chars` characters together are passed over, whatever
    their place in the table. Of each text `run_words` consecutive words teach. The model depends on the rows alone, not on
    how they are partitioned. This is settled on ids, languages and lengths; only chosen texts are fetched.

    Rows without an id, text or language teach nothing; a row that repeats teaches once; an id may stand for several texts or
    languages. Every language with a document that fits the bounds can be predicted, no other. Where two languages have
    equal sums, the one first in order is predicted.
    """
    known = docs.where(usable & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    narrow = rows.select("id", "digest", "lang", F.length("text").alias("chars")).dropDuplicates(["id", "digest", "lang"])
    languages = rows.select("lang").distinct().count()
    share = max(1, sample_rows // max(1, languages))
    order = [F.xxhash64("id"), "id", "digest"]
    salted = narrow.withColumn("salt", F.pmod(F.xxhash64("id", "digest"), F.lit(SALTS)))
    first = salted.withColumn("n", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("n") <= share)
    first = first.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("n") <= share)
    wanted, chars = [], 0
    # At most `sample_rows` rows, or one a language. Languages take turns, so the bound of characters meets all alike.
    for row in first.orderBy("n", "lang").collect():
        if chars + row["chars"] <= sample_chars:
            chars += row["chars"]
            wanted.append((row["id"], row["digest"], row["lang"]))
    if not wanted:
        return train([], [])
    keys = docs.sparkSession.createDataFrame(wanted, rows.select("id", "digest", "lang").schema)
    sample = rows.join(F.broadcast(keys), ["id", "digest", "lang"]).dropDuplicates(["id", "digest", "lang"])
    found = {(r["id"], r["digest"], r["lang"]): r["text"] for r in sample.toLocalIterator()}
    return train([found[k] for k in wanted], [lang for _, _, lang in wanted], run_words=run_words)


def _answer(model: Model, texts: list[str | None]) -> pa.StructArray:
    words, docs = numbered_words(texts)
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    names = np.array([*model.labels, UNKNOWN], dtype=object)
    if model.labels:
        likely, _, _ = marginals(model.emissions(words), model.follow, docs)
        sums = np.zeros((len(docs), len(model.labels)))
        doc = np.repeat(np.arange(len(docs)), sizes)
        for k in range(len(model.labels)):
            sums[:, k] = np.bincount(doc, weights=likely[:, k], minlength=len(docs))
        best, word_label = sums.argmax(axis=1), likely.argmax(axis=1)
        score = sums.max(axis=1) / np.maximum(sizes, 1)
    else:
        doc, best, score = np.zeros(0, np.int64), np.zeros(len(docs), np.int64), np.zeros(len(docs))
        sizes, word_label = np.zeros(len(docs), np.int64), np.zeros(0, np.int64)
    lang = names[np.where(sizes > 0, best, len(model.labels))]
    begins = np.concatenate(([True], (doc[1:] != doc[:-1]) | (word_label[1:] != word_label[:-1]))) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    offset = (np.cumsum(sizes) - sizes)[doc[first]] if len(first) else first
    per_doc = np.bincount(doc[first], minlength=len(docs)) if len(first) else np.zeros(len(docs), np.int64)
    runs = pa.StructArray.from_arrays(
        [pa.array(first - offset, pa.int64()), pa.array(last - offset, pa.int64()), pa.array(names[word_label[first]].tolist(), pa.string())],
        ["first", "last", "lang"],
    )
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_doc))), pa.int32()), runs)
    return pa.StructArray.from_arrays(
        [pa.array(lang.tolist(), pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), spans], FIELDS
    )


def label_languages(docs: DataFrame, model: Model, text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """`docs` with `lang_pred`, `score` and `spans`; input columns of these names are replaced.

    Every word of the whole text gets label probabilities by forward-backward. `lang_pred` is the label with
    the largest sum of them, `score` its mean probability, and `spans` the runs (first and last word, counted
    from 0, and label) of words of one most likely label. Null texts and those without a letter are
    `und` with score 0 and no spans, as is every text if nothing was learned. Nothing is shuffled; the
    model has a size bounded by its sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, spans array<struct<first:bigint,last:bigint,lang:string>>")
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            chunk, chars = [], 0
            for at in range(0, len(texts), 500):
                for text in texts[at : at + 500].to_pylist():
                    if chunk and chars + len(text or "") > chunk_chars:
                        yield _answer(shared.value, chunk)
                        chunk, chars = [], 0
                    chunk.append(text)
                    chars += len(text or "")
            if chunk:
                yield _answer(shared.value, chunk)

    return with_fields(docs, answer(F.col(text_col)), FIELDS)
