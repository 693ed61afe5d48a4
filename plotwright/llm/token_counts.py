"""Token counts behind a cache: texts are looked up by digest, only distinct misses are encoded."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..operators.lookup import ASKED, lookup_join
from .common import without

LIMIT = 512
# Characters that go to the tokenizer at once; bounds a worker's memory.
CHUNK_CHARS = 2_000_000
# Counts of pieces that a worker remembers.
KNOWN_PIECES = 400_000
# Fixed value: how byte-level tokenizers split a text.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = "version binary, digest binary, n_tokens long"


def digest_of(text: Column) -> Column:
    """What a text is cached by. A null counts as empty; nothing else may be normalised, as this tokenizer
    keeps every byte and a count would change."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cached counts; none where nothing has been written yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], CACHE)


def _splits_alike(definition: dict) -> bool:
    """Whether the tokenizer splits a text by BYTE_LEVEL before it looks at any piece, and does nothing else before."""
    split = definition.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return bool(plain) and not definition.get("normalizer") and definition["model"].get("type") == "BPE"


class Counter:
    """Counts tokens by the library; pieces that texts share are encoded once.

    Pieces of a byte-level tokenizer are encoded independently, so its count of a text is the sum of
    those of the pieces. Texts with a special string, and other tokenizers, go through the library whole.
    """

    def __init__(self, definition: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(definition)
        self.split = regex.compile(BYTE_LEVEL) if _splits_alike(parsed) else None
        self.special = [t["content"] for t in parsed.get("added_tokens", [])]
        self.known: dict[str, int] = {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        whole = [i for i, t in enumerate(texts) if self.split is None or any(s in t for s in self.special)]
        out = dict(zip(whole, self._encoded([texts[i] for i in whole]), strict=True))
        pieces = {i: self.split.findall(t) for i, t in enumerate(texts) if i not in out}
        fresh = list({p for found in pieces.values() for p in found}.difference(self.known))
        if len(self.known) + len(fresh) > KNOWN_PIECES:
            fresh = list({p for found in pieces.values() for p in found})
            self.known = {}
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            self.known.update(zip(part, self._encoded(part), strict=True))
        count = self.known.__getitem__
        out |= {i: sum(map(count, found)) for i, found in pieces.items()}
        return [out[i] for i in range(len(texts))]


def _counter(definition: str, chunk_chars: int):
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(definition)
        for texts in batches:
            chunk: list[str] = []
            chars = 0
            for at in range(0, len(texts), 500):
                for text in texts[at : at + 500].to_pylist():
                    if chunk and chars + len(text) > chunk_chars:
                        yield pa.array(counter.counts(chunk), pa.int64())
                        chunk, chars = [], 0
                    chunk.append(text)
                    chars += len(text)
            if chunk:
                yield pa.array(counter.counts(chunk), pa.int64())

    return count


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    text_col: str = "text",
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """`docs`, without its text, with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (n_tokens > `limit`).

    Counts are those of the tokenizer file without begin, end or padding; special strings inside
    texts are read as the library does by default. Null and empty texts have 0 bytes and tokens.
    Input columns named as the results are replaced, repeated rows stay repeated.

    The table at `cache_path` holds counts by the digest of the tokenizer file and of the text.
    Distinct digests that it lacks are encoded, each once, and appended before the counts are
    read back; a run that fails in between appends nothing, one that repeats it finds what the
    first had appended. Copies fold before the shuffle, so the text goes through one shuffle
    and a copied text makes no hot key; the counts return through `lookup_join`.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    version = F.lit(hashlib.sha256(definition.encode("utf-8")).digest())
    results = ["n_bytes", "n_tokens", "over_limit"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = without(docs, results).withColumn("__digest", digest_of(F.col(text_col)))

    distinct = keyed.select(F.col("__digest").alias("digest"), text.alias("text")).groupBy("digest").agg(F.any_value("text").alias("text"))
    stored = read_cache(spark, cache_path).where(F.col("version") == version).select("digest").distinct()
    misses = distinct.join(stored, "digest", "left_anti")
    counted = misses.select(version.alias("version"), "digest", _counter(definition, chunk_chars)(F.col("text")).alias("n_tokens"))
    counted.write.mode("append").parquet(cache_path)

    rows = keyed.withColumn("n_bytes", F.octet_length(text).cast("long")).drop(text_col)
    asked = rows.groupBy(F.col("__digest").alias("digest")).agg(F.count("*").alias(ASKED))
    counts = read_cache(spark, cache_path).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    table = asked.join(counts, "digest").withColumnRenamed("digest", "__digest")
    return lookup_join(rows, table, ["__digest"]).drop("__digest").withColumn("over_limit", F.col("n_tokens") > limit)
