"""A corpus cleaned in stages: toxic documents go, repeated lines, near copies, test items; the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwright.llm import bpe, decontaminate, lines, ngram_join, toxicity
from plotwright.llm.common import table
from plotwright.llm.queries import RANKS, fold
from plotwright.session import materialized


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model learns from the labels of `sf_dir` and the texts at hand.

    `n_chars` is left as it is. With no labels, or labels of one class, every text has their smoothed share as score.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    scored = toxicity.score_texts(docs, model)
    return scored.where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


# A character of a word as the n-gram join reads it.
WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"


def no_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go from the texts; `n_chars` follows where a text changed.

    A document that loses its last line or word by this goes: all it said is in lines that stay elsewhere, and
    without words it would meet no copy in the next stage. Texts that were empty or wordless before stay.
    """
    out = lines.dedup_lines(docs.withColumn("__worded", F.coalesce(F.col("text").rlike(WORD), F.lit(False))))
    emptied = (F.btrim("text", F.lit(" \t\r\n")) == "") | (F.col("__worded") & ~F.col("text").rlike(WORD))
    out = out.where(~((F.col("n_removed") > 0) & emptied))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group of near copies."""
    return ngram_join.one_of_each(docs)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    found = decontaminate.find_test_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left, and whether they decode to the text."""
    ranks = bpe.load_ranks(spark, public_tokenizers.path(RANKS))
    return bpe.transcode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", clean_language),
    ("line dedup", no_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_test_items),
    ("byte-level BPE", token_ids),
]

# Scores, similarities and merges cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
