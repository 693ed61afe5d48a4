"""Near duplicates of new signatures among stored ones, by a band index that is kept between runs.

`near_pairs` joins a table with itself. Here the keys of the stored side stay on disk, in parts by the hash of
(band, value): a day's new signatures read the parts that their own keys fall in, find their pairs among the stored and
among themselves, and are then filed as one more generation. The cut into bands is settled when the index is made.
Where testing a signature against all that are expected costs less than its keys, no keys are filed: the index holds
the signatures alone, and new ones are tested against these block by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bits import max_distance
from ..session import materialized
from ..sources.commits import AlreadyCommitted, commit, committed, record
from .neighbors import _entries, _known, _met, band_plan, blocks_are_cheaper, compared_across, near_pairs

PARTS = 64
_PLAN = "index"


def create_index(spark: SparkSession, path: str, n_bits: int, similarity: float, expected: int, parts: int = PARTS) -> None:
    """An empty index for hex signatures of `n_bits`, cut into bands as suits `expected` of them (speed only).

    `parts` is the number of folders of a generation; the more there are, the less a small probe reads.
    """
    k = max_distance(n_bits, similarity)
    plan = band_plan(n_bits, k, expected)
    if blocks_are_cheaper(n_bits, plan, expected, expected):
        plan = None
    commit(spark, path, _PLAN, {"n_bits": n_bits, "similarity": similarity, "k": k, "plan": plan, "parts": parts, "expected": expected})


def _settings(spark: SparkSession, path: str) -> dict:
    made = record(spark, path, _PLAN)
    return made | {"plan": made["plan"] and [tuple(band) for band in made["plan"]]}


def _generations(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in committed(spark, path) if n.startswith("generation="))


def _filed(df: DataFrame, made: dict, left: bool) -> DataFrame:
    entries = _entries(_known(df, made["n_bits"], made["plan"]), made["plan"], left).drop("bucket")
    return entries.withColumn("part", F.pmod(F.xxhash64("band", "value"), F.lit(made["parts"])).cast("int"))


def _folders(spark: SparkSession, path: str, kind: str) -> list[str]:
    return [f"{path}/{record(spark, path, f'generation={g}')['folder']}/{kind}" for g in _generations(spark, path)]


def unseen(signatures: DataFrame, path: str) -> DataFrame:
    """The distinct signatures that the index does not hold yet; nulls are none."""
    spark = signatures.sparkSession
    new = signatures.select("signature").where("signature IS NOT NULL").distinct()
    folders = _folders(spark, path, "signatures")
    return new.join(spark.read.parquet(*folders), "signature", "left_anti") if folders else new


def stored_entries(spark: SparkSession, path: str, parts: list[int]) -> DataFrame | None:
    """The stored side's keys in these parts: a literal filter, so only their folders are listed and read."""
    kept = None
    for folder in _folders(spark, path, "entries"):
        one = spark.read.parquet(folder).where(F.col("part").isin(parts))
        kept = one if kept is None else kept.unionByName(one)
    return kept


def probe(signatures: DataFrame, path: str) -> DataFrame:
    """(left, right, distance, similarity), left < right: the near pairs with at least one signature that is new to the index.

    New signatures play the left side of the join against the stored ones, whichever of a pair is the smaller; each pair is
    taken at one meeting point, as in `near_pairs`, which gives those among the new. Repeated and known signatures change
    nothing. A value under which very many are filed is split by Spark's skew handling.
    """
    spark = signatures.sparkSession
    made = _settings(spark, path)
    new = materialized(unseen(signatures, path), "new-signatures")
    among = near_pairs(new, made["n_bits"], made["similarity"])
    if made["plan"] is None:
        folders = _folders(spark, path, "signatures")
        return compared_across(new, spark.read.parquet(*folders), made["n_bits"], made["k"]).unionByName(among) if folders else among
    keys = _filed(new, made, True)
    # At most as many numbers as the index has parts.
    parts = sorted(r["part"] for r in keys.select("part").distinct().collect())
    stored = stored_entries(spark, path, parts)
    if stored is None:
        return among
    met = _met(keys, stored, ["part", "band", "value"], made["plan"], made["n_bits"], made["k"], F.lit(True))
    low, high = F.least("left", "right"), F.greatest("left", "right")
    return met.select(low.alias("left"), high.alias("right"), "distance", "similarity").unionByName(among)


def file_signatures(signatures: DataFrame, path: str) -> int:
    """File the signatures that are new to the index as its next generation; its number.

    A generation is seen once it is committed. What a job that died left behind is not, and filing again works;
    of two jobs that file at once, one fails with `AlreadyCommitted` and has to probe and file anew.
    """
    spark = signatures.sparkSession
    made = _settings(spark, path)
    generation = max(_generations(spark, path), default=0) + 1
    new = materialized(unseen(signatures, path), "new-signatures")
    folder = f"generations/{generation}-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    new.write.parquet(f"{path}/{folder}/signatures")
    if made["plan"]:
        _filed(new, made, False).hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/{folder}/entries")
    if generation in _generations(spark, path):
        raise AlreadyCommitted(f"generation {generation} of {path} is committed already")
    commit(spark, path, f"generation={generation}", {"folder": folder})
    return generation
