"""Left lookup of row values in a table with one row per key, safe against hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000
SALTS = 1024
# Column of a lookup table that says how many rows will ask for the key.
ASKED = "n_asked"


def distinct_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, with the number of rows that carry it."""
    return rows.groupBy(*keys).agg(F.count("*").alias(ASKED))


def same_key(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> Column:
    """Null-safe equality of the paired columns; Spark still runs it as an equi-join."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in on])


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: list[str], needs: Column | None = None, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """`rows` with the columns of `table` (unique on `keys`) added, null where absent or not needed.

    `table` has every key that a row with `needs` carries, and says in `n_asked` by how
    many rows. The keys asked most are answered by a broadcast of at most `hot_keys`
    rows, a bound that does not move with the data. Their rows, and those without a
    need, get a spread-out key in the shuffled join for everything else, in which no
    key then holds more than 1/hot_keys of the rows.
    """
    values = [c for c in table.columns if c not in [*keys, ASKED]]
    needed = F.lit(True) if needs is None else F.coalesce(needs, F.lit(False))
    hot = table.orderBy(F.desc(ASKED), *keys).limit(hot_keys).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(v).alias(f"_h_{v}") for v in values], F.lit(True).alias("_hot")
    )
    asking = rows.withColumn("_needed", needed)
    marked = asking.join(F.broadcast(hot), same_key(asking, hot, [(k, f"_k_{k}") for k in keys]), "left")
    spread = F.pmod(F.xxhash64(*[marked[c] for c in rows.columns]), F.lit(SALTS)).cast("int") + 1
    marked = marked.withColumn("_salt", F.when(F.col("_hot") | ~F.col("_needed"), spread).otherwise(F.lit(0)))
    cold = table.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], *[F.col(v).alias(f"_v_{v}") for v in values], F.lit(0).alias("_zero")
    )
    joined = marked.join(
        cold, same_key(marked, cold, [(k, f"_c_{k}") for k in keys]) & (marked["_salt"] == cold["_zero"]), "left"
    )
    answer = {v: F.when(F.col("_hot"), F.col(f"_h_{v}")).otherwise(F.col(f"_v_{v}")) for v in values}
    return joined.select(
        *[joined[c] for c in rows.columns], *[F.when(F.col("_needed"), a).alias(v) for v, a in answer.items()]
    )
