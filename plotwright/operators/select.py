"""Choosing, numbering and counting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialized

# Rows that one task puts in order at most; a longer head is numbered over ranges.
ONE_TASK_ROWS = 10_000


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the first in order; map tasks keep one row per key each."""
    others = [c for c in df.columns if c not in keys]
    ordered = F.struct(*order)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordered).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the last in order."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def pending(df: DataFrame, done_column: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Work queue: rows whose result column is still null, in order, at most `limit`."""
    queue = df.where(F.col(done_column).isNull())
    return queue if limit is None else first_rows(queue, order, limit)


def unprocessed(links: DataFrame, key: str, done: str, taken: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per key whose `done` array is null or empty and that is not taken yet, in key order.

    Among several rows of a key the smallest is kept.
    """
    others = [c for c in links.columns if c not in (key, done)]
    waiting = links.where(F.col(done).isNull() | (F.size(done) == 0)).drop(done)
    fresh = first_per_key(key_difference(waiting, taken, [key]), [key], others)
    return fresh if limit is None else first_rows(fresh, [key], limit)


def _ranges(df: DataFrame, order: list[str], partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """The rows by range of the order, written once with `_part`, and how many rows lie before each range."""
    partitions = partitions or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialized(dealt, "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return ranged, sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def first_rows(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first `limit` rows in the order of some columns, nulls first; of rows that are equal there any come first.

    A short head is one task's work. A long one stays in its ranges: those that begin within it are
    numbered, each by itself, and keep what lies below the limit.
    """
    if limit <= ONE_TASK_ROWS:
        return df.orderBy(*order).limit(limit)
    ranged, offsets = _ranges(df, order, None)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    near = ranged.join(F.broadcast(offsets.where(F.col("_offset") < limit)), "_part")
    return near.withColumn("_place", place).where(F.col("_offset") + F.col("_place") <= limit).select(*df.columns)


def numbered(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """`row_no` 0, 1, 2 .. in the order of a unique numeric key.

    Rows are dealt to key ranges of about equal size, by a sample, and written once; a
    row's number is its place within the range plus the rows of the ranges before. The
    table of range sizes has one row per range, whatever the data.
    """
    ranged, offsets = _ranges(df, [key], partitions)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_no", F.col("_offset") + F.col("_place") - 1)
        .drop("_part", "_place", "_offset")
    )


def batches(df: DataFrame, key: str, size: int, partitions: int | None = None) -> DataFrame:
    """`batch_no`: consecutive batches of `size` rows in the order of a unique numeric key."""
    return numbered(df, key, partitions).withColumn("batch_no", F.expr(f"row_no div {size}")).drop("row_no")


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n random rows; the same seed picks the same rows, also after a lost executor."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The n most frequent values, null among them, with their counts."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(n)


def key_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def key_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the other set."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def distinct_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Number of different pairs."""
    return df.select(left, right).distinct().agg(F.count("*").alias("n_pairs"))


def progress(df: DataFrame, done: Column) -> DataFrame:
    """Total, processed and remaining rows; a row of which it is not known remains."""
    known = F.coalesce(done, F.lit(False))
    return df.agg(
        F.count("*").alias("total"), F.count_if(known).alias("processed"), F.count_if(~known).alias("remaining")
    )
