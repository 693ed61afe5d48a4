"""Keyed maintenance of a table, as the rows of its next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_columns(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Target rows with `columns` taken from the update of the same key, where there is one.

    Several updates of one key are settled before the join: the smallest wins.
    """
    one = updates.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_u"))
    joined = target.join(one, keys, "left")
    matched = F.col("_u").isNotNull()
    return joined.withColumns(
        {c: F.when(matched, F.col(f"_u.{c}")).otherwise(F.col(c)) for c in columns}
    ).select(*target.columns)


def delete_keys(target: DataFrame, keys_to_delete: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(keys_to_delete.select(*keys).distinct(), keys, "left_anti")


def retain(df: DataFrame, today: Column, days: int = 2, date_column: str = "snapshot_date") -> DataFrame:
    """The snapshots of the last `days` days; on a partitioned table a pure partition filter."""
    return df.where(F.col(date_column) > F.date_sub(today, days))


def clear_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))


def filled_count(df: DataFrame, column: str) -> DataFrame:
    """Rows in all and rows with a value, as known before a reset."""
    return df.agg(F.count("*").alias("total"), F.count(column).alias("filled"))


def truncate(df: DataFrame) -> DataFrame:
    return df.limit(0)


def layer_changes(source: DataFrame, target: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """Source rows the target lacks (`insert`) or holds with other watched values (`update`).

    One join answers both. Null equals null, so rows without an archive date do not
    count as changed.
    """
    held = target.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_held_{c}") for c in watched], F.lit(True).alias("_found")
    )
    joined = source.join(held, source[key] == held["_key"], "left")
    changed = F.lit(False)
    for c in watched:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_held_{c}"))
    action = F.when(F.col("_found").isNull(), F.lit("insert")).when(changed, F.lit("update"))
    return joined.select(*[source[c] for c in source.columns], action.alias("action")).where(F.col("action").isNotNull())


def apply_changes(target: DataFrame, changes: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """The target after its inserts and updates; columns the source lacks start as null."""
    updated = upsert_columns(target, changes.where(F.col("action") == "update"), [key], watched)
    added = changes.where(F.col("action") == "insert").drop("action")
    return updated.unionByName(added, allowMissingColumns=True).select(*target.columns)


def change_summary(changes: DataFrame, table: str) -> DataFrame:
    """Added and updated rows, one line per table."""
    return changes.agg(
        F.max(F.lit(table)).alias("table_name"),
        F.count_if(F.col("action") == "insert").alias("rows_added"),
        F.count_if(F.col("action") == "update").alias("rows_updated"),
    )
