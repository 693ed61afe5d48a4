"""Run log and failure ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_log(
    parser_name: str, table_name: str, processed_at: Column, added: DataFrame, archived: DataFrame, changes: DataFrame
) -> DataFrame:
    """The one-row log entry of a load, counted in one job."""
    kinds = [("a", added), ("r", archived), ("c", changes)]
    marks = None
    for mark, df in kinds:
        marked = df.select(F.lit(mark).alias("kind"))
        marks = marked if marks is None else marks.unionAll(marked)

    def count(mark: str) -> Column:
        return F.count_if(F.col("kind") == mark)

    return marks.agg(
        count("a").alias("total_new_ids"),
        count("r").alias("total_archived_ids"),
        count("a").alias("new_records"),
        count("r").alias("archived_records"),
        count("c").alias("price_changes"),
    ).select(
        F.lit(parser_name).alias("parser_name"),
        F.lit(table_name).alias("table_name"),
        processed_at.alias("processed_at"),
        "total_new_ids",
        "total_archived_ids",
        "new_records",
        "archived_records",
        "price_changes",
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("message"),
    )


def failure_counts(failures: DataFrame) -> DataFrame:
    return failures.groupBy("internal_id").agg(F.count("*").alias("n_failures"))


def failures_of(failures: DataFrame, internal_id: str) -> DataFrame:
    return failures.where(F.col("internal_id") == internal_id)
