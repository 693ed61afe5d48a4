"""Tables that lie bucketed and sorted by key, so that a daily comparison joins them bucket to bucket, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """A new catalog table in `buckets` buckets by `keys`, one sorted file each, and the table as Spark reads it.

    Tables that are compared need the same keys and number of buckets: as many as leave a bucket some hundred
    megabytes. This is the one shuffle of the rows; comparisons, updates and distinct keys need none after it.
    Rows with a null key lie in one bucket. A table of the name that is there already is not touched (an error).
    """
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """The number of buckets of a catalog table; None if it has none."""
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == "Num Buckets").select("data_type").first()
    return None if found is None else int(found[0])
