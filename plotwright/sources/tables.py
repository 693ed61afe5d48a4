"""Reading: pruned scans, latest snapshots, existence checks, copies."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import finished, folder

# Feed name and id of each source, and the form of a dated table name.
SOURCES = {"sreality": 1, "bzereality": 2, "hyper": 3, "idnes": 4}
DATED_NAME = r"^%s_[0-9]{8}$"


def scan(df: DataFrame, columns: list[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Chosen rows and columns; both reach the file scan."""
    kept = df if where is None else df.where(where)
    return kept.select(*columns) if columns else kept


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's first partition column, in order, from its folders; no file is opened.

    Whole numbers are in the order of numbers, other values in that of their text.
    """
    system, place = folder(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    values = [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]
    return sorted(values, key=lambda v: (0, int(v), v) if v.isdecimal() else (1, 0, v))


def newest_value(spark: SparkSession, path: str, column: str) -> str:
    """The newest partition that is whole; one that a dead job left half-written is passed over."""
    for value in reversed(partition_values(spark, path, column)):
        if finished(spark, path, [f"{column}={value}"]):
            return value
    raise ValueError("no snapshot found")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    system, place = folder(spark, path)
    system.delete(place, True)


def read_latest_snapshot(spark: SparkSession, path: str, date_column: str = "snapshot_date") -> DataFrame:
    """Rows of the latest snapshot of a table partitioned by day: a literal filter, so only its files are read."""
    return spark.read.parquet(path).where(F.col(date_column) == F.lit(newest_value(spark, path, date_column)))


def latest_snapshot(df: DataFrame, date_column: str = "snapshot_date") -> DataFrame:
    """Rows of the latest snapshot of a table that is not partitioned; this reads the date of every row."""
    if df.select(date_column).isEmpty():
        raise ValueError("no snapshot found")
    return df.where(F.col(date_column) == df.agg(F.max(date_column)).scalar())


def latest_table(spark: SparkSession, source: str, database: str | None = None) -> str:
    """Name of the latest `<source>_YYYYMMDD` table of the catalog."""
    pattern = re.compile(DATED_NAME % re.escape(source))
    names = [t.name for t in spark.catalog.listTables(database, f"{source}_*") if pattern.match(t.name)]
    if not names:
        raise ValueError(f"no dated table of source {source}")
    return max(names)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def column_exists(df: DataFrame, name: str) -> bool:
    return name in df.columns


def snapshot_exists(df: DataFrame, date: Column, date_column: str = "snapshot_date") -> bool:
    return not df.where(F.col(date_column) == date).isEmpty()


def read_jdbc(
    spark: SparkSession, table: str, options: dict, partition_column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """A database table read in parallel ranges of a numeric column; credentials come in `options`."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, the same columns."""
    return df.sparkSession.createDataFrame([], df.schema)
