"""Writing: appends, day replacement, versions of a mutable table, ledgers, batch plans.

Files have no in-place update. A mutable table is therefore a folder of versions:
a change reads the newest version, writes the next one beside it and commits it with a record
(`commits`), so a job that dies half way leaves the table as it was and the version free.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialized
from .commits import AlreadyCommitted, commit, commit_files, committed, forget, record
from .tables import drop_path, newest_value, partition_values

# A ledger's CSV keeps quotes and line breaks inside a field.
LEDGER_CSV = {"header": True, "escape": '"', "multiLine": True}


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows; with partition columns, their rows are brought together first, so that a
    folder gets few files. Large partitions are split by Spark (`rebalance`)."""
    if not partition_by:
        df.write.mode("append").parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def replace_partition(df: DataFrame, path: str, date_column: str = "snapshot_date") -> None:
    """Replace exactly the days that occur in `df`; other days stay. Each day is recorded with its files once it is whole."""
    seen = Observation()
    days = df.observe(seen, F.collect_set(F.col(date_column).cast("string")).alias("days")).hint("rebalance", date_column)
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column).parquet(path)
    for day in sorted(seen.get["days"]):
        commit_files(df.sparkSession, path, f"{date_column}={day}")


def stage(frames: dict[str, DataFrame], path: str, version: int) -> dict:
    """Write the tables of a version into folders of their own, unseen by readers: what its record will say."""
    folders, rows = {}, {}
    attempt = uuid.uuid4().hex
    for name, df in frames.items():
        seen = Observation()
        folders[name] = f"version={version}/{attempt}/{name}"
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folders[name]}")
        rows[name] = seen.get["rows"]
    return {"folders": folders, "rows": rows}


def publish_set(frames: dict[str, DataFrame], path: str, version: int) -> dict[str, int]:
    """Write one version of several tables that change together, such as listings and their quarantine; rows of each.

    One record names them all, so readers see all of a version or none of it. A version that was committed is never
    overwritten (`AlreadyCommitted`); one that died before may be published again.
    """
    spark = next(iter(frames.values())).sparkSession
    name = f"version={version}"
    if name in committed(spark, path):
        raise AlreadyCommitted(f"{name} of {path} is committed already")
    content = stage(frames, path, version)
    commit(spark, path, name, content)
    return content["rows"]


def read_set(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the newest committed version; older ones are not opened."""
    versions = [int(n.partition("=")[2]) for n in committed(spark, path) if n.startswith("version=")]
    if not versions:
        raise ValueError("no version found")
    return spark.read.parquet(f"{path}/{record(spark, path, f'version={max(versions)}')['folders'][name]}")


TABLE = "table"


def publish(df: DataFrame, path: str, version: int) -> int:
    """Write and commit one version of a mutable table; its rows, counted while they are written."""
    return publish_set({TABLE: df}, path, version)[TABLE]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a mutable table."""
    return read_set(spark, path, TABLE)


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest `keep` committed versions of a mutable table; the versions deleted."""
    known = set(committed(spark, path))
    old = [v for v in partition_values(spark, path, "version") if f"version={v}" in known][:-keep]
    for version in old:
        forget(spark, path, f"version={version}")
        drop_path(spark, f"{path}/version={version}")
    return old


def drop_days(spark: SparkSession, path: str, before: str, date_column: str = "snapshot_date") -> list[str]:
    """Delete the day partitions before an ISO day; the days deleted."""
    old = [day for day in partition_values(spark, path, date_column) if day < before]
    for day in old:
        drop_path(spark, f"{path}/{date_column}={day}")
    return old


def ensure_table(spark: SparkSession, table: str, like: DataFrame) -> None:
    """Create an empty table with the columns of `like` unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def copy_table(df: DataFrame, path: str) -> DataFrame:
    """Write a table elsewhere and hand back the copy, schema included."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def record_failures(failures: DataFrame, path: str, run: str | None = None) -> None:
    """Append failure records to the CSV ledger and to the JSON ledger; they are computed once.

    With a `run` its records replace those it left before, in both ledgers: a run may be repeated after it died, also
    one that has no failures any more. A ledger is kept with runs or without: Spark reads partitions or loose files.
    """
    once = materialized(failures, "failures")
    if run is None:
        once.write.mode("append").options(**LEDGER_CSV).csv(f"{path}/csv")
        once.write.mode("append").json(f"{path}/json")
        return
    if once.isEmpty():  # a dynamic overwrite by no rows would leave what is there
        for ledger in ("csv", "json"):
            drop_path(once.sparkSession, f"{path}/{ledger}/run={run}")
        return
    mine = once.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run")
    mine.options(**LEDGER_CSV).csv(f"{path}/csv")
    mine.json(f"{path}/json")


def read_failures(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV ledger, messages of several lines included."""
    return spark.read.schema(schema).options(**LEDGER_CSV).csv(f"{path}/csv").select(*[f"`{c}`" for c in schema.names])


def write_batches(batches: DataFrame, path: str, run: str) -> None:
    """Persist a batch plan; `run` names sort by time, such as YYYYMMDD_HHMMSS.

    A run is one folder, recorded once it is whole. Batches lie together in its files, as many as the plan's size asks for.
    """
    clustered = batches.withColumn("run", F.lit(run)).hint("rebalance", "batch_no").sortWithinPartitions("batch_no")
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").json(path)
    commit_files(batches.sparkSession, path, f"run={run}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest batch plan that is whole."""
    run = newest_value(spark, path, "run")
    return spark.read.schema(f"{schema}, batch_no bigint").json(f"{path}/run={run}").withColumn("run", F.lit(run))
