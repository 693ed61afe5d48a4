"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "plotwright", **settings: str) -> SparkSession:
    """A session with the defaults above; `settings` (dots as `__`) win over them."""
    builder = SparkSession.builder.appName(app_name)
    overrides = {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`."""
    base = _configured_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return base


def _run_dir(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"plotwright-{spark.sparkContext.applicationId}")


def work_path(spark: SparkSession, name: str) -> str:
    """A path for one written table of this run, unused so far."""
    return os.path.join(_run_dir(spark), f"{name}-{uuid.uuid4().hex}")


def drop_work(spark: SparkSession) -> None:
    """Delete the work tables of this run, once no result that reads them is needed any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from the files.

    This cuts the lineage where several results start from one table: lost executors
    read it again instead of redoing it, and Spark plans what follows with its true size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out over all shuffle partitions, ahead of a step that multiplies them.

    The planner sizes partitions by what it reads, not by what an explode makes of it.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)
