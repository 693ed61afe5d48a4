"""A keyed table that takes updates without being rewritten: buckets of base files, deltas beside them, compaction.

Readers see the newest row of each key. An update writes its rows alone; a compaction rewrites the buckets that
updates touched and leaves the files of all others. Each state is a commit record that names the folders it is made of.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lookup import same_key
from .commits import commit, committed, record
from .tables import partition_values

BUCKETS = 64
_BUCKET, _GONE, _AT = "merge_bucket", "merge_deleted", "merge_at"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, keys: list[str], buckets: int) -> str:
    """Write rows by bucket into a folder of their own, and name it."""
    folder = f"data/{uuid.uuid4().hex}"
    placed = df.withColumn(_BUCKET, _bucket(keys, buckets)).hint("rebalance", _BUCKET)
    placed.write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    return folder


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    states = [int(n.partition("=")[2]) for n in committed(spark, path) if n.startswith("state=")]
    if not states:
        raise ValueError("no such table")
    return max(states), record(spark, path, f"state={max(states)}")


def _folders(spark: SparkSession, path: str, folder: str) -> dict[str, str]:
    return {b: f"{folder}/{_BUCKET}={b}" for b in partition_values(spark, f"{path}/{folder}", _BUCKET)}


def create_merged(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """A table with one row for each key, in `buckets` buckets: a record lists them, so take thousands at most."""
    spark = df.sparkSession
    base = _folders(spark, path, _write(df, path, keys, buckets))
    schema = df.schema.json()
    commit(spark, path, "state=1", {"keys": keys, "buckets": buckets, "schema": schema, "base": base, "deltas": []})


def _update(rows: DataFrame, path: str, deleted: bool) -> int:
    spark = rows.sparkSession
    number, state = _state(spark, path)
    marked = rows.withColumn(_GONE, F.lit(deleted))
    delta = _write(marked, path, state["keys"], state["buckets"])
    commit(spark, path, f"state={number + 1}", state | {"deltas": [*state["deltas"], delta]})
    return number + 1


def upsert_rows(rows: DataFrame, path: str) -> int:
    """Whole rows that replace those of their keys or are new; the number of the state this makes.

    Of rows that share a key within one update any one stays. Another update that comes first makes this fail (`AlreadyCommitted`).
    """
    return _update(rows, path, False)


def delete_rows(keys: DataFrame, path: str) -> int:
    """Rows of these keys go; `keys` has the key columns, others are not looked at."""
    _, state = _state(keys.sparkSession, path)
    schema = _schema(state)
    full = keys.select(*[
        (F.col(f"`{f.name}`") if f.name in state["keys"] else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
    return _update(full, path, True)


def change_rows(rows: DataFrame, gone: DataFrame, path: str) -> int:
    """`upsert_rows` and `delete_rows` as one state; no key may be in both."""
    spark = rows.sparkSession
    number, state = _state(spark, path)
    schema = _schema(state)
    dropped = gone.select(*[
        (F.col(f"`{f.name}`") if f.name in state["keys"] else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
    kept = rows.select(*[F.col(f"`{c}`") for c in schema.names]).withColumn(_GONE, F.lit(False))
    delta = _write(kept.unionByName(dropped.withColumn(_GONE, F.lit(True))), path, state["keys"], state["buckets"])
    commit(spark, path, f"state={number + 1}", state | {"deltas": [*state["deltas"], delta]})
    return number + 1


def delta_count(spark: SparkSession, path: str) -> int | None:
    """How many deltas wait for a compaction; None where there is no table yet."""
    if not any(n.startswith("state=") for n in committed(spark, path)):
        return None
    return len(_state(spark, path)[1]["deltas"])


def _schema(state: dict) -> StructType:
    return StructType.fromJson(json.loads(state["schema"]))


def _newest(spark: SparkSession, path: str, state: dict, deltas: list[str]) -> DataFrame:
    """The last word of the deltas on each of their keys."""
    columns = _schema(state).names
    rows = None
    for at, delta in enumerate(deltas):
        one = spark.read.parquet(f"{path}/{delta}").drop(_BUCKET).withColumn(_AT, F.lit(at))
        rows = one if rows is None else rows.unionByName(one)
    whole = F.struct(*[F.col(f"`{c}`") for c in columns], F.col(_GONE))
    keyed = rows.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(state["keys"])])
    return keyed.agg(F.max_by(whole, F.col(_AT)).alias("row"))


def _merged(spark: SparkSession, path: str, state: dict, base: list[str], deltas: list[str]) -> DataFrame:
    schema = _schema(state)
    kept = spark.read.schema(schema).parquet(*[f"{path}/{b}" for b in base]) if base else spark.createDataFrame([], schema)
    if not deltas:
        return kept
    newest = _newest(spark, path, state, deltas)
    on = same_key(kept, newest, [(k, f"_k{i}") for i, k in enumerate(state["keys"])])
    changed = newest.where(~F.col(f"row.{_GONE}")).select(*[F.col(f"row.`{c}`").alias(c) for c in schema.names])
    return kept.join(newest, on, "left_anti").unionByName(changed)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """One row for each key: the newest one, unless it was deleted. The base is joined to the deltas' keys, not sorted."""
    _, state = _state(spark, path)
    return _merged(spark, path, state, list(state["base"].values()), state["deltas"])


def compact(spark: SparkSession, path: str) -> list[str]:
    """Merge the deltas into the base: only buckets they touch are read and written; their numbers."""
    number, state = _state(spark, path)
    touched = sorted({b for d in state["deltas"] for b in partition_values(spark, f"{path}/{d}", _BUCKET)}, key=int)
    if not touched:
        return []
    base = state["base"]
    rows = _merged(spark, path, state, [base[b] for b in touched if b in base], state["deltas"])
    made = _folders(spark, path, _write(rows, path, state["keys"], state["buckets"]))
    rest = {b: f for b, f in base.items() if b not in touched}
    commit(spark, path, f"state={number + 1}", state | {"base": rest | made, "deltas": []})
    return touched
