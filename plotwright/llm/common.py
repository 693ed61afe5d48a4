"""What several operators share: words, keys, column clashes, Arrow batches and whole sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a word keep their value (A-Z in lower case), all others become a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text whose A-Z are lower-cased, as UTF-8; none of a null.

    Every byte of a character beyond ASCII is 128 or more, so the class can be read bytewise.
    """
    return encoded(text).translate(_WORD_BYTES).split()


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` less the columns an operator is about to add: its own win over input columns of the same name."""
    clash = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in clash])


def with_fields(df: DataFrame, answer: Column, fields: list[str]) -> DataFrame:
    """`df` with the fields of a struct-valued column added; the struct is computed once."""
    kept = without(df, fields)
    names = [f"`{c}`" for c in kept.columns]
    return kept.withColumn("__answer", answer).select(*names, *[F.col(f"__answer.{f}").alias(f) for f in fields])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches sorted by `key`; one group or about `rows` rows at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        if held and count >= rows:
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1]
            start = _run_end(keys, last)
            if start:
                held.append(batch.slice(0, start))
            if start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
                batch = batch.slice(start)
            else:
                continue
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _run_end(keys: pa.Array, value: pa.Scalar) -> int:
    """How many of the sorted keys, from the first, equal `value`."""
    low, high = 0, len(keys)
    while low < high:
        mid = (low + high) // 2
        if keys[mid].equals(value):
            low = mid + 1
        else:
            high = mid
    return low


def by_group(
    df: DataFrame, key: str, work: Callable[[pa.Table], pa.Table | None], schema: str, rows: int = 20_000
) -> DataFrame:
    """`work` over tables of whole groups; groups of one `key` value are never split, small ones come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, key, rows):
            out = work(group)
            if out is not None and out.num_rows:
                yield from out.to_batches(max_chunksize=10_000)

    parts = shuffle_partitions(df.sparkSession)
    return df.repartition(parts, key).sortWithinPartitions(key).mapInArrow(run, schema)
