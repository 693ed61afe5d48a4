"""JSON payload columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for field in schema.fields:
        here = (*path, field.name)
        found += _leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return found


def flatten_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The payload's fields as columns, nested names joined by dots, beside the other columns."""
    others = [c for c in df.columns if c != column]
    parsed = df.withColumn(column, F.from_json(column, schema))

    def reach(path: tuple[str, ...]):
        value = F.col(f"`{column}`")
        for name in path:
            value = value.getField(name)
        return value.alias(".".join(path))

    return parsed.select(*others, *[reach(p) for p in _leaves(schema)])


def variant_field(df: DataFrame, column: str, path: str, data_type: str, name: str) -> DataFrame:
    """One field of a payload without fixed schema; null where missing or malformed."""
    return df.withColumn(name, F.try_variant_get(F.try_parse_json(column), path, data_type))
