"""Registry of checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its SQL."""

    def add(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate check {name}")
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, **more: DataFrame) -> DataFrame:
    """A derived input from SQL that both engines understand; tables are named `{table}`."""
    names = ["region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages"]
    used = {n: table(spark, sf_dir, n) for n in names if "{" + n + "}" in sql}
    return spark.sql(sql, **used, **more)


def duck(sql: str) -> str:
    """The same SQL for the other engine."""
    out = sql
    for n in ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages"):
        out = out.replace("{" + n + "}", n)
    return out


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
