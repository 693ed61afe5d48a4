"""The operators run over the test tables, each beside the SQL it has to agree with."""

from . import day, dedup, geo, loads, maintenance, selection, text  # noqa: F401  (they register themselves)
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
