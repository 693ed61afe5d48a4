"""Stage 2: canonical listings to the silver layer and the geo layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import category
from ..operators.conform import conform
from ..operators.maintain import apply_changes, change_summary, layer_changes
from ..schemas import LISTING

# Key and watched columns of the layers.
KEY = "internal_id"
WATCHED = ["avalaible", "archived_date"]


def to_silver(listings: DataFrame) -> DataFrame:
    """Category by name, dates without time, house type set to the category."""
    kind = category(F.col("category_name"))
    rows = listings.withColumns(
        {
            "category_value": kind.getField("category_value"),
            "category_name": kind.getField("category_name"),
            "added_date": F.to_date("added_date"),
            "archived_date": F.to_date("archived_date"),
            "house_type": kind.getField("category_value").cast("string"),
        }
    )
    return conform(rows, LISTING)


def sync_layer(rows: DataFrame, target: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(next version of the target, its one-line summary)."""
    changes = layer_changes(rows, target, KEY, WATCHED)
    return apply_changes(target, changes, KEY, WATCHED), change_summary(changes, table)
