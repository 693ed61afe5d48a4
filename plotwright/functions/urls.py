"""Photo URL lists in the shapes the feeds deliver them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source columns in the order they are tried, and the storage key layout.
URL_SOURCES = ["hyper_reality", "sreality_image_urls", "bezrealitky_image_urls", "idnes"]
STORAGE_KEY = "%s%s_%s_%s.jpg"


def url_list(c: Column) -> Column:
    """Text to array of items: a JSON array, a single JSON value, or one bare URL.

    Object items keep their JSON text; `item_urls` reads their `url` field. For an
    array of arrays only the first inner array counts.
    """
    items = F.from_json(c, "array<string>")
    nested = F.from_json(c, "array<array<string>>")
    scalar = F.try_variant_get(F.try_parse_json(c), "$", "string")
    return (
        F.when(F.ltrim(c).rlike(r"^\[\s*\["), F.get(nested, F.lit(0)))
        .when(F.startswith(F.ltrim(c), F.lit("[")) & items.isNotNull(), items)
        .when(c.isNotNull() & (c != ""), F.array(F.coalesce(scalar, c)))
    )


def nested_first(c: Column) -> Column:
    """Native array of arrays to its first inner array."""
    return F.get(c, F.lit(0))


def item_urls(items: Column) -> Column:
    """Items to URLs: the text itself or its `url` field; empty ones dropped."""
    urls = F.transform(
        items,
        lambda i: F.when(F.startswith(F.ltrim(i), F.lit("{")), F.get_json_object(i, "$.url")).otherwise(i),
    )
    return F.filter(urls, lambda u: u.isNotNull() & (u != ""))


def storage_key(root: Column, listing_id: Column, source: Column, index: Column) -> Column:
    return F.format_string(STORAGE_KEY, root, listing_id.cast("string"), source, index.cast("string"))
