"""Table schemas. Column names and spellings are the data contract, `avalaible` included."""

from __future__ import annotations

from pyspark.sql import types as T

# The canonical listing columns, in their written order.
LISTING = T.StructType(
    [
        T.StructField("internal_id", T.LongType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("added_date", T.DateType()),
        T.StructField("avalaible", T.BooleanType()),
        T.StructField("archived_date", T.DateType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("category_value", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("deal_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("rooms", T.StringType()),
        T.StructField("area_build", T.DoubleType()),
        T.StructField("area_land", T.DoubleType()),
        T.StructField("house_type", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("city_part", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("house_number", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("district_id", T.LongType()),
        T.StructField("municipality_id", T.LongType()),
        T.StructField("region_id", T.LongType()),
        T.StructField("street_id", T.LongType()),
    ]
)

# What the geo layer adds.
GEO_COLUMNS = ["region", "norm_city", "norm_city_part", "norm_ulice"]

LISTING_GEO = T.StructType(LISTING.fields + [T.StructField(c, T.StringType()) for c in GEO_COLUMNS])

GAZETTEER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("nazev_obce", "nazev_casti_obce", "nazev_ulice", "kraj")]
)

PRICE_SNAPSHOT = T.StructType(
    [
        T.StructField("internal_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

PRICE_CHANGE = T.StructType(
    [
        T.StructField("internal_id", T.LongType()),
        T.StructField("old_price", T.DoubleType()),
        T.StructField("new_price", T.DoubleType()),
        T.StructField("price_date", T.DateType()),
    ]
)

SELLERS = T.StructType(
    [
        T.StructField("internal_id", T.LongType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("agent_phone", T.StringType()),
        T.StructField("agent_email", T.StringType()),
        T.StructField("added_date", T.DateType()),
    ]
)

PHOTO_LINKS = T.StructType(
    [
        T.StructField("internal_id", T.LongType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("photo_url", T.StringType()),
        T.StructField("added_date", T.TimestampType()),
        T.StructField("source_id", T.IntegerType()),
    ]
)

FAILURES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("timestamp", "internal_id", "url", "source_column", "error_message")]
)

RUN_LOG = T.StructType(
    [
        T.StructField("parser_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("total_new_ids", T.LongType()),
        T.StructField("total_archived_ids", T.LongType()),
        T.StructField("new_records", T.LongType()),
        T.StructField("archived_records", T.LongType()),
        T.StructField("price_changes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
