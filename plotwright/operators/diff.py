"""Comparing a feed with the listings already held."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _held(existing: DataFrame, compare: str) -> DataFrame:
    """`active`: archived listings do not count, so a relisted one is new again. `all`: they do."""
    if compare not in ("active", "all"):
        raise ValueError("compare is 'active' or 'all'")
    return existing.where(F.col("archived_date").isNull()) if compare == "active" else existing


def new_listings(feed: DataFrame, existing: DataFrame, keys: list[str], compare: str = "active") -> DataFrame:
    """Feed rows whose key is not held. Held keys are made unique before they are shuffled."""
    return feed.join(_held(existing, compare).select(*keys).distinct(), keys, "left_anti")


def gone_listings(feed: DataFrame, existing: DataFrame, keys: list[str], compare: str = "active") -> DataFrame:
    """Held rows whose key the feed no longer has."""
    return _held(existing, compare).join(feed.select(*keys).distinct(), keys, "left_anti")


def archive(existing: DataFrame, gone_keys: DataFrame, keys: list[str], today: Column) -> DataFrame:
    """All held rows, those listed marked unavailable as of today."""
    flagged = existing.join(gone_keys.select(*keys).distinct().withColumn("_gone", F.lit(True)), keys, "left")
    gone = F.coalesce(F.col("_gone"), F.lit(False))
    return flagged.withColumns(
        {
            "avalaible": F.when(gone, F.lit(False)).otherwise(F.col("avalaible")),
            "archived_date": F.when(gone, today).otherwise(F.col("archived_date")),
        }
    ).select(*existing.columns)


def attach_ids(rows: DataFrame, listings: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the internal id of their listing; rows without one are dropped."""
    return rows.join(listings.select(*keys, "internal_id"), keys)


def new_sellers(feed: DataFrame, listings: DataFrame, sellers: DataFrame, today: Column) -> DataFrame:
    """Complete seller records whose (listing, e-mail) is not yet held."""
    wanted = ["agent_name", "agent_phone", "agent_email", "site_id"]
    if not set(wanted) <= set(feed.columns):
        return sellers.limit(0)
    known = sellers.select("internal_id", "agent_email").distinct()
    matched = attach_ids(feed.select(*wanted).dropna(), listings, ["site_id"])
    return (
        matched.join(known, ["internal_id", "agent_email"], "left_anti")
        .withColumn("added_date", today)
        .select("internal_id", "agent_name", "agent_phone", "agent_email", "added_date")
    )


def price_snapshot(listings: DataFrame, today: Column) -> DataFrame:
    """Today's price of every listing that has one."""
    return listings.where(F.col("price").isNotNull()).select("internal_id", "price", today.alias("snapshot_date"))


def price_changes(snapshots: DataFrame, days: list[datetime.date] | None = None) -> DataFrame:
    """Prices that differ from the day before; a missing day before yields no change.

    `days` limits the output days; they and the days before are literal filters on both
    sides, so only their partitions are read. Without it every day is compared.
    """
    today, held = snapshots, snapshots
    if days is not None:
        today = snapshots.where(F.col("snapshot_date").isin(days))
        held = snapshots.where(F.col("snapshot_date").isin([d - datetime.timedelta(days=1) for d in days]))
    before = held.select(
        "internal_id", F.col("price").alias("old_price"), F.date_add("snapshot_date", 1).alias("snapshot_date")
    )
    return (
        today.join(before, ["internal_id", "snapshot_date"])
        .where(F.col("price") != F.col("old_price"))
        .select("internal_id", "old_price", F.col("price").alias("new_price"), F.col("snapshot_date").alias("price_date"))
    )


def refresh_prices(existing: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Held listings, the active ones with the feed's price where the feed has one."""
    latest = feed.where(F.col("price").isNotNull()).groupBy(*keys).agg(F.max("price").alias("_price"))
    return (
        existing.join(latest, keys, "left")
        .withColumn("price", F.when(F.col("archived_date").isNull(), F.coalesce("_price", "price")).otherwise(F.col("price")))
        .select(*existing.columns)
    )
