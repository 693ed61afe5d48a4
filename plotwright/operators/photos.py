"""Photo links of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import URL_SOURCES, item_urls, storage_key, url_list


def photo_links(feed: DataFrame, active: DataFrame, held: DataFrame, per: str = "url") -> DataFrame:
    """Links of active listings not yet held.

    `feed` has site_id and an `items` array. `per='url'` skips held (listing, URL)
    pairs; `per='listing'` also skips listings that hold any link.
    """
    exploded = feed.select("site_id", F.explode(item_urls(F.col("items"))).alias("photo_url")).distinct()
    listings = active.select("internal_id", "site_id")
    if per == "listing":
        listings = listings.join(held.select("internal_id").distinct(), "internal_id", "left_anti")
    found = exploded.join(listings, "site_id")
    known = held.select("internal_id", "photo_url").distinct()
    fresh = found.join(known, ["internal_id", "photo_url"], "left_anti")
    return fresh.select("internal_id", "site_id", "photo_url").distinct()


def positioned(df: DataFrame, key: str, items: Column) -> DataFrame:
    """One row per list item with its position."""
    return df.select(key, F.posexplode(items).alias("pos", "url"))


def parsed_sources(links: DataFrame, key: str, sources: list[str] = URL_SOURCES) -> DataFrame:
    """The source columns of `links` read from text, JSON or bare, into arrays of URLs."""
    return links.select(key, *[F.coalesce(item_urls(url_list(F.col(s))), F.array()).alias(s) for s in sources])


def source_urls(links: DataFrame, key: str, sources: list[str] = URL_SOURCES) -> DataFrame:
    """(key, source, pos, url): every URL of every source array, with its position there."""
    lists = F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("urls")) for s in sources])
    per_source = links.select(key, F.explode(lists).alias("l")).select(key, "l.*")
    return per_source.select(key, "source", F.posexplode("urls").alias("pos", "url"))


def fresh_urls(links: DataFrame, key: str, seen: DataFrame, sources: list[str] = URL_SOURCES) -> DataFrame:
    """(key, source, pos, url): each listing's distinct unseen URLs, of the first source that has any.

    `links` holds one array column per source, `seen` one column `url`.
    """
    lists = [F.struct(F.lit(i).alias("rank"), F.lit(s).alias("source"), F.col(s).alias("urls")) for i, s in enumerate(sources)]
    per_source = links.select(key, F.explode(F.array(*lists)).alias("l")).select(key, "l.*")
    items = per_source.select(key, "rank", "source", F.posexplode("urls").alias("pos", "url"))
    items = items.where(F.col("url").isNotNull() & (F.col("url") != ""))
    once = items.groupBy(key, "rank", "source", "url").agg(F.min("pos").alias("pos"))
    unseen = once.join(seen.select("url").distinct(), "url", "left_anti")
    winner = unseen.groupBy(key).agg(F.min("rank").alias("rank"))
    return unseen.join(winner, [key, "rank"]).select(key, "source", "pos", "url")


def with_storage_key(urls: DataFrame, key: str, root: str) -> DataFrame:
    return urls.withColumn("storage_key", storage_key(F.lit(root), F.col(key), F.col("source"), F.col("pos")))
