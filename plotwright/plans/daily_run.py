"""A day over all sources: listings, sellers, prices, photo links and the run log, from the feeds and what is held."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.conform import conform
from ..operators.diff import new_sellers, price_changes, price_snapshot
from ..operators.photos import photo_links
from ..operators.runlog import run_log
from ..schemas import PHOTO_LINKS, PRICE_SNAPSHOT, SELLERS
from ..session import materialized
from .daily_load import load_source


@dataclass
class Feed:
    """One source's feed of the day: its listings as `standardize_*` gives them, and what else it
    carries by site_id: agent_* columns of sellers, `items` of photos."""

    source: str
    source_id: int
    listings: DataFrame
    sellers: DataFrame | None = None
    photos: DataFrame | None = None


@dataclass
class Held:
    """The tables as they were before. `prices` is the price history, best partitioned by `snapshot_date`."""

    listings: DataFrame
    sellers: DataFrame
    prices: DataFrame
    photos: DataFrame


@dataclass
class Day:
    """`listings` is the next version of its table; the others are the rows to append to theirs."""

    listings: DataFrame
    sellers: DataFrame
    prices: DataFrame
    changes: DataFrame
    photos: DataFrame
    log: DataFrame


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_day(
    feeds: list[Feed], held: Held, today: datetime.date, started: datetime.datetime, compare: str = "active", photos_per: str = "url"
) -> Day:
    """Load every feed against the listings of its own source, and draw the day's other tables from the result.

    Listings of sources without a feed, and of none, pass through. The listings after the load are written
    once, as every other table starts from them. Sellers and photo links belong to active listings of the
    feed's source. Price changes compare today's snapshot with yesterday's alone, so of the history only
    that day is read.
    """
    day = F.lit(today)
    own = {f.source_id: held.listings.where(F.col("source_id").eqNullSafe(F.lit(f.source_id))) for f in feeds}
    loads = {f.source_id: load_source(f.listings, own[f.source_id], f.source_id, day, compare) for f in feeds}
    others = held.listings.where(~F.coalesce(F.col("source_id").isin([f.source_id for f in feeds]), F.lit(False)))
    listings = materialized(_all([others, *[loads[f.source_id].listings for f in feeds]]), "day-listings")

    def active(source_id: int) -> DataFrame:
        return listings.where((F.col("source_id") == source_id) & F.col("archived_date").isNull())

    prices = materialized(conform(price_snapshot(listings.where("archived_date IS NULL"), day), PRICE_SNAPSHOT), "day-prices")
    before = held.prices.where(F.col("snapshot_date") == F.lit(today - datetime.timedelta(days=1)))
    changes = price_changes(conform(before, PRICE_SNAPSHOT).unionByName(prices), [today])
    sellers = [new_sellers(f.sellers, active(f.source_id), held.sellers, day) for f in feeds if f.sellers is not None]
    photos = [
        photo_links(f.photos, active(f.source_id), held.photos, photos_per).withColumns(
            {"added_date": F.lit(started), "source_id": F.lit(f.source_id)}
        )
        for f in feeds
        if f.photos is not None
    ]
    source_of = listings.select("internal_id", "source_id")
    changed = changes.join(source_of, "internal_id")
    log = [
        run_log(
            f.source, f"listings_{f.source}", F.lit(started), loads[f.source_id].added, loads[f.source_id].archived,
            changed.where(F.col("source_id") == f.source_id),
        )
        for f in feeds
    ]
    empty = listings.sparkSession.createDataFrame
    return Day(
        listings,
        _all([conform(s, SELLERS) for s in sellers]) if sellers else empty([], SELLERS),
        prices,
        changes,
        _all([conform(p, PHOTO_LINKS) for p in photos]) if photos else empty([], PHOTO_LINKS),
        _all(log),
    )
