"""Stage 1: one source's feed to canonical listings, compared with what is held."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import address as addr
from ..functions import text
from ..operators.conform import conform, stamp, with_internal_id
from ..operators.diff import archive, gone_listings, new_listings, refresh_prices
from ..operators.select import first_per_key
from ..schemas import LISTING
from ..session import materialized
from ..sources.payload import flatten_json
from ..sources.tables import SOURCES

# Payload fields of the two JSON feeds.
LABELLED_FIELDS = [
    "ID inzerátu",
    "Kategorie",
    "Title",
    "Typ nabídky",
    "Celkem",
    "Podkategorie",
    "Plocha",
    "Pozemku",
    "Typ domu",
    "Lokalita",
    "image_links",
]
TITLED_FIELDS = [
    "id",
    "address",
    "type",
    "title",
    "Cena",
    "Cena_numeric",
    "Užitná plocha",
    "Užitná plocha_numeric",
    "Plocha pozemku",
    "Plocha pozemku_numeric",
    "image_links",
]


def _payload(fields: list[str], present: list[str] | None) -> T.StructType:
    kept = fields if present is None else [f for f in fields if f in present]
    return T.StructType([T.StructField(f, T.StringType()) for f in kept])


def standardize_flat(feed: DataFrame, today: Column, source: str = "sreality") -> DataFrame:
    """Source 1 delivers canonical columns already, but for id and price."""
    rows = feed.withColumns({"site_id": F.col("id").cast("string"), "price": F.col("price").try_cast("double")})
    return conform(stamp(rows, SOURCES[source], today), LISTING)


def standardize_captioned(feed: DataFrame, today: Column, source: str = "bzereality") -> DataFrame:
    """Source 2 hides rooms and areas in the photo caption and the place in one address text."""
    caption, estate = F.col("image_alt_text"), F.col("estate_type")
    kind, place = text.estate_category(estate), addr.split_address(F.col("address"))
    rows = feed.select(
        F.col("id").cast("string").alias("site_id"),
        kind.getField("category_value").alias("category_value"),
        kind.getField("category_name").alias("category_name"),
        caption.alias("name"),
        text.first_token(F.col("offer_type")).alias("deal_type"),
        F.col("price").try_cast("double").alias("price"),
        text.disposition(F.col("disposition"), caption).alias("rooms"),
        text.caption_area(caption).alias("area_build"),
        text.land_area(estate, caption).alias("area_land"),
        F.lower(estate).alias("house_type"),
        *[place.getField(c).alias(c) for c in ("district", "city", "city_part", "street")],
    )
    return conform(stamp(rows, SOURCES[source], today), LISTING)


def standardize_labelled(
    feed: DataFrame, today: Column, present: list[str] | None = None, source: str = "hyper"
) -> DataFrame:
    """Source 3 delivers one JSON column with Czech labels."""
    data = flatten_json(feed.select("data"), "data", _payload(LABELLED_FIELDS, present))

    def label(name: str) -> Column:
        return F.col(f"`{name}`") if name in data.columns else F.lit(None).cast("string")

    rows = data.select(
        label("ID inzerátu").alias("site_id"),
        label("Kategorie").alias("category_name"),
        label("Title").alias("name"),
        F.lower(label("Typ nabídky")).alias("deal_type"),
        text.price(label("Celkem")).alias("price"),
        F.lower(label("Podkategorie")).alias("rooms"),
        text.area(label("Plocha")).alias("area_build"),
        text.area(label("Pozemku")).alias("area_land"),
        label("Typ domu").alias("house_type"),
        label("Lokalita").alias("city"),
    )
    return conform(stamp(rows, SOURCES[source], today), LISTING)


def standardize_titled(
    feed: DataFrame, today: Column, present: list[str] | None = None, source: str = "idnes"
) -> DataFrame:
    """Source 4 delivers one JSON column; title and free-form address have to be parsed.

    `present` names the payload fields this feed has: numbers come from a `_numeric`
    field where the feed has it, else from the text. Without it every field may be there,
    and a number comes from the text wherever the `_numeric` field has none.
    """
    data = flatten_json(feed.select("data"), "data", _payload(TITLED_FIELDS, present))
    place = addr.parse_address(F.col("address"))
    rows = data.select(
        F.col("id").alias("site_id"),
        F.col("type").alias("category_name"),
        F.col("title").alias("name"),
        text.deal_type(F.col("title")).alias("deal_type"),
        text.rooms(F.col("title")).alias("rooms"),
        text.numeric_or_parsed(data.columns, "Cena", text.price, present is not None).alias("price"),
        text.numeric_or_parsed(data.columns, "Užitná plocha", text.area, present is not None).alias("area_build"),
        text.numeric_or_parsed(data.columns, "Plocha pozemku", text.area, present is not None).alias("area_land"),
        F.col("type").alias("house_type"),
        *[place.getField(c).alias(c) for c in ("district", "city", "city_part", "street", "house_number")],
    )
    return conform(stamp(rows, SOURCES[source], today), LISTING)


@dataclass
class Load:
    """What a load changes, and the listings after it."""

    added: DataFrame
    archived: DataFrame
    listings: DataFrame


def load_source(
    feed: DataFrame, held: DataFrame, source_id: int, today: Column, compare: str = "active", refresh_price: bool = True
) -> Load:
    """Compare a standardized feed with the held listings of its source.

    Listings of other sources, and of none, pass through. `refresh_price` lets the feed's
    price replace the held one, from which price changes arise. A listing that the feed
    names more than once is inserted once, as the smallest of its rows.
    """
    keys = ["site_id"]
    own = F.col("source_id").eqNullSafe(F.lit(source_id))
    mine, others = held.where(own), held.where(~own)
    new = new_listings(feed, mine, keys, compare)
    named = first_per_key(new.where("site_id IS NOT NULL"), keys, [c for c in new.columns if c not in keys])
    unique = materialized(named.unionByName(new.where("site_id IS NULL")), "new-listings")
    added = with_internal_id(unique, held).select(*held.columns)
    archived = gone_listings(feed, mine, keys, compare)
    kept = archive(mine, archived, ["internal_id"], today)
    if refresh_price:
        kept = refresh_prices(kept, feed, keys).select(*held.columns)
    return Load(added, archived, others.unionByName(kept).unionByName(added))
