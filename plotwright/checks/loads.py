"""The four feeds to canonical listings, a daily load, and the silver layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import daily_load, silver
from ..schemas import LISTING
from ..operators.conform import conform
from .registry import check, derive, duck

TODAY = "2001-08-02"


def _today():
    return F.to_date(F.lit(TODAY))


FLAT = """
    SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN 'neuvedeno' ELSE CAST(o_custkey AS STRING) END AS price,
           o_orderpriority AS name, o_orderstatus AS deal_type, o_custkey AS district_id FROM {orders}"""


@check(
    "standardize_flat",
    f"""SELECT CAST(id AS VARCHAR) AS site_id, TRY_CAST(price AS DOUBLE) AS price, name, deal_type, district_id, 1 AS source_id,
               '{TODAY}' AS added, true AS avalaible, CAST(NULL AS VARCHAR) AS city FROM ({duck(FLAT)})""",
)
def standardize_flat(spark, sf_dir):
    out = daily_load.standardize_flat(derive(spark, sf_dir, FLAT), _today())
    added = F.date_format("added_date", "yyyy-MM-dd").alias("added")
    return out.select("site_id", "price", "name", "deal_type", "district_id", "source_id", added, "avalaible", "city")


CAPTIONED = """
    SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN 'PRODEJ byt' ELSE 'Pronajem  dum' END AS offer_type,
           CASE p_type WHEN 'ECONOMY' THEN 'DUM' WHEN 'SMALL' THEN 'Pozemek' WHEN 'PROMO' THEN 'CHATA' ELSE 'BYT' END AS estate_type,
           'Byt ' || CAST(p_size % 7 AS STRING) || '+kk ' || CAST(p_size AS STRING) || ',5 m² s pozemek ' || CAST(p_size * 10 AS STRING) || ' m2' AS image_alt_text,
           CASE WHEN p_size > 40 THEN 'DISP_2_1' END AS disposition, p_retailprice AS price,
           CASE WHEN p_size < 5 THEN NULL WHEN p_size < 25 THEN p_name || ', Praha - ' || p_brand || ', ' || p_type ELSE p_name || ', ' || p_brand || ',x' END AS address
    FROM {part}"""


@check(
    "standardize_captioned",
    f"""SELECT CAST(id AS VARCHAR) AS site_id, lower(regexp_extract(offer_type, '(\\S+)', 1)) AS deal_type, price,
               CASE lower(estate_type) WHEN 'pozemek' THEN 'Pozemky' WHEN 'byt' THEN 'Byty' WHEN 'dum' THEN 'Domy' ELSE 'Neznámá' END AS category_name,
               coalesce(lower(replace(replace(disposition, 'DISP_', ''), '_', '+')), nullif(regexp_extract(lower(image_alt_text), '([1-6][+](?:kk|[1-6]))', 1), '')) AS rooms,
               CAST(replace(regexp_extract(image_alt_text, '([0-9]+(?:[.,][0-9]+)?)\\s*(?:m2|m²|m\\^2)', 1), ',', '.') AS DOUBLE) AS area_build,
               CASE lower(estate_type) WHEN 'dum' THEN CAST(regexp_extract(lower(image_alt_text), 'pozemek\\s+([0-9]+(?:[.,][0-9]+)?)', 1) AS DOUBLE)
                    WHEN 'pozemek' THEN CAST(replace(regexp_extract(lower(image_alt_text), '([0-9]+(?:[.,][0-9]+)?)\\s*(?:m2|m²|m\\^2)', 1), ',', '.') AS DOUBLE) END AS area_land,
               trim(split_part(a, ',', 1)) AS street, CASE WHEN contains(a, 'Praha') THEN 'Praha' ELSE trim(split_part(a, ',', 2)) END AS city, trim(split_part(a, ',', 3)) AS district,
               CASE WHEN contains(split_part(a, ',', 2), '-') THEN trim(split_part(split_part(a, ',', 2), '-', 2)) END AS city_part, lower(estate_type) AS house_type, 2 AS source_id
        FROM (SELECT *, coalesce(address, ',,') AS a FROM ({duck(CAPTIONED)}))""",
)
def standardize_captioned(spark, sf_dir):
    out = daily_load.standardize_captioned(derive(spark, sf_dir, CAPTIONED), _today())
    return out.select(
        "site_id", "deal_type", "price", "category_name", "rooms", "area_build", "area_land",
        "street", "city", "district", "city_part", "house_type", "source_id",
    )


LABELLED = """
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal, '{{"ID inzerátu": "' || CAST(c_custkey AS STRING) || '", "Kategorie": "' || c_mktsegment || '", "Title": "Byt ' || c_name ||
           '", "Typ nabídky": "PRODEJ", "Celkem": "' || c_name || ' Kč", "Podkategorie": "2+KK", "Plocha": "' || CAST(c_nationkey AS STRING) || ',5 m²", "Lokalita": "' ||
           c_mktsegment || '"}}' AS data FROM {customer}"""


def _labelled_sql():
    return duck(LABELLED).replace("{{", "{").replace("}}", "}")


@check(
    "standardize_labelled",
    """SELECT CAST(c_custkey AS VARCHAR) AS site_id, c_mktsegment AS category_name, 'Byt ' || c_name AS name, 'prodej' AS deal_type,
              CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS DOUBLE) AS price, '2+kk' AS rooms, c_nationkey + 0.5::DOUBLE AS area_build,
              CAST(NULL AS DOUBLE) AS area_land, c_mktsegment AS city, 3 AS source_id FROM customer""",
)
def standardize_labelled(spark, sf_dir):
    out = daily_load.standardize_labelled(derive(spark, sf_dir, LABELLED), _today())
    return out.select(
        "site_id", "category_name", "name", "deal_type", "price", "rooms", "area_build", "area_land", "city", "source_id"
    )


TITLED = """
    SELECT p_partkey, p_name, p_size, p_brand, p_type, '{{"id": ' || CAST(p_partkey AS STRING) || ', "type": "' || p_type || '", "title": "Pronájem bytu ' || CAST(p_size AS STRING) || '+1", "address": "' ||
           p_name || ' ' || CAST(p_size AS STRING) || 'b, okres ' || p_brand || '-x", "Cena": "' || CAST(p_size AS STRING) || ' 000 Kč", "Užitná plocha_numeric": ' ||
           CAST(p_size AS STRING) || '.5, "Užitná plocha": "9 m2"}}' AS data FROM {part}"""


@check(
    "standardize_titled",
    """SELECT CAST(p_partkey AS VARCHAR) AS site_id, p_type AS category_name, 'pronájem' AS deal_type, p_size || '+1' AS rooms,
              p_size * 1000.0::DOUBLE AS price, p_size + 0.5::DOUBLE AS area_build, p_name AS street, p_size || 'b' AS house_number,
              p_name || ' ' || p_size || 'b' AS city, p_brand AS district, 4 AS source_id FROM part""",
)
def standardize_titled(spark, sf_dir):
    present = ["id", "address", "type", "title", "Cena", "Užitná plocha", "Užitná plocha_numeric"]
    out = daily_load.standardize_titled(derive(spark, sf_dir, TITLED), _today(), present)
    return out.select(
        "site_id", "category_name", "deal_type", "rooms", "price", "area_build", "street", "house_number", "city", "district", "source_id"
    )


@check(
    "standardize_text_only",
    """SELECT CAST(p_partkey AS VARCHAR) AS site_id, p_size * 1000.0::DOUBLE AS price, CASE WHEN p_size % 2 = 0 THEN p_size + 0.5::DOUBLE ELSE 92.0::DOUBLE END AS area_build FROM part""",
)
def standardize_text_only(spark, sf_dir):
    """Without a list of the feed's fields, numbers come from the text wherever no ready number is given."""
    data = TITLED.replace(
        "CAST(p_size AS STRING) || '.5, ", "CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS STRING) || '.5' ELSE 'null' END || ', "
    )
    out = daily_load.standardize_titled(derive(spark, sf_dir, data), _today())
    return out.select("site_id", "price", "area_build")


# Held listings of two sources, and a feed of the first: customers who ordered in 2001.
HELD = """
    SELECT c_custkey AS internal_id, CAST(c_custkey AS STRING) AS site_id, CASE WHEN c_acctbal > 8000 THEN 2 ELSE 1 END AS source_id, c_nationkey < 22 AS avalaible,
           CASE WHEN c_nationkey >= 22 THEN DATE '2001-01-01' END AS archived_date, c_acctbal AS price, c_mktsegment AS category_name
    FROM {customer} WHERE c_acctbal > 0"""
DAY_FEED = """
    SELECT o_custkey AS id, max(o_totalprice) AS price, min(o_orderpriority) AS name
    FROM {orders} WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY o_custkey"""


def load_today(spark, sf_dir):
    held = conform(derive(spark, sf_dir, HELD), LISTING)
    feed = daily_load.standardize_flat(derive(spark, sf_dir, DAY_FEED), _today())
    return daily_load.load_source(feed, held, 1, _today())


_LOADED = f"""WITH h AS ({duck(HELD)}), f AS (SELECT CAST(id AS VARCHAR) AS site_id, price, name FROM ({duck(DAY_FEED)})),
    n AS (SELECT * FROM f WHERE site_id NOT IN (SELECT site_id FROM h WHERE source_id = 1 AND archived_date IS NULL)),
    l AS (SELECT site_id, source_id, avalaible AND NOT gone AS avalaible, CASE WHEN gone THEN '{TODAY}' ELSE strftime(archived_date, '%Y-%m-%d') END AS archived,
                 CASE WHEN source_id = 1 AND archived_date IS NULL THEN coalesce(p, price) ELSE price END AS price, 'held' AS origin
          FROM (SELECT h.*, f.price AS p, source_id = 1 AND archived_date IS NULL AND f.site_id IS NULL AS gone FROM h LEFT JOIN f USING (site_id))
          UNION ALL SELECT site_id, 1, true, NULL, price, 'new' FROM n)"""


@check("daily_load", f"{_LOADED} SELECT * EXCLUDE (origin) FROM l")
def load_all(spark, sf_dir):
    archived = F.date_format("archived_date", "yyyy-MM-dd").alias("archived")
    return load_today(spark, sf_dir).listings.select("site_id", "source_id", "avalaible", archived, "price")


@check(
    "load_summary",
    f"""{_LOADED} SELECT source_id, count(*) AS listings, count(*) FILTER (WHERE avalaible) AS active,
               count(*) FILTER (WHERE archived = '{TODAY}') AS archived_today, count(*) FILTER (WHERE origin = 'new') AS added_today FROM l GROUP BY source_id""",
)
def load_summary(spark, sf_dir):
    """The flagship: what a day's load leaves behind, per source."""
    listings = load_today(spark, sf_dir).listings
    return listings.groupBy("source_id").agg(
        F.count("*").alias("listings"),
        F.count_if("avalaible").alias("active"),
        F.count_if(F.col("archived_date") == _today()).alias("archived_today"),
        F.count_if(F.col("added_date") == _today()).alias("added_today"),
    )


# Every fifth held listing has no source, and the feed names each listing three times at different prices.
HELD_LOOSE = f"SELECT * EXCEPT (source_id), CASE WHEN internal_id % 5 = 0 THEN NULL ELSE source_id END AS source_id FROM ({HELD})"
FEED_LOOSE = f"SELECT id, price + extra AS price, name FROM ({DAY_FEED}), (SELECT explode(array(0, 1, 2)) AS extra)"


@check(
    "daily_load_loose",
    f"""WITH h AS (SELECT * REPLACE (CASE WHEN internal_id % 5 = 0 THEN NULL ELSE source_id END AS source_id) FROM ({duck(HELD)})),
            f AS (SELECT CAST(id AS VARCHAR) AS site_id FROM ({duck(DAY_FEED)})),
            n AS (SELECT site_id, 1 AS source_id FROM f WHERE site_id NOT IN (SELECT site_id FROM h WHERE source_id = 1 AND archived_date IS NULL))
        SELECT source_id, count(*) AS n_listings, count(*) AS n_ids FROM (SELECT site_id, source_id FROM h UNION ALL FROM n) GROUP BY 1""",
)
def daily_load_loose(spark, sf_dir):
    """No held listing is lost for want of a source, none is inserted twice, and no id stands for two."""
    held = conform(derive(spark, sf_dir, HELD_LOOSE), LISTING)
    feed = daily_load.standardize_flat(derive(spark, sf_dir, FEED_LOOSE), _today())
    listings = daily_load.load_source(feed, held, 1, _today()).listings
    return listings.groupBy("source_id").agg(F.count("*").alias("n_listings"), F.countDistinct("internal_id").alias("n_ids"))


BRONZE = """
    SELECT o_orderkey AS internal_id, CAST(o_orderkey AS STRING) AS site_id, o_orderdate AS added_date, o_orderstatus <> 'F' AS avalaible,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS archived_date, 1 AS source_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Byty k prodeji' WHEN '2-HIGH' THEN 'Chaty a chalupy' WHEN '3-MEDIUM' THEN 'LAND' WHEN '5-LOW' THEN NULL ELSE 'Kancelář' END AS category_name,
           o_totalprice AS price, o_orderpriority AS house_type FROM {orders}"""


@check(
    "silver_transfer",
    f"""SELECT internal_id, strftime(added_date, '%Y-%m-%d') AS added, strftime(archived_date, '%Y-%m-%d') AS archived, avalaible,
               CASE category_name WHEN 'Byty k prodeji' THEN 1 WHEN 'Chaty a chalupy' THEN 2 WHEN 'LAND' THEN 3 ELSE 5 END AS category_value,
               CASE category_name WHEN 'Byty k prodeji' THEN '1' WHEN 'Chaty a chalupy' THEN '2' WHEN 'LAND' THEN '3' ELSE '5' END AS house_type, price FROM ({duck(BRONZE)})""",
)
def silver_transfer(spark, sf_dir):
    out = silver.to_silver(derive(spark, sf_dir, BRONZE))
    return out.select(
        "internal_id",
        F.date_format("added_date", "yyyy-MM-dd").alias("added"),
        F.date_format("archived_date", "yyyy-MM-dd").alias("archived"),
        "avalaible",
        "category_value",
        "house_type",
        "price",
    )
