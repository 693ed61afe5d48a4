"""The daily run over four sources: one query for each table it leaves."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..operators.conform import conform
from ..plans import daily_load, silver
from ..plans.daily_run import Feed, Held, run_day
from ..schemas import LISTING, PHOTO_LINKS, PRICE_SNAPSHOT, SELLERS
from ..sources.tables import SOURCES
from .registry import check, derive, duck

TODAY = datetime.date(2001, 8, 2)
STARTED = datetime.datetime(2001, 8, 2, 6, 30)

# Customers as listings of four sources; some archived, some of no source.
HELD = """
    SELECT c_custkey AS internal_id, CAST(c_custkey AS STRING) AS site_id, CASE WHEN c_custkey % 50 <> 0 THEN CAST(c_custkey % 4 + 1 AS INT) END AS source_id,
           c_nationkey < 22 AS avalaible, CASE WHEN c_nationkey >= 22 THEN DATE '2001-01-01' END AS archived_date, c_acctbal AS price
    FROM {customer} WHERE c_acctbal > 0"""
# Customers that ordered in the last half year, each in the feed of its source.
FEED = """
    SELECT CAST(o_custkey AS STRING) AS id, CAST(o_custkey % 4 + 1 AS INT) AS source_id, CAST(max(o_totalprice) AS DOUBLE) AS price,
           CASE WHEN o_custkey % 3 > 0 THEN 'agent ' || CAST(o_custkey % 7 AS STRING) END AS agent_name, '123' AS agent_phone,
           CAST(o_custkey % 7 AS STRING) || '@x' AS agent_email, 'u' || CAST(o_custkey AS STRING) AS u
    FROM {orders} WHERE o_orderdate >= TIMESTAMP '2001-02-01 00:00:00' GROUP BY o_custkey"""
YESTERDAY = "SELECT internal_id, price, DATE '2001-08-01' AS snapshot_date FROM ({held}) WHERE archived_date IS NULL AND internal_id % 2 = 0"
SOLD_BY = "SELECT internal_id, 'agent ' || CAST(internal_id % 7 AS STRING) AS agent_name, '123' AS agent_phone, CAST(internal_id % 7 AS STRING) || '@x' AS agent_email FROM ({held}) WHERE internal_id % 5 = 0"
PICTURED = "SELECT internal_id, site_id, 'u' || site_id || 'a' AS photo_url FROM ({held}) WHERE internal_id % 4 = 0"


def _day(spark, sf_dir):
    held = derive(spark, sf_dir, HELD)
    feed = derive(spark, sf_dir, FEED)

    def from_held(sql, schema):
        return conform(spark.sql(sql.replace("({held})", "{held}"), held=held), schema)

    before = Held(conform(held, LISTING), from_held(SOLD_BY, SELLERS), from_held(YESTERDAY, PRICE_SNAPSHOT), from_held(PICTURED, PHOTO_LINKS))
    feeds = []
    for source, source_id in SOURCES.items():
        rows = feed.where(F.col("source_id") == source_id).withColumn("site_id", F.col("id"))
        listings = daily_load.standardize_flat(rows.select("id", "price"), F.lit(TODAY), source)
        items = F.array(F.concat("u", F.lit("a")), F.concat("u", F.lit("b")))
        photos = rows.select("site_id", items.alias("items"))
        feeds.append(Feed(source, source_id, listings, rows.select("site_id", "agent_name", "agent_phone", "agent_email"), photos))
    return run_day(feeds, before, TODAY, STARTED)


# What the run should leave, ids aside: new listings are known by source and site.
_AFTER = f"""WITH h AS ({duck(HELD)}), f AS (SELECT id AS site_id, * EXCLUDE (id) FROM ({duck(FEED)})),
    b AS (SELECT h.site_id, h.source_id, h.internal_id, CASE WHEN archived_date IS NULL THEN coalesce(f.price, h.price) ELSE h.price END AS price,
                 archived_date IS NULL AND f.site_id IS NULL AND h.source_id IS NOT NULL AS gone, archived_date IS NULL AS was_active, h.avalaible AS a, h.archived_date AS d
          FROM h LEFT JOIN f ON f.site_id = h.site_id AND f.source_id = h.source_id),
    n AS (SELECT * FROM f WHERE (site_id, source_id) NOT IN (SELECT (site_id, source_id) FROM h WHERE archived_date IS NULL AND source_id IS NOT NULL)),
    l AS (SELECT site_id, source_id, internal_id, price, a AND NOT gone AS avalaible, CASE WHEN gone THEN '2001-08-02' ELSE strftime(d, '%Y-%m-%d') END AS archived FROM b
          UNION ALL SELECT site_id, source_id, NULL, price, true, NULL FROM n)"""
# A new listing keeps no id that SQL could know, so held sellers, prices and photos concern held listings only.
_HELD_ID = "coalesce(internal_id, 0)"


def _known(df):
    """The internal id of a held listing, 0 of a new one: held ids are below the number of customers."""
    return df.withColumn("internal_id", F.when(F.col("internal_id").between(1, 10**9), F.col("internal_id")).otherwise(F.lit(0)))


@check("day_listings", f"{_AFTER} SELECT site_id, source_id, avalaible, archived, price, {_HELD_ID} AS internal_id FROM l")
def day_listings(spark, sf_dir):
    rows = _day(spark, sf_dir).listings.withColumn("archived", F.date_format("archived_date", "yyyy-MM-dd"))
    return _known(rows).select("site_id", "source_id", "avalaible", "archived", "price", "internal_id")


@check(
    "day_sellers",
    f"""{_AFTER} SELECT {_HELD_ID} AS internal_id, agent_name, agent_phone, agent_email, '2001-08-02' AS added FROM l JOIN f USING (site_id, source_id)
        WHERE archived IS NULL AND agent_name IS NOT NULL AND coalesce(internal_id % 5, 1) <> 0""",
)
def day_sellers(spark, sf_dir):
    rows = _day(spark, sf_dir).sellers.withColumn("added", F.date_format("added_date", "yyyy-MM-dd")).drop("added_date")
    return _known(rows)


@check("day_prices", f"{_AFTER} SELECT {_HELD_ID} AS internal_id, price, '2001-08-02' AS day FROM l WHERE archived IS NULL AND price IS NOT NULL")
def day_prices(spark, sf_dir):
    rows = _day(spark, sf_dir).prices.withColumn("day", F.date_format("snapshot_date", "yyyy-MM-dd")).drop("snapshot_date")
    return _known(rows)


_CHANGED = f"""{_AFTER}, c AS (SELECT l.internal_id, l.source_id, h.price AS old_price, l.price AS new_price FROM l JOIN h ON h.internal_id = l.internal_id
    WHERE archived IS NULL AND h.archived_date IS NULL AND h.internal_id % 2 = 0 AND h.price <> l.price)"""


@check("day_changes", f"{_CHANGED} SELECT internal_id, old_price, new_price, '2001-08-02' AS day FROM c")
def day_changes(spark, sf_dir):
    rows = _day(spark, sf_dir).changes
    return rows.withColumn("day", F.date_format("price_date", "yyyy-MM-dd")).drop("price_date")


@check(
    "day_photos",
    f"""{_AFTER} SELECT {_HELD_ID} AS internal_id, site_id, u || x AS photo_url, '2001-08-02 06:30' AS added, source_id
        FROM l JOIN f USING (site_id, source_id), (SELECT unnest(['a', 'b']) AS x) WHERE archived IS NULL AND NOT (x = 'a' AND coalesce(internal_id % 4, 1) = 0)""",
)
def day_photos(spark, sf_dir):
    rows = _day(spark, sf_dir).photos
    return _known(rows.withColumn("added", F.date_format("added_date", "yyyy-MM-dd HH:mm")).drop("added_date"))


@check(
    "day_log",
    f"""{_CHANGED}, s AS (SELECT unnest([1, 2, 3, 4]) AS source_id, unnest(['sreality', 'bzereality', 'hyper', 'idnes']) AS parser_name)
        SELECT parser_name, 'listings_' || parser_name AS table_name, (SELECT count(*) FROM n WHERE n.source_id = s.source_id) AS new_records,
               (SELECT count(*) FROM b WHERE gone AND b.source_id = s.source_id) AS archived_records, (SELECT count(*) FROM c WHERE c.source_id = s.source_id) AS price_changes,
               '2001-08-02 06:30' AS processed, 'success' AS status FROM s""",
)
def day_log(spark, sf_dir):
    rows = _day(spark, sf_dir).log.withColumn("processed", F.date_format("processed_at", "yyyy-MM-dd HH:mm"))
    return rows.select("parser_name", "table_name", "new_records", "archived_records", "price_changes", "processed", "status")


@check(
    "day_silver",
    f"""{_AFTER} SELECT source_id, count(*) FILTER (WHERE internal_id IS NULL) AS rows_new, count(*) AS rows_all,
               count(*) FILTER (WHERE archived = '2001-08-02') AS archived_today FROM l GROUP BY source_id""",
)
def day_silver(spark, sf_dir):
    """The silver layer after it held yesterday's listings and took the day's."""
    yesterday = silver.to_silver(conform(derive(spark, sf_dir, HELD), LISTING))
    rows, _ = silver.sync_layer(silver.to_silver(_day(spark, sf_dir).listings), yesterday, "listings")
    return rows.groupBy("source_id").agg(
        F.count_if(F.col("added_date") == F.lit(TODAY)).alias("rows_new"),
        F.count("*").alias("rows_all"),
        F.count_if(F.col("archived_date") == F.lit(TODAY)).alias("archived_today"),
    )
