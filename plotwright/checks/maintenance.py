"""Sources, sinks and keyed maintenance."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from ..operators import diff, maintain, runlog
from ..sources import buckets, merge, payload, sinks, tables
from ..session import work_path
from .registry import check, derive, duck, table


def _events_by_day(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


DAY = "strftime(ts, '%Y-%m-%d')"


@check(
    "latest_snapshot",
    f"SELECT event_id, user_id, event_type, value FROM events WHERE {DAY} = (SELECT max({DAY}) FROM events)",
)
def latest_snapshot(spark, sf_dir):
    return tables.latest_snapshot(_events_by_day(spark, sf_dir), "day").select("event_id", "user_id", "event_type", "value")


@check(
    "latest_partition",
    f"SELECT event_id, user_id, event_type, value FROM events WHERE {DAY} = (SELECT max({DAY}) FROM events)",
)
def latest_partition(spark, sf_dir):
    """The same from a table partitioned by day, of which one folder is read."""
    path = work_path(spark, "events")
    sinks.append(_events_by_day(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "day"), path, ["day"])
    return tables.read_latest_snapshot(spark, path, "day").drop("day")


@check(
    "dropped_days",
    f"""SELECT event_id, {DAY} AS day FROM events WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 2""",
)
def dropped_days(spark, sf_dir):
    """What is left of a partitioned table once the days before the last two are deleted."""
    path = work_path(spark, "events")
    sinks.append(_events_by_day(spark, sf_dir).select("event_id", "day"), path, ["day"])
    newest = datetime.date.fromisoformat(tables.newest_value(spark, path, "day"))
    sinks.drop_days(spark, path, str(newest - datetime.timedelta(days=1)), "day")
    return spark.read.schema("event_id bigint, day string").parquet(path)


@check(
    "pruned_scan",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000",
)
def pruned_scan(spark, sf_dir):
    where = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)
    return tables.scan(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], where)


@check("flatten_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def flatten_json(spark, sf_dir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    return payload.flatten_json(table(spark, sf_dir, "events").select("event_id", "props"), "props", schema)


@check("variant_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def variant_field(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return payload.variant_field(events, "props", "$.k", "bigint", "k").select("event_id", "k")


@check(
    "append_rows",
    """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""",
)
def append_rows(spark, sf_dir):
    path = work_path(spark, "append")
    for prefix, source in (("c", "customer"), ("s", "supplier")):
        rows = table(spark, sf_dir, source).select(
            F.col(f"{prefix}_name").alias("name"),
            F.col(f"{prefix}_nationkey").alias("nation"),
            F.col(f"{prefix}_acctbal").alias("balance"),
        )
        sinks.append(rows, path)
    return spark.read.parquet(path)


@check(
    "replace_partition",
    f"""SELECT event_id, {DAY} AS day,
               CASE WHEN {DAY} = (SELECT max({DAY}) FROM events) THEN -value ELSE value END AS value FROM events""",
)
def replace_partition(spark, sf_dir):
    path = work_path(spark, "days")
    rows = _events_by_day(spark, sf_dir).select("event_id", "value", "day")
    sinks.replace_partition(rows, path, "day")
    redone = tables.latest_snapshot(rows, "day").withColumn("value", -F.col("value"))
    sinks.replace_partition(redone, path, "day")
    return spark.read.schema("event_id bigint, value double, day string").parquet(path)


@check(
    "upsert_columns",
    """SELECT c_custkey, c_name, coalesce(u.p, c_acctbal) AS c_acctbal FROM customer
       LEFT JOIN (SELECT o_custkey, min(o_totalprice) AS p FROM orders GROUP BY o_custkey) u ON o_custkey = c_custkey""",
)
def upsert_columns(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    updates = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal")
    )
    return maintain.upsert_columns(target, updates, ["c_custkey"], ["c_acctbal"])


@check(
    "versioned_upsert",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
                              THEN 'open' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def versioned_upsert(spark, sf_dir):
    path = work_path(spark, "versions")
    sinks.publish(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path, 1)
    updates = (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'P'")
        .select(F.col("o_custkey").alias("c_custkey"), F.lit("open").alias("c_mktsegment"))
    )
    current = sinks.read_latest(spark, path)
    sinks.publish(maintain.upsert_columns(current, updates, ["c_custkey"], ["c_mktsegment"]), path, 2)
    return sinks.read_latest(spark, path)


@check(
    "merged_updates",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 'third' WHEN c_custkey % 7 = 0 THEN 'late' WHEN c_custkey % 2 = 0 THEN 'second' ELSE c_mktsegment END AS c_mktsegment
       FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 <> 0""",
)
def merged_updates(spark, sf_dir):
    """Two updates and a deletion beside the base, one update more, a compaction, and one update on top of it."""
    path = work_path(spark, "merged")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")

    def changed(every, name):
        return customers.where(f"c_custkey % {every} = 0").withColumn("c_mktsegment", F.lit(name))

    merge.create_merged(customers, path, ["c_custkey"], 8)
    merge.upsert_rows(changed(2, "second"), path)
    merge.delete_rows(customers.where("c_custkey % 5 = 0").select("c_custkey"), path)
    merge.upsert_rows(changed(7, "late").where("c_custkey % 5 <> 0"), path)
    merge.compact(spark, path)
    merge.upsert_rows(changed(3, "third"), path)
    return merge.read_merged(spark, path)


@check(
    "committed_upsert",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'open' ELSE c_mktsegment END AS c_mktsegment,
              (SELECT count(*) FROM customer) AS n_before FROM customer""",
)
def committed_upsert(spark, sf_dir):
    """A version whose job died after half of its rows is passed over by readers, and published again."""
    path = work_path(spark, "versions")
    sinks.publish(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path, 1)
    updates = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.lit("open").alias("c_mktsegment"))
    changed = maintain.upsert_columns(sinks.read_latest(spark, path), updates, ["c_custkey"], ["c_mktsegment"])
    sinks.stage({sinks.TABLE: changed.where("c_custkey % 2 = 0")}, path, 2)
    before = sinks.read_latest(spark, path).count()
    sinks.publish(changed, path, 2)
    return sinks.read_latest(spark, path).withColumn("n_before", F.lit(before).cast("long"))


@check(
    "delete_keys",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def delete_keys(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    gone = gone.select(F.col("o_custkey").alias("c_custkey"))
    return maintain.delete_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), gone, ["c_custkey"])


@check(
    "empty_clone",
    """SELECT column_name, lower(CASE data_type WHEN 'VARCHAR' THEN 'string' ELSE data_type END) AS data_type, 0 AS n_rows
       FROM (SELECT unnest(['s_suppkey', 's_name', 's_acctbal']) AS column_name, unnest([typeof(a), typeof(b), typeof(c)]) AS data_type
             FROM (SELECT any_value(s_suppkey) AS a, any_value(s_name) AS b, any_value(s_acctbal) AS c FROM supplier))""",
)
def empty_clone(spark, sf_dir):
    """The columns and types of a clone, and its number of rows."""
    clone = tables.empty_like(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"))
    columns = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in clone.dtypes])
    return clone.agg(F.count("*").alias("n_rows")).select(F.inline(columns), "n_rows")


@check(
    "retention",
    f"""SELECT event_id, {DAY} AS day FROM events
        WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 2""",
)
def retention(spark, sf_dir):
    events = _events_by_day(spark, sf_dir).select("event_id", "day")
    today = events.agg(F.max("day").cast("date")).scalar()
    return maintain.retain(events, today, 2, "day")


@check("copy_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def copy_table(spark, sf_dir):
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return sinks.copy_table(source, work_path(spark, "copy"))


@check("clear_column", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer")
def clear_column(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return maintain.clear_column(customer, "c_mktsegment")


@check(
    "filled_count",
    """SELECT count(*) AS total, count(nullif(o_orderstatus, 'P')) AS filled FROM orders""",
)
def filled_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return maintain.filled_count(orders, "status")


@check(
    "truncate",
    "SELECT 'before' AS state, count(*) AS n FROM orders UNION ALL SELECT 'after', 0",
)
def truncate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    states = [(s, df) for s, df in (("before", orders), ("after", maintain.truncate(orders)))]
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(s).alias("state"), "n") for s, df in states]
    return counted[0].unionAll(counted[1])


@check(
    "exists",
    """SELECT 'column' AS kind, true AS found UNION ALL SELECT 'missing_column', false
       UNION ALL SELECT 'yesterday', count(*) > 0 FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) - 1""",
)
def exists(spark, sf_dir):
    events = _events_by_day(spark, sf_dir)
    yesterday = F.date_sub(F.to_date(events.agg(F.max("day")).scalar()), 1).cast("string")
    found = {
        "column": tables.column_exists(events, "props"),
        "missing_column": tables.column_exists(events, "no_such_column"),
        "yesterday": tables.snapshot_exists(events, yesterday, "day"),
    }
    return spark.createDataFrame(list(found.items()), "kind string, found boolean")


# Listings held: customers with an urgent order before 2001, archived where the last one is old.
HELD = """
    SELECT CAST(o_custkey AS STRING) AS site_id, o_custkey AS internal_id, 1 AS source_id, true AS avalaible,
           CASE WHEN max(o_orderdate) < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(max(o_orderdate) AS DATE) END AS archived_date
    FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
    GROUP BY o_custkey"""
# The feed: customers who ordered in 2001.
FEED = """
    SELECT CAST(o_custkey AS STRING) AS site_id, max(o_totalprice) AS price
    FROM {orders} WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY o_custkey"""
_CTE = f"WITH held AS ({duck(HELD)}), feed AS ({duck(FEED)})"


def _new(compare):
    def query(spark, sf_dir):
        return diff.new_listings(derive(spark, sf_dir, FEED), derive(spark, sf_dir, HELD), ["site_id"], compare)

    return query


def _gone(compare):
    def query(spark, sf_dir):
        held = diff.gone_listings(derive(spark, sf_dir, FEED), derive(spark, sf_dir, HELD), ["site_id"], compare)
        return held.select("site_id", F.date_format("archived_date", "yyyy-MM-dd").alias("archived"))

    return query


_ACTIVE = "archived_date IS NULL"
for _mode, _where in (("active", _ACTIVE), ("all", "true")):
    check(
        f"new_listings_{_mode}",
        f"{_CTE} SELECT site_id, price FROM feed WHERE site_id NOT IN (SELECT site_id FROM held WHERE {_where})",
    )(_new(_mode))
    check(
        f"gone_listings_{_mode}",
        f"""{_CTE} SELECT site_id, strftime(archived_date, '%Y-%m-%d') AS archived FROM held
            WHERE {_where} AND site_id NOT IN (SELECT site_id FROM feed)""",
    )(_gone(_mode))


@check(
    "archive_listings",
    f"""{_CTE} SELECT site_id, avalaible AND NOT gone AS avalaible,
               CASE WHEN gone THEN '2001-08-02' ELSE strftime(archived_date, '%Y-%m-%d') END AS archived
        FROM (SELECT *, archived_date IS NULL AND site_id NOT IN (SELECT site_id FROM feed) AS gone FROM held)""",
)
def archive_listings(spark, sf_dir):
    held = derive(spark, sf_dir, HELD)
    gone = diff.gone_listings(derive(spark, sf_dir, FEED), held, ["site_id"])
    out = diff.archive(held, gone, ["site_id"], F.to_date(F.lit("2001-08-02")))
    return out.select("site_id", "avalaible", F.date_format("archived_date", "yyyy-MM-dd").alias("archived"))


@check(
    "refresh_prices",
    f"""{_CTE} SELECT held.site_id, CASE WHEN archived_date IS NULL THEN coalesce(feed.price, 1.0) ELSE 1.0 END AS price
        FROM held LEFT JOIN feed USING (site_id)""",
)
def refresh_prices(spark, sf_dir):
    held = derive(spark, sf_dir, HELD).withColumn("price", F.lit(1.0))
    return diff.refresh_prices(held, derive(spark, sf_dir, FEED), ["site_id"]).select("site_id", "price")


@check(
    "attach_ids",
    f"{_CTE} SELECT feed.site_id, internal_id, price FROM feed JOIN held USING (site_id)",
)
def attach_ids(spark, sf_dir):
    return diff.attach_ids(derive(spark, sf_dir, FEED), derive(spark, sf_dir, HELD), ["site_id"])


SELLER_FEED = """
    SELECT CAST(o_custkey AS STRING) AS site_id, nullif(o_orderstatus, 'P') AS agent_name, o_orderstatus AS agent_phone,
           lower(o_orderpriority) AS agent_email FROM {orders} WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'"""
SELLERS_HELD = """
    SELECT o_custkey AS internal_id, lower(o_orderpriority) AS agent_email
    FROM {orders} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""
SELLER_LISTINGS = "SELECT CAST(c_custkey AS STRING) AS site_id, c_custkey AS internal_id FROM {customer} WHERE c_acctbal > 0"


@check(
    "new_sellers",
    f"""WITH f AS ({duck(SELLER_FEED)}), h AS ({duck(SELLERS_HELD)}), l AS ({duck(SELLER_LISTINGS)})
        SELECT internal_id, agent_name, agent_phone, agent_email FROM f JOIN l USING (site_id)
        WHERE agent_name IS NOT NULL AND (internal_id, agent_email) NOT IN (SELECT (internal_id, agent_email) FROM h)""",
)
def new_sellers(spark, sf_dir):
    feed, held, listings = (derive(spark, sf_dir, q) for q in (SELLER_FEED, SELLERS_HELD, SELLER_LISTINGS))
    return diff.new_sellers(feed, listings, held, F.to_date(F.lit("2001-08-02"))).drop("added_date")


@check(
    "price_changes",
    """WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) AS price FROM events GROUP BY 1, 2)
       SELECT a.user_id AS internal_id, b.price AS old_price, a.price AS new_price, strftime(a.d, '%Y-%m-%d') AS price_date
       FROM p a JOIN p b ON a.user_id = b.user_id AND b.d = a.d - 1 WHERE a.price <> b.price""",
)
def price_changes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    prices = events.groupBy(F.col("user_id").alias("internal_id"), F.to_date("ts").alias("snapshot_date")).agg(
        F.max("value").alias("price")
    )
    return diff.price_changes(prices).withColumn("price_date", F.date_format("price_date", "yyyy-MM-dd"))


@check(
    "price_changes_today",
    """WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) AS price FROM events GROUP BY 1, 2)
       SELECT a.user_id AS internal_id, b.price AS old_price, a.price AS new_price, strftime(a.d, '%Y-%m-%d') AS price_date
       FROM p a JOIN p b ON a.user_id = b.user_id AND b.d = a.d - 1 WHERE a.price <> b.price AND a.d = (SELECT max(d) FROM p)""",
)
def price_changes_today(spark, sf_dir):
    """The newest day of a history partitioned by day: two of its folders are read."""
    path = work_path(spark, "prices")
    prices = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("internal_id"), F.to_date("ts").alias("snapshot_date"))
    sinks.append(prices.agg(F.max("value").alias("price")), path, ["snapshot_date"])
    today = datetime.date.fromisoformat(tables.newest_value(spark, path, "snapshot_date"))
    history = spark.read.schema("internal_id bigint, price double, snapshot_date date").parquet(path)
    return diff.price_changes(history, [today]).withColumn("price_date", F.date_format("price_date", "yyyy-MM-dd"))


@check(
    "price_snapshot",
    "SELECT o_orderkey AS internal_id, o_totalprice AS price, '2001-08-02' AS snapshot_date FROM orders WHERE o_orderstatus <> 'P'",
)
def price_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("internal_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    return diff.price_snapshot(orders, F.lit("2001-08-02"))


LAYER_SOURCE = """
    SELECT o_orderkey AS internal_id, o_orderstatus <> 'F' AS avalaible,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS archived_date, o_totalprice AS price
    FROM {orders}"""
LAYER_TARGET = """
    SELECT o_orderkey AS internal_id, o_orderstatus = 'O' AS avalaible,
           CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN CAST(o_orderdate AS DATE) END AS archived_date,
           o_totalprice AS price
    FROM {orders} WHERE o_orderpriority <> '1-URGENT'"""
_LAYERS = f"WITH s AS ({duck(LAYER_SOURCE)}), t AS ({duck(LAYER_TARGET)})"
_CHANGED = "(s.avalaible IS DISTINCT FROM t.avalaible OR s.archived_date IS DISTINCT FROM t.archived_date)"
_WATCHED = ["avalaible", "archived_date"]


def _layer_changes(spark, sf_dir):
    source, target = derive(spark, sf_dir, LAYER_SOURCE), derive(spark, sf_dir, LAYER_TARGET)
    return target, maintain.layer_changes(source, target, "internal_id", _WATCHED)


@check(
    "layer_changes",
    f"""{_LAYERS} SELECT s.internal_id, CASE WHEN t.internal_id IS NULL THEN 'insert' ELSE 'update' END AS action
        FROM s LEFT JOIN t ON s.internal_id = t.internal_id WHERE t.internal_id IS NULL OR {_CHANGED}""",
)
def layer_changes(spark, sf_dir):
    return _layer_changes(spark, sf_dir)[1].select("internal_id", "action")


@check(
    "layer_sync",
    f"""{_LAYERS} SELECT internal_id, avalaible, strftime(archived_date, '%Y-%m-%d') AS archived, price FROM s""",
)
def layer_sync(spark, sf_dir):
    target, changes = _layer_changes(spark, sf_dir)
    out = maintain.apply_changes(target, changes, "internal_id", _WATCHED)
    return out.select("internal_id", "avalaible", F.date_format("archived_date", "yyyy-MM-dd").alias("archived"), "price")


@check(
    "bucketed_sync",
    f"""{_LAYERS} SELECT internal_id, avalaible, strftime(archived_date, '%Y-%m-%d') AS archived, price FROM s""",
)
def bucketed_sync(spark, sf_dir):
    """`layer_sync` between two tables in buckets by id, which are not shuffled again."""
    run = uuid.uuid4().hex
    layers = {"source": derive(spark, sf_dir, LAYER_SOURCE), "target": derive(spark, sf_dir, LAYER_TARGET)}
    held = {
        name: buckets.write_bucketed(df, f"{name}_{run}", ["internal_id"], 16, work_path(spark, name))
        for name, df in layers.items()
    }
    changes = maintain.layer_changes(held["source"], held["target"], "internal_id", _WATCHED)
    out = maintain.apply_changes(held["target"], changes, "internal_id", _WATCHED)
    return out.select("internal_id", "avalaible", F.date_format("archived_date", "yyyy-MM-dd").alias("archived"), "price")


@check(
    "sync_summary",
    f"""{_LAYERS} SELECT 'orders' AS table_name, count(*) FILTER (WHERE t.internal_id IS NULL) AS rows_added,
               count(*) FILTER (WHERE t.internal_id IS NOT NULL AND {_CHANGED}) AS rows_updated
        FROM s LEFT JOIN t ON s.internal_id = t.internal_id""",
)
def sync_summary(spark, sf_dir):
    return maintain.change_summary(_layer_changes(spark, sf_dir)[1], "orders")


FAILURES = """
    SELECT CAST(ts AS STRING) AS timestamp, CAST(user_id AS STRING) AS internal_id,
           'http://example.com/' || CAST(event_id AS STRING) AS url, event_type AS source_column,
           CASE WHEN event_id % 3 = 0 THEN concat('Traceback "x", y:', chr(10), '  File "a.py", line 1', chr(10), chr(10), props) ELSE props END AS error_message
    FROM {events} WHERE event_type = 'error'"""


@check(
    "failure_ledger",
    f"""SELECT internal_id, url, source_column, error_message, ledger FROM ({duck(FAILURES)}),
        (SELECT unnest(['csv', 'json']) AS ledger)""",
)
def failure_ledger(spark, sf_dir):
    failures = derive(spark, sf_dir, FAILURES)
    path = work_path(spark, "failures")
    sinks.record_failures(failures, path)
    csv = sinks.read_failures(spark, path, failures.schema).withColumn("ledger", F.lit("csv"))
    read = spark.read.schema(failures.schema)
    out = csv.unionByName(read.json(f"{path}/json").withColumn("ledger", F.lit("json")))
    return out.drop("timestamp")


@check(
    "failure_counts",
    f"SELECT internal_id, count(*) AS n_failures FROM ({duck(FAILURES)}) GROUP BY internal_id",
)
def failure_counts(spark, sf_dir):
    return runlog.failure_counts(derive(spark, sf_dir, FAILURES))


@check(
    "failures_of",
    f"SELECT internal_id, url, error_message FROM ({duck(FAILURES)}) WHERE internal_id = '7'",
)
def failures_of(spark, sf_dir):
    return runlog.failures_of(derive(spark, sf_dir, FAILURES), "7").select("internal_id", "url", "error_message")


@check(
    "run_log",
    f"""{_CTE}, a AS (SELECT count(*) AS n FROM feed WHERE site_id NOT IN (SELECT site_id FROM held WHERE {_ACTIVE})),
        g AS (SELECT count(*) AS n FROM held WHERE {_ACTIVE} AND site_id NOT IN (SELECT site_id FROM feed)),
        p AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) AS price FROM events GROUP BY 1, 2),
        c AS (SELECT count(*) AS n FROM p a JOIN p b ON a.user_id = b.user_id AND b.d = a.d - 1 WHERE a.price <> b.price)
        SELECT 'daily' AS parser_name, 'orders' AS table_name, a.n AS total_new_ids, g.n AS total_archived_ids,
               a.n AS new_records, g.n AS archived_records, c.n AS price_changes, 'success' AS status,
               CAST(NULL AS VARCHAR) AS message FROM a, g, c""",
)
def run_log(spark, sf_dir):
    feed, held = derive(spark, sf_dir, FEED), derive(spark, sf_dir, HELD)
    added = diff.new_listings(feed, held, ["site_id"])
    gone = diff.gone_listings(feed, held, ["site_id"])
    out = runlog.run_log("daily", "orders", F.current_timestamp(), added, gone, price_changes(spark, sf_dir))
    return out.drop("processed_at")
