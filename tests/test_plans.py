import datetime as dt

import pytest
from pyspark.sql import functions as F

from plotwright.operators import cascade
from plotwright.operators.conform import conform
from plotwright.plans import daily_load, dedup, silver
from plotwright.plans.geo import normalize
from plotwright.schemas import GAZETTEER, LISTING, LISTING_GEO

DAY = dt.date(2024, 5, 2)


@pytest.fixture(scope="module")
def gazetteer(spark):
    rows = [
        ("Praha", "Smíchov", "Lidická", "Hlavní město Praha"),
        ("Praha", "Žižkov", "Husitská", "Hlavní město Praha"),
        ("Brno", "Žabovřesky", "Lidická", "Jihomoravský kraj"),
        ("Brno", "Veveří", "Veveří", "Jihomoravský kraj"),
        ("Kolín", "Kolín II", "Pražská", "Středočeský kraj"),
        ("Lhota", "Horní", "Krátká", "Středočeský kraj"),
        ("Lhota", "Dolní", "Dlouhá", "Plzeňský kraj"),
        ("Plzeň", "Slovany", "Slovanská alej", "Plzeňský kraj"),
    ]
    return spark.createDataFrame(rows, GAZETTEER)


def listings(spark, rows):
    """Rows of (internal_id, district, city, city_part, street, name)."""
    columns = "internal_id long, district string, city string, city_part string, street string, name string"
    return conform(spark.createDataFrame(rows, columns), LISTING_GEO)


def test_regions(spark, gazetteer):
    cases = [
        (1, "Praha 5", None, None, None, None, "Hl.m. Praha"),
        (2, "Praha-východ", None, None, None, None, "Středočeský kraj"),
        (3, None, "Brno-střed", None, None, None, None),
        (4, "okres Kolín", None, None, None, None, "Středočeský kraj"),
        (5, None, "Lhota", "Dolní", None, None, "Plzeňský kraj"),
        (6, None, "Lhota", None, "Krátká", None, "Středočeský kraj"),
        (7, None, "Lhota", None, None, None, None),
        (8, "Kladno", None, None, None, None, "Středočeský kraj"),
        (9, "Jihomoravský", "Plzeň", None, None, None, "Jihomoravský kraj"),
        (10, None, None, None, None, "Prodej bytu, Plzeň centrum", "Plzeňský kraj"),
        (11, None, None, None, None, "Garáž", None),
        (12, None, None, None, None, None, None),
        (13, "Středočeský", None, None, None, None, "Středočeský kraj"),
    ]
    out = cascade.assign_regions(listings(spark, [c[:6] for c in cases]), gazetteer)
    found = {r.internal_id: r.region for r in out.collect()}
    # The capital resolves through the unambiguous city name to the gazetteer's own region text.
    expected = {c[0]: c[6] for c in cases} | {1: "Hlavní město Praha"}
    assert found == expected
    kept, garbage = cascade.quarantine(out)
    assert sorted(r.internal_id for r in garbage.collect()) == [11, 12]
    assert kept.count() == len(cases) - 2


def test_chain(spark, gazetteer):
    rows = [
        (1, None, "Brno", "žabovřesky", "Lidicka", None),
        (2, None, "Brnoo", None, "Lidické", None),
        (3, "Kolin", None, None, "Prazska 1", None),
        (4, None, "Nikde", "Slovany", "Slovanska alej", "x"),
        (5, None, None, None, None, "Byt Brno"),
        (6, None, None, None, None, None),
    ]
    base = listings(spark, rows)
    base = base.withColumn("region", F.when(F.col("internal_id").isin(2, 4), F.lit("given")))
    done, garbage = normalize(base, gazetteer)
    found = {r.internal_id: (r.region, r.norm_city, r.norm_city_part, r.norm_ulice) for r in done.collect()}
    assert found == {
        1: ("Jihomoravský kraj", "Brno", "Žabovřesky", "Lidická"),
        2: ("given", None, None, None),
        3: ("Středočeský kraj", "Kolín", None, None),
        4: ("given", "Plzeň", None, "Slovanská alej"),
        5: ("Jihomoravský kraj", "Brno", None, None),
    }
    assert [r.internal_id for r in garbage.collect()] == [6]


def test_fuzzy_city_step(spark, gazetteer):
    base = listings(spark, [(1, "Zizkovv", "Zizkovv", "Zizkovv", None, None)]).withColumn("region", F.lit("r"))
    row = cascade.assign_cities(base, gazetteer).first()
    assert (row.norm_city, row.city_step) == ("Praha", "city_part_fuzzy")


def test_existing_values_stay(spark, gazetteer):
    base = listings(spark, [(1, "Kolín", None, None, None, None)])
    base = base.withColumns({"region": F.lit("r"), "norm_city": F.lit("c"), "norm_city_part": F.lit("p"), "norm_ulice": F.lit("u")})
    done, _ = normalize(base, gazetteer)
    row = done.first()
    assert (row.region, row.norm_city, row.norm_city_part, row.norm_ulice) == ("r", "c", "p", "u")


def test_titled_feed(spark):
    data = '{"id": 7, "type": "Byty", "title": "Prodej bytu 3+kk", "address": "Lidická 12, Brno, okres Brno-město", "Cena": "4 590 000 Kč", "Užitná plocha": "76,5 m²"}'
    feed = spark.createDataFrame([(data,)], "data string")
    present = ["id", "type", "title", "address", "Cena", "Užitná plocha"]
    row = daily_load.standardize_titled(feed, F.lit(DAY), present).first()
    assert (row.site_id, row.source_id, row.deal_type, row.rooms, row.price, row.area_build) == ("7", 4, "prodej", "3+kk", 4590000.0, 76.5)
    assert (row.street, row.house_number, row.city, row.district) == ("Lidická", "12", "Lidická 12", "Brno")
    assert row.added_date == DAY and row.avalaible and row.archived_date is None and row.area_land is None


def test_all_feeds_share_the_schema(spark):
    flat = spark.createDataFrame([(1, "bad", "n")], "id long, price string, name string")
    captioned = spark.createDataFrame([(1, "prodej", "x", "byt", None, "a,b,c", 5)],
                                      "id long, offer_type string, image_alt_text string, estate_type string, disposition string, address string, price int")
    data = spark.createDataFrame([("{}",)], "data string")
    loads = [
        daily_load.standardize_flat(flat, F.lit(DAY)),
        daily_load.standardize_captioned(captioned, F.lit(DAY)),
        daily_load.standardize_labelled(data, F.lit(DAY)),
        daily_load.standardize_titled(data, F.lit(DAY)),
    ]
    assert all(x.schema.simpleString() == LISTING.simpleString() for x in loads)
    assert [x.first().source_id for x in loads] == [1, 2, 3, 4]
    assert loads[0].first().price is None


def test_load_revives_and_archives(spark):
    held = conform(
        spark.createDataFrame(
            [(1, "a", 1, True, None, 10.0), (2, "b", 1, True, None, 20.0), (3, "c", 1, False, dt.date(2024, 1, 1), 30.0), (4, "a", 2, True, None, 40.0)],
            "internal_id long, site_id string, source_id int, avalaible boolean, archived_date date, price double",
        ),
        LISTING,
    )
    feed = daily_load.standardize_flat(spark.createDataFrame([("a", "11"), ("c", "31")], "id string, price string"), F.lit(DAY))
    load = daily_load.load_source(feed, held, 1, F.lit(DAY))
    state = sorted((r.site_id, r.source_id, r.avalaible, r.price, str(r.archived_date)) for r in load.listings.collect())
    assert state == [
        ("a", 1, True, 11.0, "None"),
        ("a", 2, True, 40.0, "None"),
        ("b", 1, False, 20.0, "2024-05-02"),
        ("c", 1, False, 30.0, "2024-01-01"),
        ("c", 1, True, 31.0, "None"),
    ]
    assert load.added.count() == 1 and load.archived.count() == 1
    kept = daily_load.load_source(feed, held, 1, F.lit(DAY), compare="all", refresh_price=False).listings
    assert sorted((r.site_id, r.price) for r in kept.where("source_id = 1").collect()) == [("a", 10.0), ("b", 20.0), ("c", 30.0)]


def test_silver(spark):
    rows = conform(spark.createDataFrame([(1, "Rodinné domy"), (2, None)], "internal_id long, category_name string"), LISTING)
    out = silver.to_silver(rows)
    assert [(r.category_value, r.category_name, r.house_type) for r in out.orderBy("internal_id").collect()] == [
        (2, "Domy", "2"),
        (5, "Ostatní", "5"),
    ]
    target = conform(out.limit(0), LISTING_GEO)
    synced, summary = silver.sync_layer(out, target, "geo")
    assert synced.schema.names == LISTING_GEO.names and synced.count() == 2
    assert tuple(summary.first()) == ("geo", 2, 0)


def test_dedup_plan(spark):
    zero, near, far = "0" * 64, "0" * 63 + "1", "f" * 64
    rows = [(1, "idnes", 0, zero), (2, "idnes", 0, near), (3, "hyper", 0, zero), (4, "hyper", 1, far)]
    images = spark.createDataFrame(rows, "internal_id long, source string, pos int, signature string")
    out = dedup.find_duplicates(images)
    assert [(r.left, r.right, r.distance) for r in out.pairs.collect()] == [(zero, near, 1)]
    assert {(r.first_key, r.n_copies, r.n_near) for r in out.counts.collect()} == {(1, 1, 1), (2, 0, 2), (4, 0, 0)}
    assert out.statistics.first().total == 1 and out.hashes.count() == 4 and out.groups.count() == 3
