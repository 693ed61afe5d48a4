"""What a run asks and keeps. The rungs are replaced by a plain answer here; the query geo_second_day runs the real ones."""

import pytest
from pyspark.sql import functions as F

from plotwright.operators.conform import conform
from plotwright.operators.lookup import ASKED
from plotwright.plans import geo
from plotwright.plans.geo import KEYS, STEPS, gazetteer_version, normalize, normalize_cached
from plotwright.schemas import GAZETTEER, GEO_COLUMNS, LISTING_GEO
from plotwright.session import work_path
from plotwright.sources import merge

PLACES = [
    ("Praha", "Smíchov", "Lidická", "Hlavní město Praha"),
    ("Brno", "Žabovřesky", "Lidická", "Jihomoravský kraj"),
    ("Kolín", "Kolín II", "Pražská", "Středočeský kraj"),
    ("Plzeň", "Slovany", "Slovanská alej", "Plzeňský kraj"),
]


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame(PLACES, GAZETTEER)


@pytest.fixture(autouse=True)
def plain_answers(monkeypatch):
    def answers(places, gazetteer, exceptions):
        new = [F.concat_ws("/", F.lit(c), F.lit(gazetteer.count()), *KEYS).alias(f"_new_{c}") for c in GEO_COLUMNS]
        lost = (F.col("city").isNull() & F.col("district").isNull()).alias("_lost")
        return places.select(*KEYS, F.col("_rows").alias(ASKED), *new, *[F.lit(s).alias(s) for s in STEPS], lost)

    monkeypatch.setattr(geo, "_answers", answers)


def listings(spark, rows):
    columns = "internal_id long, district string, city string, city_part string, street string, name string"
    return conform(spark.createDataFrame(rows, columns), LISTING_GEO)


FIRST = [
    (1, None, "Brno", "žabovřesky", "Lidicka", None),
    (2, None, "Brno", "žabovřesky", "Lidicka", None),
    (3, "Kolin", None, None, "Prazska 1", None),
    (4, None, None, None, None, None),
    (5, None, None, None, None, "Garáž"),
]
NEW = [
    (6, None, "Brnoo", None, "Lidické", None),
    (7, None, None, None, "", "Byt Plzeň"),
    (8, None, "", None, None, None),
    (9, "null", None, None, None, None),
]


def rows(done, garbage):
    kept = [(r.internal_id, *[r[c] for c in GEO_COLUMNS], *[r[s] for s in STEPS]) for r in done.collect()]
    return sorted(kept, key=str), sorted(r.internal_id for r in garbage.collect())


def test_second_day_asks_new_places_only(spark, gazetteer):
    cache = work_path(spark, "places")
    first, both = listings(spark, FIRST), listings(spark, FIRST + NEW)
    one = normalize_cached(first, gazetteer, cache)
    assert (one.asked, one.known) == (4, 0)
    assert rows(one.done, one.garbage) == rows(*normalize(first, gazetteer))
    two = normalize_cached(both, gazetteer, cache)
    assert (two.asked, two.known) == (4, 4)
    assert rows(two.done, two.garbage) == rows(*normalize(both, gazetteer))
    three = normalize_cached(both, gazetteer, cache)
    assert (three.asked, three.known) == (0, 8)
    assert rows(three.done, three.garbage) == rows(two.done, two.garbage)


def test_other_gazetteer_asks_again(spark, gazetteer):
    cache = work_path(spark, "places")
    rowset = listings(spark, FIRST)
    normalize_cached(rowset, gazetteer, cache)
    wider = spark.createDataFrame([*PLACES, ("Garáž", "g", "h", "Zlínský kraj")], GAZETTEER)
    again = normalize_cached(rowset, wider, cache)
    assert (again.asked, again.known) == (4, 0)
    assert rows(again.done, again.garbage) == rows(*normalize(rowset, wider))
    back = normalize_cached(rowset, gazetteer, cache)
    assert back.asked == 0 and rows(back.done, back.garbage) == rows(*normalize(rowset, gazetteer))


def test_version_depends_on_rows_alone(spark, gazetteer):
    turned = spark.createDataFrame(PLACES[::-1], GAZETTEER).repartition(3)
    assert gazetteer_version(gazetteer) == gazetteer_version(turned)
    names = gazetteer.select("nazev_obce")
    versions = {
        gazetteer_version(gazetteer),
        gazetteer_version(gazetteer, names),
        gazetteer_version(gazetteer, names.limit(0)),
        gazetteer_version(gazetteer.union(gazetteer.limit(1))),
        gazetteer_version(spark.createDataFrame([(None, *PLACES[0][1:]), *PLACES[1:]], GAZETTEER)),
    }
    assert len(versions) == 5


def test_empty_days_and_compaction(spark, gazetteer, monkeypatch):
    monkeypatch.setattr("plotwright.plans.geo.MOST_DELTAS", 1)
    cache = work_path(spark, "places")
    none = listings(spark, FIRST).limit(0)
    empty = normalize_cached(none, gazetteer, cache)
    assert (empty.asked, empty.known, empty.done.count(), empty.garbage.count()) == (0, 0, 0, 0)
    for upto in (2, 3, 5):
        normalize_cached(listings(spark, FIRST[:upto]), gazetteer, cache)
    path = f"{cache}/{gazetteer_version(gazetteer)}"
    assert merge.delta_count(spark, path) == 2
    last = normalize_cached(listings(spark, FIRST + NEW[:1]), gazetteer, cache)
    assert (last.asked, merge.delta_count(spark, path)) == (1, 1)
    assert rows(last.done, last.garbage) == rows(*normalize(listings(spark, FIRST + NEW[:1]), gazetteer))
