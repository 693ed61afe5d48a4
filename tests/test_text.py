import pytest
from pyspark.sql import functions as F

from plotwright.functions import address, text, urls


def values(spark, items, column, schema="x string"):
    """The column's value for each input, in order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(items)]
    df = spark.createDataFrame(rows, f"i int, {schema}").select("i", column.alias("v"))
    return [r["v"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_admin_names(spark):
    cases = {
        "Praha 5": "hl.m. praha",
        "Praha-východ": "stredocesky kraj",
        "Praha - východ": "hl.m. praha",
        "Brno-venkov": "brno venkov",
        "Brno-město": "brno mesto",
        "Ostrava-jih": "ostrava",
        "okres Kolín": "kolin",
        "Středočeský kraj": "stredocesky",
        "Plzeň-sever": "plzen",
        None: "",
        "Kolín-": "kolin",
    }
    assert values(spark, list(cases), text.admin_name(F.col("x"))) == list(cases.values())


def test_fold(spark):
    cases = {"Žluťoučký kůň ": "zlutoucky kun", "\tStraße ": "strasse", "Œuvre Æon": "oeuvre aeon", "Łódź": "lodz", None: ""}
    assert values(spark, list(cases), text.fold(F.col("x"))) == list(cases.values())


def test_prices_and_areas(spark):
    assert values(spark, ["4 590 000 Kč", "Info v RK", None], text.price(F.col("x"))) == [4590000.0, None, None]
    cases = {"76,5 m²": 76.5, "76 m2": 762.0, "1.234,5 m²": None, "": None}
    assert values(spark, list(cases), text.area(F.col("x"))) == list(cases.values())


def test_disposition_and_caption(spark):
    cases = [("DISP_3_KK", None), (None, "byt 2+1 54 m²"), (None, "byt"), (None, "Byt 4+KK")]
    found = values(spark, cases, text.disposition(F.col("code"), F.col("caption")), "code string, caption string")
    assert found == ["3+kk", "2+1", None, "4+kk"]
    assert values(spark, ["byt 2+1 54 m²", "12,5 m^2", "54"], text.caption_area(F.col("x"))) == [54.0, 12.5, None]


def test_land_area(spark):
    cases = [("dum", "Dům, pozemek 900 m2"), ("Pozemek", "1200 m²"), ("byt", "54 m²"), ("dum", "54 m²")]
    found = values(spark, cases, text.land_area(F.col("kind"), F.col("caption")), "kind string, caption string")
    assert found == [900.0, 1200.0, None, None]


def test_titles(spark):
    titles = ["Prodej bytu 3+kk", "Pronájem bytu 2+1", "Dražba"]
    assert values(spark, titles, text.deal_type(F.col("x"))) == ["prodej", "pronájem", None]
    assert values(spark, titles, text.rooms(F.col("x"))) == ["3+kk", "2+1", None]
    assert values(spark, ["  PRODEJ bytu", "", None], text.first_token(F.col("x"))) == ["prodej", None, None]


def test_categories(spark):
    cases = {
        "Byty k prodeji": 1,
        "Rodinné domy": 2,
        "Chaty a chalupy": 2,
        "Komerční objekty": 4,
        "Garáže": 5,
        "Prodej": 5,
        "Nebyty": 1,
        None: 5,
    }
    assert values(spark, list(cases), text.category(F.col("x")).getField("category_value")) == list(cases.values())
    found = values(spark, ["BYT", "chata", None], text.estate_category(F.col("x")))
    assert [tuple(f) for f in found] == [(1, "Byty"), (None, "Neznámá"), (None, "Neznámá")]


def test_parse_address(spark):
    cases = {
        "Lidická 12, Brno, okres Brno-město": ("Brno", "Lidická 12", None, "Lidická", "12"),
        "Praha 5 - Smíchov": (None, "Praha 5", "Smíchov", None, None),
        "Kolín, okres Kolín": ("Kolín", "Kolín", None, None, None),
        "Praha 5": (None, "Praha 5", None, "Praha", "5"),
        "Brno-Žabovřesky 12": (None, "Brno", "Žabovřesky 12", "Brno-Žabovřesky", "12"),
        "": (None, "", None, None, None),
        None: (None, None, None, None, None),
    }
    found = values(spark, list(cases), address.parse_address(F.col("x")))
    assert [(f.district, f.city, f.city_part, f.street, f.house_number) for f in found] == list(cases.values())


def test_split_address(spark):
    cases = {
        "Lidická 12, Brno - Veveří, Jihomoravský": ("Lidická 12", "Brno - Veveří", "Jihomoravský", "Veveří"),
        "Hlavní 1, Praha - Smíchov, okres": ("Hlavní 1", "Praha", "okres", "Smíchov"),
        None: ("", "", "", None),
    }
    found = values(spark, list(cases), address.split_address(F.col("x")))
    assert [(f.street, f.city, f.district, f.city_part) for f in found] == list(cases.values())


@pytest.mark.parametrize(
    "given, expected",
    [
        ('["a","b"]', ["a", "b"]),
        ('"a"', ["a"]),
        ("http://x/1.jpg", ["http://x/1.jpg"]),
        ('[["a","b"],["c"]]', ["a", "b"]),
        ('[{"url":"a"},"b",{"id":1}]', ["a", "b"]),
        ("", None),
        (None, None),
    ],
)
def test_url_lists(spark, given, expected):
    assert values(spark, [given], urls.item_urls(urls.url_list(F.col("x")))) == [expected]
