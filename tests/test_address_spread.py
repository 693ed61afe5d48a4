from plotwright.operators import cascade


def test_folding_of_addresses_is_dealt_to_all_tasks(spark):
    """Addresses lie in a file of few bytes, which one task would read and fold."""
    gazetteer = spark.createDataFrame(
        [("Nový Dvůr", "Dvůr", f"Ulice {i}", "A kraj") for i in range(5)],
        "nazev_obce string, nazev_casti_obce string, nazev_ulice string, kraj string",
    )
    addresses = spark.createDataFrame(
        [("Nový Dvůr", "ulice 3", None, "NOVY DVUR", None)], "norm_city string, street string, city_part string, city string, district string"
    )
    streets = cascade.address_streets(addresses, gazetteer)
    cities = cascade.address_cities(addresses.select("district", "city", "city_part"), gazetteer)
    for found, first in ((streets, "norm_city"), (cities, "district")):
        assert f"RepartitionByExpression [{first}" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.new_street, r.street_step) for r in streets.collect()] == [("Ulice 3", "strict")]
    assert [(r.new_city, r.city_step) for r in cities.collect()] == [("Nový Dvůr", "city")]
