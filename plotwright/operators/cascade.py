"""Matching listings to the gazetteer, rung by rung: region, city, part, street.

Every rung works on the distinct address values, not on the listings: a place that a
third of all listings name is matched once. The answers reach the listings through
one lookup join that is safe against hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import CAPITAL, CAPITAL_RING, CAPITAL_RING_REGION, admin_name, fold, lookup
from ..session import materialized, spread
from . import gazetteer as gaz
from .fuzzy import fuzzy_top1, partial_top1
from .lookup import distinct_keys, lookup_join

# Score cut-offs.
REGION_SCORE = 90  # at least
CITY_SCORE = 90  # above
STREET_SCORE = 89  # above
TITLE_REGION_SCORE = 85  # at least
TITLE_CITY_SCORE = 85  # above

# Cities and districts with a known region, and the regions' names.
CITY_REGIONS = {
    "kladno": "Středočeský kraj",
    "hodonin": "Jihomoravský kraj",
    "pisek": "Jihočeský kraj",
    "benesov": "Středočeský kraj",
    "tachov": "Plzeňský kraj",
    "frydek": "Moravskoslezský kraj",
}
DISTRICT_REGIONS: dict[str, str] = {}
RING_REGION = "Středočeský kraj"
CAPITAL_REGION_NAME = "Hl.m. Praha"

ADDRESS = ["district", "city", "city_part", "street"]


def _first(found: list[tuple[str, Column]], value: str, step: str) -> list[Column]:
    """The first rung with an answer, and that rung's name."""
    answer = F.coalesce(*[c for _, c in found])
    names = reduce(lambda chain, rung: chain.when(rung[1].isNotNull(), F.lit(rung[0])), found, F.when(F.lit(False), ""))
    return [answer.alias(value), names.alias(step)]


def _join_value(rows: DataFrame, on: Column, table: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """`rows` with the lookup's value for an expression."""
    side = table.select(F.col(key).alias("_key"), F.col(value).alias(name))
    return rows.join(side, on == side["_key"], "left").drop("_key")


def _value_regions(values: DataFrame, gazetteer: DataFrame, exceptions: DataFrame | None) -> DataFrame:
    """(value, r_city, r_fuzzy, r_alias, r_name, r_row, r_capital) for each distinct address value.

    Each column holds one rung's answer for the value on its own.
    """
    cleaned = values.withColumns({"_clean": admin_name(F.col("value")), "_fold": fold(F.col("value"))}).where("_clean != ''")
    regions = gaz.region_names(gazetteer)
    best = fuzzy_top1(cleaned, "_clean", regions, "name", REGION_SCORE)
    best = best.join(regions, best["choice"] == regions["name"]).select("query", "kraj")
    out = _join_value(cleaned, F.col("_clean"), best, "query", "kraj", "r_fuzzy")
    out = _join_value(out, F.col("_clean"), gaz.city_regions(gazetteer, exceptions), "name", "kraj", "r_name")
    out = _join_value(out, F.lower("value"), gaz.regions_by(gazetteer, ["nazev_obce"]), "nazev_obce", "kraj", "r_row")
    ring = reduce(lambda a, b: a | b, [F.contains(F.col("_fold"), F.lit(r)) for r in CAPITAL_RING])
    capital = F.when(
        F.startswith(F.col("_fold"), F.lit(CAPITAL)),
        F.when(ring, F.lit(RING_REGION)).otherwise(F.lit(CAPITAL_REGION_NAME)),
    )
    return out.select(
        "value",
        lookup(F.col("_fold"), DISTRICT_REGIONS).cast("string").alias("r_district"),
        lookup(F.col("_fold"), CITY_REGIONS).alias("r_city"),
        "r_fuzzy",
        F.when(F.col("_clean") == CAPITAL_RING_REGION, F.lit(RING_REGION)).alias("r_alias"),
        "r_name",
        "r_row",
        capital.alias("r_capital"),
    )


RUNGS = ["r_district", "r_city", "r_fuzzy", "r_alias", "r_name", "r_row", "r_capital"]


def address_regions(addresses: DataFrame, gazetteer: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Distinct addresses with `new_region` and `region_step`, the district asked before the city."""
    values = addresses.select(F.explode(F.array("district", "city")).alias("value")).where("value IS NOT NULL").distinct()
    by_value = materialized(_value_regions(values, gazetteer, exceptions), "value-regions")
    by_part = gaz.regions_by(gazetteer, ["nazev_obce", "nazev_casti_obce"])
    by_street = gaz.regions_by(gazetteer, ["nazev_obce", "nazev_ulice"])
    out = addresses
    found = []
    for column in ("district", "city"):
        side = by_value.select(
            F.col("value").alias("_value"),
            F.lit(True).alias(f"_{column}_usable"),
            *[F.col(r).alias(f"_{column}_{r}") for r in RUNGS],
        )
        out = out.join(side, out[column] == side["_value"], "left").drop("_value")
        for table, second, name in ((by_part, "city_part", "part"), (by_street, "street", "street")):
            t_second = [c for c in table.columns if c not in ("nazev_obce", "kraj")][0]
            side = table.select(
                F.col("nazev_obce").alias("_a"), F.col(t_second).alias("_b"), F.col("kraj").alias(f"_{column}_by_{name}")
            )
            on = (F.lower(out[column]) == side["_a"]) & (F.lower(out[second]) == side["_b"])
            out = out.join(side, on, "left").drop("_a", "_b")
        # The district table applies to districts only.
        asked = [r for r in RUNGS[:-1] if column == "district" or r != "r_district"]
        found += [(f"{column}_{r[2:]}", F.col(f"_{column}_{r}")) for r in asked]
        usable = F.col(f"_{column}_usable")
        found += [(f"{column}_{n}", F.when(usable, F.col(f"_{column}_by_{n}"))) for n in ("part", "street")]
        found.append((f"{column}_capital", F.col(f"_{column}_r_capital")))
    return out.select(*addresses.columns, *_first(found, "new_region", "region_step"))


def _title_places(titles: DataFrame, title: str, cities: DataFrame, value: str, cut_off: int, strict: bool) -> DataFrame:
    """Each row of `titles` with the value of the city whose name fits best inside its title."""
    folded = titles.withColumn("_fold", fold(F.col(title)))
    best = partial_top1(folded, "_fold", cities, "name", cut_off, strict)
    best = best.join(cities, best["choice"] == cities["name"]).select(F.col("query").alias("_q"), value)
    return folded.join(best, folded["_fold"] == best["_q"], "left").drop("_fold", "_q")


def title_regions(titles: DataFrame, title: str, gazetteer: DataFrame) -> DataFrame:
    """`titles` with `kraj`, the region of the city whose name fits best inside the title."""
    return _title_places(titles, title, gaz.first_city_region(gazetteer), "kraj", TITLE_REGION_SCORE, False)


def assign_regions(listings: DataFrame, gazetteer: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Listings with `region` filled where it was null, and `region_step`.

    An address answer goes before an answer from the title, which is asked for only
    where region and district are null.
    """
    open_rows = F.col("region").isNull()
    addresses = materialized(distinct_keys(listings.where(open_rows), ADDRESS), "addresses")
    regions = materialized(address_regions(addresses, gazetteer, exceptions), "address-regions")
    asks_title = open_rows & F.col("district").isNull() & F.col("name").isNotNull()
    titles = title_regions(distinct_keys(listings.where(asks_title), ["name"]), "name", gazetteer)
    titles = materialized(titles.withColumnRenamed("kraj", "region_from_name"), "title-regions")
    out = lookup_join(listings, regions, ADDRESS, open_rows)
    out = lookup_join(out, titles, ["name"], asks_title)
    from_title = F.col("region_from_name")
    step = (
        F.when(~open_rows, F.lit(None))
        .when(F.col("new_region").isNotNull(), F.col("region_step"))
        .when(from_title.isNotNull(), F.lit("title"))
    )
    return out.withColumns(
        {
            "region_step": step,
            "region": F.coalesce("region", "new_region", from_title),
        }
    ).drop("new_region")


def unresolved() -> Column:
    """Listings without any place: no region, district or city, and none in the title."""
    blank = [F.col(c).isNull() for c in ("region", "district", "city", "region_from_name")]
    return reduce(lambda a, b: a & b, blank)


def quarantine(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, garbage) of listings that went through `assign_regions`."""
    return listings.where(~unresolved()), listings.where(unresolved())


def _by_folded(values: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """(name, nazev_obce, exact) for each distinct folded value: the exact city, or the best fuzzy one."""
    exact = values.join(table, "name")
    rest = values.join(table, "name", "left_anti")
    best = fuzzy_top1(rest, "name", table, "name", CITY_SCORE, strict=True)
    fuzzy = best.join(table, best["choice"] == table["name"]).select(best["query"].alias("name"), "nazev_obce")
    return materialized(exact.withColumn("exact", F.lit(True)).unionByName(fuzzy.withColumn("exact", F.lit(False))), name)


def address_cities(addresses: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Distinct (district, city, city_part) with `new_city` and `city_step`; exact rungs before fuzzy ones."""
    columns = ["district", "city", "city_part"]
    # A written table of few bytes is read by few tasks, and folding is the costly part.
    folded = spread(addresses, *columns).withColumns({f"_{c}": fold(F.col(c)) for c in columns})
    names, parts = gaz.city_names(gazetteer), gaz.part_cities(gazetteer)
    city_values = folded.select(F.explode(F.array("_district", "_city")).alias("name")).where("name != ''").distinct()
    part_values = folded.select(F.col("_city_part").alias("name")).where("name != ''").distinct()
    tables = {"city": _by_folded(city_values, names, "value-cities"), "part": _by_folded(part_values, parts, "part-cities")}
    out = folded
    for column, table in (("district", "city"), ("city", "city"), ("city_part", "part")):
        side = tables[table].select(
            F.col("name").alias("_name"), F.col("nazev_obce").alias(f"_m_{column}"), F.col("exact").alias(f"_e_{column}")
        )
        out = out.join(side, out[f"_{column}"] == side["_name"], "left").drop("_name")
    found = [(c, F.when(F.col(f"_e_{c}"), F.col(f"_m_{c}"))) for c in columns]
    found += [(f"{c}_fuzzy", F.when(~F.col(f"_e_{c}"), F.col(f"_m_{c}"))) for c in columns]
    return out.select(*addresses.columns, *_first(found, "new_city", "city_step"))


def title_cities(titles: DataFrame, title: str, gazetteer: DataFrame) -> DataFrame:
    """`titles` with `nazev_obce`, the city whose name fits best inside the title."""
    return _title_places(titles, title, gaz.city_names(gazetteer), "nazev_obce", TITLE_CITY_SCORE, True)


def assign_cities(listings: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Listings with a region but no `norm_city` get one where a rung finds it, and `city_step`."""
    columns = ["district", "city", "city_part"]
    open_rows = F.col("region").isNotNull() & F.col("norm_city").isNull()
    addresses = materialized(distinct_keys(listings.where(open_rows), columns), "addresses")
    cities = materialized(address_cities(addresses, gazetteer), "address-cities")
    out = lookup_join(listings, cities, columns, open_rows)
    asks_title = open_rows & F.col("new_city").isNull() & F.col("name").isNotNull()
    titles = title_cities(distinct_keys(out.where(asks_title), ["name"]), "name", gazetteer)
    titles = materialized(titles.withColumnRenamed("nazev_obce", "_title_city"), "title-cities")
    out = lookup_join(out, titles, ["name"], asks_title)
    step = F.coalesce("city_step", F.when(F.col("_title_city").isNotNull(), F.lit("name")))
    return out.withColumns(
        {"city_step": step, "norm_city": F.coalesce("norm_city", "new_city", "_title_city")}
    ).drop("new_city", "_title_city")


def assign_city_parts(listings: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Listings without `norm_city_part` get the gazetteer's spelling of their exact (city, part)."""
    open_rows = F.col("norm_city_part").isNull()
    pairs = distinct_keys(listings.where(open_rows), ["city", "city_part"])
    folded = pairs.withColumns({"_c": fold(F.col("city")), "_p": fold(F.col("city_part"))})
    table = gaz.city_parts(gazetteer).withColumnRenamed("city", "_tc").withColumnRenamed("part", "_tp")
    matched = folded.join(table, (folded["_c"] == table["_tc"]) & (folded["_p"] == table["_tp"]), "left")
    matched = materialized(matched.select(*pairs.columns, F.col("nazev_casti_obce").alias("_part")), "city-parts")
    out = lookup_join(listings, matched, ["city", "city_part"], open_rows)
    return out.withColumn("norm_city_part", F.coalesce("norm_city_part", "_part")).drop("_part")


STREET_FIELDS = ["street", "city_part", "city", "district"]


def address_streets(addresses: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Distinct (norm_city, street, city_part, city, district) with `new_street` and `street_step`.

    An exact match of any field, in that order, goes before the best fuzzy one.
    """
    table = gaz.city_streets(gazetteer)
    fields = F.array(*[F.struct(F.lit(i).alias("rank"), fold(F.col(c)).alias("value")) for i, c in enumerate(STREET_FIELDS)])
    asked = spread(addresses, *addresses.columns).withColumn("vc", fold(F.col("norm_city"))).where("vc != ''")
    asked = asked.withColumn("_f", F.explode(fields)).select(*addresses.columns, "vc", "_f.rank", "_f.value").where("value != ''")
    values = asked.select("vc", "value").distinct()
    exact = values.join(table, (values["vc"] == table["city"]) & (values["value"] == table["street"]))
    exact = exact.select("vc", "value", "nazev_ulice", F.lit(0.0).alias("short_of"), F.lit("strict").alias("step"))
    rest = values.join(exact.select("vc", "value"), ["vc", "value"], "left_anti")
    best = fuzzy_top1(rest, "value", table, "street", STREET_SCORE, strict=True, query_block="vc", choice_block="city")
    fuzzy = best.join(table, (best["block"] == table["city"]) & (best["choice"] == table["street"])).select(
        best["block"].alias("vc"), best["query"].alias("value"), "nazev_ulice",
        (F.lit(100.0) - F.col("score")).alias("short_of"), F.lit("fuzzy").alias("step"),
    )
    # A folded value that equals a street falls short by nothing, so exact answers come first.
    answered = asked.join(exact.unionByName(fuzzy), ["vc", "value"], "left")
    order = F.struct(F.col("short_of").isNull(), "short_of", "rank")
    first = answered.groupBy(*addresses.columns).agg(F.min_by(F.struct("nazev_ulice", "step"), order).alias("_b"))
    return first.select(*addresses.columns, F.col("_b.nazev_ulice").alias("new_street"), F.col("_b.step").alias("street_step"))


def assign_streets(listings: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Listings without `norm_ulice` get a street of their `norm_city`, and `street_step`."""
    columns = ["norm_city", *STREET_FIELDS]
    open_rows = F.col("norm_ulice").isNull() & F.col("norm_city").isNotNull()
    addresses = materialized(distinct_keys(listings.where(open_rows), columns), "addresses")
    streets = materialized(address_streets(addresses, gazetteer), "address-streets")
    out = lookup_join(listings, streets, columns, open_rows)
    return out.withColumn("norm_ulice", F.coalesce("norm_ulice", "new_street")).drop("new_street")


def step_statistics(listings: DataFrame, step: str) -> DataFrame:
    """Rows per matching rung; rows no rung matched count as `unmatched`."""
    return listings.groupBy(F.coalesce(F.col(step), F.lit("unmatched")).alias("match_step")).agg(F.count("*").alias("n"))
