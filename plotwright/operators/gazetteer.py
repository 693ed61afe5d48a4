"""Lookup tables drawn from the address gazetteer.

The gazetteer has one row per street: nazev_obce (city), nazev_casti_obce (part),
nazev_ulice (street), kraj (region). None of the joins below forces a broadcast;
Spark broadcasts a lookup only while its measured size is under the session's limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import admin_name, fold


def _unique_region(gazetteer: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that lead to a single region, with it."""
    found = gazetteer.dropna(subset=keys).groupBy(*keys)
    return (
        found.agg(F.min("kraj").alias("kraj"), F.max("kraj").alias("_last"))
        .where(F.col("kraj") == F.col("_last"))
        .drop("_last")
    )


def region_names(gazetteer: DataFrame) -> DataFrame:
    """(name, kraj): cleaned region name to region; the last spelling of a name wins."""
    return gazetteer.groupBy(admin_name(F.col("kraj")).alias("name")).agg(F.max("kraj").alias("kraj")).where("name != ''")


def ambiguous_names(gazetteer: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(name): cleaned city names found in several regions, and the listed exceptions."""
    per_name = gazetteer.groupBy(admin_name(F.col("nazev_obce")).alias("name")).agg(
        F.min("kraj").alias("low"), F.max("kraj").alias("high")
    )
    found = per_name.where(F.col("low") != F.col("high")).select("name")
    if exceptions is None:
        return found
    return found.union(exceptions.select(admin_name(F.col("nazev_obce")).alias("name"))).distinct()


def city_regions(gazetteer: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(name, kraj): cleaned city name to region, unambiguous names only."""
    named = gazetteer.select(admin_name(F.col("nazev_obce")).alias("name"), "kraj").where("name != ''")
    unique = _unique_region(named, ["name"])
    if exceptions is None:
        return unique
    listed = exceptions.select(admin_name(F.col("nazev_obce")).alias("name")).distinct()
    return unique.join(listed, "name", "left_anti")


def regions_by(gazetteer: DataFrame, columns: list[str]) -> DataFrame:
    """(columns.., kraj): lower-cased values that together lead to a single region."""
    lowered = gazetteer.select(*[F.lower(c).alias(c) for c in columns], "kraj")
    return _unique_region(lowered, columns)


def city_names(gazetteer: DataFrame) -> DataFrame:
    """(name, nazev_obce): folded city name to its spelling; the last one wins."""
    return gazetteer.groupBy(fold(F.col("nazev_obce")).alias("name")).agg(F.max("nazev_obce").alias("nazev_obce")).where("name != ''")


def part_cities(gazetteer: DataFrame) -> DataFrame:
    """(name, nazev_obce): folded part name to a city that has it; the last one wins."""
    parts = gazetteer.groupBy(fold(F.col("nazev_casti_obce")).alias("name"))
    return parts.agg(F.max("nazev_obce").alias("nazev_obce")).where("name != ''")


def city_parts(gazetteer: DataFrame) -> DataFrame:
    """(city, part, nazev_casti_obce): folded city and part to the part's first spelling."""
    pairs = gazetteer.groupBy(fold(F.col("nazev_obce")).alias("city"), fold(F.col("nazev_casti_obce")).alias("part"))
    return pairs.agg(F.min("nazev_casti_obce").alias("nazev_casti_obce")).where("city != '' AND part != ''")


def city_streets(gazetteer: DataFrame) -> DataFrame:
    """(city, street, nazev_ulice): folded city and street to the street's first spelling."""
    pairs = gazetteer.groupBy(fold(F.col("nazev_obce")).alias("city"), fold(F.col("nazev_ulice")).alias("street"))
    return pairs.agg(F.min("nazev_ulice").alias("nazev_ulice")).where("city != '' AND street != ''")


def first_city_region(gazetteer: DataFrame) -> DataFrame:
    """(name, kraj): folded city name to its first region, ambiguous or not."""
    return gazetteer.groupBy(fold(F.col("nazev_obce")).alias("name")).agg(F.min("kraj").alias("kraj")).where("name != ''")
