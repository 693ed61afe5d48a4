"""Address text to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract, or_null, strip

# Patterns of free-form addresses.
DISTRICT = r"(?iU)(okres\s+([^\-,]+))"
CITY_AND_PART = r"(?U)^(.+?)\s*-\s*(.+)"
STREET_AND_NUMBER = r"(?U)^([^\d,]+)\s+(\d+\w*)$"
CAPITAL = "Praha"
EMPTY_ADDRESS = ",,"


def split_address(address: Column) -> Column:
    """struct(street, city_raw, district, city, city_part) of a `street, city, district` text."""
    text = F.coalesce(address, F.lit(EMPTY_ADDRESS))
    pieces = F.split(text, ",")
    town = strip(F.get(pieces, F.lit(1)))
    return F.struct(
        strip(F.get(pieces, F.lit(0))).alias("street"),
        town.alias("city_raw"),
        strip(F.get(pieces, F.lit(2))).alias("district"),
        F.when(F.contains(text, F.lit(CAPITAL)), F.lit(CAPITAL)).otherwise(town).alias("city"),
        strip(F.when(F.contains(town, F.lit("-")), F.get(F.split(town, "-"), F.lit(1)))).alias("city_part"),
    )


def parse_address(address: Column) -> Column:
    """struct(street, city, city_part, district, house_number) of a free-form address."""
    text = strip(address)
    mention = F.regexp_extract(text, DISTRICT, 1)
    rest = F.when(
        mention != "", F.regexp_replace(F.replace(text, mention, F.lit("")), r"^[, ]+|[, ]+$", "")
    ).otherwise(text)
    head = strip(F.get(F.split(rest, ","), F.lit(0)))
    part = extract(head, CITY_AND_PART, 2)
    return F.struct(
        strip(extract(head, STREET_AND_NUMBER, 1)).alias("street"),
        F.when(part.isNotNull(), strip(F.regexp_extract(head, CITY_AND_PART, 1))).otherwise(head).alias("city"),
        strip(part).alias("city_part"),
        or_null(strip(F.regexp_extract(text, DISTRICT, 2))).alias("district"),
        extract(head, STREET_AND_NUMBER, 2).alias("house_number"),
    )
