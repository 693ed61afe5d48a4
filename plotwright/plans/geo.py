"""Stage 3: region, city, part and street of the geo layer."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cascade import ADDRESS, assign_cities, assign_city_parts, assign_regions, assign_streets, quarantine
from ..operators.lookup import ASKED, distinct_keys, lookup_join
from ..schemas import GEO_COLUMNS
from ..session import materialized
from ..sources import merge

STEPS = ["region_step", "city_step", "street_step"]
KEYS = [*GEO_COLUMNS, *ADDRESS, "name"]
ANSWERS = [*[f"_new_{c}" for c in GEO_COLUMNS], *STEPS, "_lost"]
DIGEST = "place_digest"
# Part of a cache's name; to be raised where a rung changes what it answers.
RULES = 1
# A run that finds more deltas in its cache merges them into the base first.
MOST_DELTAS = 8


def _answers(places: DataFrame, gazetteer: DataFrame, exceptions: DataFrame | None) -> DataFrame:
    """Every distinct place with what the four steps make of it, by its values before them."""
    kept = places.withColumns({f"_was_{c}": F.col(c) for c in GEO_COLUMNS})
    regions = materialized(assign_regions(kept, gazetteer, exceptions), "geo-regions")
    known, lost = quarantine(regions)
    cities = materialized(assign_cities(known, gazetteer), "geo-cities")
    parts = materialized(assign_city_parts(cities, gazetteer), "geo-parts")
    done = assign_streets(parts, gazetteer).withColumn("_lost", F.lit(False))
    both = done.unionByName(lost.withColumn("_lost", F.lit(True)), allowMissingColumns=True)
    return both.select(
        *[F.col(f"_was_{c}").alias(c) for c in GEO_COLUMNS],
        *ADDRESS,
        "name",
        F.col("_rows").alias(ASKED),
        *[F.col(c).alias(f"_new_{c}") for c in GEO_COLUMNS],
        *STEPS,
        "_lost",
    )


def normalize(
    listings: DataFrame, gazetteer: DataFrame, exceptions: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(normalized listings, quarantined listings).

    City needs the region and street needs the city, so the steps form a chain. It runs over the distinct
    places (address, title and what is already known), a table of a few narrow columns that is written
    between the steps; the listings are read for their places, and once more to be answered.
    """
    places = materialized(distinct_keys(listings, KEYS).withColumnRenamed(ASKED, "_rows"), "places")
    return _answered(listings, materialized(_answers(places, gazetteer, exceptions), "place-answers"))


def _answered(listings: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    base = [c for c in listings.columns if c not in GEO_COLUMNS]
    out = lookup_join(listings, answers, KEYS)
    done = out.where(~F.col("_lost")).select(*base, *[F.col(f"_new_{c}").alias(c) for c in GEO_COLUMNS], *STEPS)
    return done, out.where(F.col("_lost")).select(*listings.columns)


def place_digest() -> Column:
    """What a place's answer is kept by: 128 bits of its address, title and known values; a null is not an empty text."""
    return F.unhex(F.md5(F.to_json(F.struct(*KEYS), {"ignoreNullFields": "false"})))


def gazetteer_version(gazetteer: DataFrame, exceptions: DataFrame | None = None) -> str:
    """A name for what answers follow from: the rows looked up, in any order, and the rungs' rules."""

    def rows(df: DataFrame) -> list:
        whole = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
        sums = [F.sum(F.xxhash64(F.lit(seed), whole).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
        return list(df.agg(F.count("*"), *sums).first())

    parts = [RULES, rows(gazetteer), None if exceptions is None else rows(exceptions)]
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


@dataclass
class Normalized:
    """Normalized and quarantined listings, and how many distinct places climbed the rungs or were known."""

    done: DataFrame
    garbage: DataFrame
    asked: int
    known: int


def normalize_cached(
    listings: DataFrame, gazetteer: DataFrame, cache: str, exceptions: DataFrame | None = None
) -> Normalized:
    """`normalize`, asking only for places that no run before has asked for under the same gazetteer.

    `cache` is a folder with one keyed table for each version of the gazetteer. It holds digests and answers, not
    places. New answers are added as one delta, so a run writes as much as is new; a place without any answer is
    kept as such. Answers are filed before the listings are joined, so a run that dies later need not ask again.
    Of two runs that file at once the second fails (`AlreadyCommitted`) and may be repeated.
    """
    spark = listings.sparkSession
    path = f"{cache}/{gazetteer_version(gazetteer, exceptions)}"
    places = materialized(distinct_keys(listings, KEYS).withColumn(DIGEST, place_digest()), "places")
    deltas = merge.delta_count(spark, path)
    if deltas is not None and deltas > MOST_DELTAS:
        merge.compact(spark, path)
    stored = None if deltas is None else merge.read_merged(spark, path)
    unseen = places if stored is None else places.join(stored.select(DIGEST), DIGEST, "left_anti")
    unseen = materialized(unseen.withColumnRenamed(ASKED, "_rows").drop(DIGEST), "unseen-places")
    asked, total = unseen.count(), places.count()
    found = None
    if asked:
        found = materialized(_answers(unseen, gazetteer, exceptions), "place-answers")
        filed = found.select(place_digest().alias(DIGEST), *ANSWERS)
        if stored is None:
            merge.create_merged(filed, path, [DIGEST])
        else:
            merge.upsert_rows(filed, path)
    answers = found
    if stored is not None:
        known = places.join(stored, DIGEST).select(*KEYS, ASKED, *ANSWERS)
        answers = known if found is None else known.unionByName(found)
        answers = materialized(answers, "all-answers")
    if answers is None:  # no listings, and no run before
        answers = _answers(unseen, gazetteer, exceptions)
    done, garbage = _answered(listings, answers)
    return Normalized(done, garbage, asked, total - asked)
