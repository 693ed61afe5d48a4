"""Conforming feeds to the canonical listing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order: cast where present, null where missing."""
    types = dict(df.dtypes)

    def column(field: T.StructField) -> Column:
        wanted = field.dataType.simpleString()
        if field.name not in types:
            return F.lit(None).cast(wanted).alias(field.name)
        value = F.col(f"`{field.name}`")
        if types[field.name] == wanted:
            return value.alias(field.name)
        return (value.cast(wanted) if types[field.name] == "void" else value.try_cast(wanted)).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def stamp(df: DataFrame, source_id: int, today: Column) -> DataFrame:
    """The constant columns of a newly loaded feed."""
    return df.withColumns(
        {
            "source_id": F.lit(source_id),
            "added_date": today,
            "avalaible": F.lit(True),
            "archived_date": F.lit(None).cast("date"),
        }
    )


def with_internal_id(df: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """An id per inserted listing, from what makes the insertion unique.

    That is source, site id and day, or the whole row where it has no site id. Ids that meet
    one another or one of `held` are hashed anew: among 10^10 listings a few 64-bit hashes are equal.
    """
    whole = F.struct(*[c for c in df.columns if c != "internal_id"])
    first = F.when(F.col("site_id").isNull(), F.xxhash64(whole)).otherwise(F.xxhash64("source_id", "site_id", "added_date"))
    named = df.withColumn("internal_id", first)
    taken = named.select("internal_id")
    if held is not None:
        taken = taken.unionAll(held.select(F.col("internal_id").cast("bigint")))
    met = taken.groupBy("internal_id").agg(F.count("*").alias("_n")).where("_n > 1").select("internal_id", F.lit(True).alias("_met"))
    again = F.when(F.col("_met"), F.xxhash64(F.lit("again"), whole)).otherwise(F.col("internal_id"))
    return named.join(met, "internal_id", "left").withColumn("internal_id", again).select(*named.columns)
