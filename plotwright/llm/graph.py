"""Connected components of links, as alternating star contractions over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import ASKED, lookup_join
from ..session import materialized


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark")).first()
    return row["n"], row["mark"]


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node of `links`: the smallest node that links reach from it.

    Each round points the larger neighbors of every node to its smallest one (large star), then
    joins the smaller neighbors of every node (small star); it ends when nothing changes, after
    a number of rounds that grows with the logarithm of the longest path. Rounds are written to
    the shared folder, so none recomputes the ones before; only counts come to the driver.
    """
    pair = links.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    edges = materialized(pair.distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        # A hub has as many rows as neighbors, so its answer does not come through a plain join.
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"), F.count("*").alias(ASKED))
        joined = lookup_join(both, least, ["x"])
        large = joined.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialized(joined.union(root.select("u", "m")).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", "v"))


def settled(classes: DataFrame, found: DataFrame) -> DataFrame:
    """What each class (digest, class, copies) comes to, from partial results (class, root, links) of its comparisons.

    The columns are digest, the number of its rows (as `lookup_join` wants it), class_id, n_links (its
    other copies included) and component_id. Every row of `found` says how many links a comparison
    saw for the class, and one other class that they reach.
    """
    totals = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found, "class", "root")
    joined = classes.join(totals, "class", "left").join(groups, F.col("class") == F.col("node"), "left")
    return joined.select(
        "digest",
        F.col("copies").alias(ASKED),
        F.col("class").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component_id"),
    )
