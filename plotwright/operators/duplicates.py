"""What near pairs say about listings: adjacency, statistics, stored hashes, report."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialized, spread
from .lookup import ASKED, distinct_keys, lookup_join
from .neighbors import both_ways, signature_groups

# Entries per stored list. Longer lists continue on further pages.
PAGE = 1000
# Rows of each kind (signatures within reach, carriers) that a pair of blocks of listings holds.
BLOCK = 524_288
# Duplicates expected for each row sent to another block, where listings are cut into more blocks for more tasks.
PAIRS_A_ROW = 32
# Duplicates handed on at a time; places of duplicates kept for signatures that come again.
BATCH, KEPT = 100_000, 16_000_000
# Bytes of entries that a report may broadcast, and what a row takes besides its values.
BROADCAST_BYTES, ROW_BYTES = 96 * 2**20, 64
# What a row of blocks is: a wanted listing's signature, a pair of near signatures, a carrier.
WANTED, EDGE, CARRIER = 0, 1, 2


def listing_groups(images: DataFrame, key: str, signature: str) -> DataFrame:
    """(key, signature): which listing carries which signature."""
    return images.select(F.col(key).alias("key"), F.col(signature).alias("signature")).dropna().distinct()


def adjacency(pairs: DataFrame, page: int = PAGE) -> DataFrame:
    """(id, page, n_neighbors, neighbors): neighbors of every id of `pairs`, both ways.

    A neighbor list is spread over pages of about `page` entries, so an id with very
    many neighbors is never gathered in one row; the pages together hold all of them.
    """
    edges = materialized(both_ways(pairs.select("left", "right")).distinct(), "edges")
    sizes = distinct_keys(edges, ["left"]).withColumn("n_neighbors", F.col(ASKED))
    pages = F.ceil(F.col("n_neighbors") / page).cast("bigint")
    placed = lookup_join(edges, sizes, ["left"]).withColumn("page", F.pmod(F.xxhash64("right"), pages))
    lists = placed.groupBy(F.col("left").alias("id"), "page", "n_neighbors").agg(
        F.sort_array(F.collect_list("right")).alias("neighbors")
    )
    return lists.select("id", "page", "n_neighbors", "neighbors")


def duplicate_counts(images: DataFrame, key: str, signature: str, pairs: DataFrame) -> DataFrame:
    """(signature, first_key, n_keys, n_copies, n_near): per signature, the listings equal and near to it.

    The listings behind a signature are counted, not paired.
    """
    groups = materialized(signature_groups(images, key, signature), "groups")
    edges = materialized(both_ways(pairs.select("left", "right")), "edges")
    sizes = distinct_keys(edges, ["right"]).join(
        groups.select(F.col("signature").alias("right"), F.col("n_keys").alias("_carriers")), "right"
    )
    reach = lookup_join(edges, sizes, ["right"]).groupBy("left").agg(F.sum("_carriers").alias("n_near"))
    return groups.join(reach, groups["signature"] == reach["left"], "left").select(
        "signature",
        "first_key",
        "n_keys",
        (F.col("n_keys") - 1).alias("n_copies"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def duplicates_of(wanted: DataFrame, images: DataFrame, key: str, signature: str, pairs: DataFrame) -> DataFrame:
    """(key, duplicate): the other listings that share a signature with, or are near to, the wanted listings.

    `wanted` has one column named `key` and bounds the result: nothing else is expanded. Where listings have
    many duplicates each, wanted listings and carriers are dealt into blocks and a pair of blocks is expanded in
    one task, so that no duplicate passes a shuffle; else signatures are joined. Both ways find the same rows.
    """
    carriers = materialized(listing_groups(images, key, signature), "carriers")
    mine = carriers.join(wanted.select("key").distinct(), "key").withColumnRenamed("signature", "left")
    mine, edges = materialized(mine, "wanted"), materialized(both_ways(pairs.select("left", "right")), "edges")
    held, (reach, expected) = carriers.count(), _expected(mine, edges, carriers)
    tasks = int(carriers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-reach // BLOCK), min(2 * tasks, expected // (PAIRS_A_ROW * max(held, 1))), 1)
    of_carriers = max(-(-held // BLOCK), 1)
    if reach * of_carriers + held * blocks < expected:
        return _expanded(mine, edges, carriers, blocks, of_carriers)
    return _reached(mine, edges, carriers)


def _expected(mine: DataFrame, edges: DataFrame, carriers: DataFrame) -> tuple[int, int]:
    """Signatures within reach of the wanted listings, and these signatures' carriers, counted for each listing anew."""
    groups = carriers.groupBy("signature").agg(F.count("*").alias("_n"))
    near = edges.join(groups, edges["right"] == groups["signature"]).groupBy("left")
    near = near.agg(F.count("*").alias("_edges"), F.sum("_n").alias("_near"))
    asked = mine.groupBy("left").agg(F.count("*").alias("_asked"))
    lefts = asked.join(groups.withColumnRenamed("signature", "left"), "left").join(near, "left", "left")
    reach, pairs = 1 + F.coalesce("_edges", F.lit(0)), F.col("_n") + F.coalesce("_near", F.lit(0))
    row = lefts.agg(F.sum(F.col("_asked") * reach), F.sum(F.col("_asked") * pairs)).first()
    return row[0] or 0, row[1] or 0


def _reached(mine: DataFrame, edges: DataFrame, carriers: DataFrame) -> DataFrame:
    """(key, duplicate) by joining each signature within reach with its carriers."""
    near = mine.join(edges, "left").select("key", F.col("right").alias("signature"))
    same = mine.select("key", F.col("left").alias("signature"))
    reach = near.unionByName(same).distinct()
    others = carriers.withColumnRenamed("key", "duplicate")
    return reach.join(others, "signature").where(F.col("key") != F.col("duplicate")).select("key", "duplicate").distinct()


def _expanded(mine: DataFrame, edges: DataFrame, carriers: DataFrame, blocks: int, of_carriers: int) -> DataFrame:
    """(key, duplicate) by blocks of wanted listings, which get the edges of their signatures, and blocks of carriers.

    All signatures of a listing are in its block, so what a pair of blocks finds no other finds.
    """
    key_type = carriers.schema["key"].dataType

    def dealt(rows: DataFrame, block: Column, of: Column, kind: int, id: Column, signature: str, other: Column) -> DataFrame:
        pair = (block * of_carriers + of).cast("int").alias("_pair")
        return rows.select(pair, F.lit(kind).alias("_kind"), id.cast(key_type).alias("id"), F.col(signature).alias("signature"), other.cast("string").alias("other"))

    def place(n: int) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")

    def every(rows: DataFrame, name: str, n: int) -> DataFrame:
        return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    none, at = F.lit(None), (F.col("_block"), F.col("_of"))
    mine = mine.withColumn("_block", place(blocks))
    near = spread(mine.select("_block", "left").distinct(), "left").join(edges, "left")
    carried = every(spread(carriers, "key"), "_block", blocks).withColumn("_of", place(of_carriers))
    rows = dealt(every(mine, "_of", of_carriers), *at, WANTED, F.col("key"), "left", none)
    rows = rows.unionByName(dealt(every(near, "_of", of_carriers), *at, EDGE, none, "left", F.col("right")))
    rows = rows.unionByName(dealt(carried, *at, CARRIER, F.col("key"), "signature", none))
    found = T.StructType([T.StructField("key", key_type), T.StructField("duplicates", T.ArrayType(key_type))])
    tasks = min(blocks * of_carriers, 2 * int(mine.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lists = rows.repartitionById(tasks, F.col("_pair")).groupBy("_pair").applyInArrow(_expand, found)
    return lists.select("key", F.explode("duplicates").alias("duplicate"))


def _by(codes: np.ndarray, values: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """The values of some codes, one after the other."""
    ordered, ends = values[np.argsort(codes, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=n))])

    def of(some: np.ndarray) -> np.ndarray:
        starts, sizes = ends[some], ends[some + 1] - ends[some]
        after = np.cumsum(sizes)
        return ordered[np.repeat(starts - after + sizes, sizes) + np.arange(after[-1])]

    return of


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The duplicates that a block of wanted listings has in a block of carriers, in lists of at most `PAGE`, a batch of them held at a time."""
    group = pa.Table.from_batches(list(batches))
    wanted, edges, carried = (group.filter(pc.equal(group["_kind"], kind)) for kind in (WANTED, EDGE, CARRIER))
    if not wanted.num_rows or not carried.num_rows:
        return

    def coded(*columns: pa.ChunkedArray) -> tuple[pa.Array, list[np.ndarray]]:
        """The distinct values, and each column as places among them."""
        chunks = [c.combine_chunks() for c in columns]
        all_of = pa.concat_arrays([a for c in chunks for a in (c.chunks if isinstance(c, pa.ChunkedArray) else [c])]).dictionary_encode()
        return all_of.dictionary, np.split(all_of.indices.to_numpy(), np.cumsum([len(c) for c in columns])[:-1])

    ids, (keys, duplicates) = coded(wanted["id"], carried["id"])
    texts, (lefts, own, near, signatures) = coded(wanted["signature"], edges["signature"], edges["other"], carried["signature"])
    signatures_of, near_to = _by(keys, lefts, len(ids)), _by(own, near, len(texts))
    carriers_of = _by(signatures, duplicates, len(texts))
    kept: dict[int, np.ndarray] = {}
    n_kept = 0

    def once(places: np.ndarray) -> np.ndarray:
        places.sort()
        return places[np.append(True, places[1:] != places[:-1])] if len(places) else places

    def within_reach(left: int) -> np.ndarray:
        nonlocal n_kept
        if left not in kept:
            if n_kept > KEPT:
                kept.clear()
                n_kept = 0
            kept[left] = once(carriers_of(np.append(near_to(np.array([left])), left)))
            n_kept += len(kept[left])
        return kept[left]

    def lists(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        ends = np.append(0, np.cumsum([len(at) for _, at in found])).astype(np.int32)
        some = pa.ListArray.from_arrays(pa.array(ends), ids.take(pa.array(np.concatenate([at for _, at in found]))))
        return pa.RecordBatch.from_arrays([ids.take(pa.array([k for k, _ in found])), some], ["key", "duplicates"])

    found, held = [], 0
    for k in range(int(keys.max()) + 1):
        parts = [within_reach(left) for left in signatures_of(np.array([k])).tolist()]
        places = parts[0] if len(parts) == 1 else once(np.concatenate(parts))
        places = places[places != k]
        for start in range(0, len(places), PAGE):
            found.append((k, places[start : start + PAGE]))
            held += len(found[-1][1])
            if held >= BATCH:
                yield lists(found)
                found, held = [], 0
    if found:
        yield lists(found)


def duplicate_statistics(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("total"), F.avg("similarity").alias("avg_similarity"))


def hash_maps(images: DataFrame, key: str, page: int = PAGE) -> DataFrame:
    """(key, source, page, hashes): position to signature, per listing and source.

    `images` has key, source, pos and signature. Positions are paged, so a listing with
    very many images does not end in one row.
    """
    placed = images.withColumn("page", F.expr(f"pos div {page}"))
    once = placed.groupBy(key, "source", "page", "pos").agg(F.min("signature").alias("signature"))
    return once.groupBy(key, "source", "page").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("pos", "signature")))).alias("hashes")
    )


def _fits(table: DataFrame) -> bool:
    """Whether a broadcast may hold the table."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    held = table.agg(F.sum(reduce(lambda a, b: a + b, sizes, F.lit(ROW_BYTES)))).first()[0]
    return (held or 0) <= BROADCAST_BYTES


def duplicate_report(entries: DataFrame, duplicates: DataFrame, key: str, details: list[str], limit: int | None = None) -> DataFrame:
    """One row per duplicate of the entries that have any, or of the first `limit` of them, with both sides' details.

    A duplicate that is no longer held stays, as `found` = false. Duplicates can be many times the entries, so
    these are broadcast, and no duplicate passes a shuffle, as long as they fit the bound for that.
    """
    counts = duplicates.groupBy("key").agg(F.count("*").alias("n_duplicates"))
    shown = counts if limit is None else counts.orderBy("key").limit(limit)
    own = entries.select(F.col(key).alias("key"), *[F.col(d).alias(f"own_{d}") for d in details])
    other = entries.select(
        F.col(key).alias("duplicate"), *[F.col(d).alias(f"duplicate_{d}") for d in details], F.lit(True).alias("_found")
    )
    own, other = materialized(shown.join(own, "key"), "shown"), materialized(other, "entries")
    own, other = (F.broadcast(t) if _fits(t) else t for t in (own, other))
    out = duplicates.join(own, "key").join(other, "duplicate", "left")
    return out.withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")
