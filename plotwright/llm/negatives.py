"""Hard-negative mining: length buckets with sorted coordinate lists, cut down by the ranges an anchor's focus coordinates allow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .common import shuffle_partitions

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
# Vectors of a length bucket.
BUCKET = 4096
# Coordinates of an anchor, the largest, whose lists are intersected.
FOCUS = 4
_SLACK = 1e-9


class Bucket:
    """Vectors of similar length and one dimension: whole numbers, their unit vectors, and each coordinate sorted."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.vectors, self.rows, self.ids, self.labels = vectors, rows, ids, labels
        self.floats = vectors.astype(np.float64)
        lengths = np.sqrt((self.floats**2).sum(axis=1))
        self.longest = float(lengths.max())
        unit = self.floats / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, query: np.ndarray, least: int | None) -> np.ndarray:
        """Which vectors can reach the score `least` with `query`; all where nothing can be said.

        A cosine of t = least / (|query| longest) or more leaves an angle of arccos t at most, so coordinate f of a
        unit vector is no further than that angle from the query's own angle to axis f.
        """
        every = np.arange(len(self.ids))
        if least is None or least <= 0:
            return every
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        bound = length * self.longest
        if bound * (1 + _SLACK) < least:
            return every[:0]
        widest = np.arccos(min(1.0, least / bound))
        unit = query / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, angle + widest)) - _SLACK
        high = np.cos(np.maximum(0, angle - widest)) + _SLACK
        met = np.zeros(len(self.ids), np.uint8)
        for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist(), strict=True):
            values = self.sorted[:, f]
            met[self.order[np.searchsorted(values, a) : np.searchsorted(values, b, side="right"), f]] += 1
        return np.flatnonzero(met == len(focus))

    def scores(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles where all sums fit, else in 64-bit numbers."""
        if self.longest * float(np.sqrt((query.astype(np.float64) ** 2).sum())) < 1 << 52:
            return np.rint(self.floats[which] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[which] @ query


def first_of(scores: np.ndarray, ids: np.ndarray, number: int) -> np.ndarray:
    """Places of the `number` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:number]


def bounds(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The scores from `low` to `high` hundredths of `positive`; none (the first above the second) for a negative one."""
    return -(-low * positive // 100), high * positive // 100


def positives_in(bucket: Bucket, row: int, label: int, query: np.ndarray, least: int | None, number: int) -> list[tuple[int, int]]:
    """(id, score) of the first `number` other vectors of the label with a score of `least` or more."""
    which = bucket.candidates(query, least)
    which = which[(bucket.labels[which] == label) & (bucket.rows[which] != row)]
    scores = bucket.scores(query, which)
    if least is not None:
        which, scores = which[scores >= least], scores[scores >= least]
    best = first_of(scores, bucket.ids[which], number)
    return list(zip(bucket.ids[which[best]].tolist(), scores[best].tolist(), strict=True))


def negatives_in(
    bucket: Bucket, label: int, query: np.ndarray, ranges: list[tuple[int, int]], number: int
) -> list[list[tuple[int, int]]]:
    """For each (least, most) the (id, score) of the first `number` vectors of other labels with such a score."""
    which = bucket.candidates(query, min(r[0] for r in ranges))
    which = which[bucket.labels[which] != label]
    scores = bucket.scores(query, which)
    out = []
    for least, most in ranges:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        best = inside[first_of(scores[inside], bucket.ids[which[inside]], number)]
        out.append(list(zip(bucket.ids[which[best]].tolist(), scores[best].tolist(), strict=True)))
    return out


def _by_size(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of one dimension each, with their vectors as a matrix."""
    sizes = pc.list_value_length(table["v"])
    for size in pc.unique(sizes).to_pylist():
        part = table.filter(pc.equal(sizes, size))
        yield part, part["v"].combine_chunks().flatten().to_numpy().reshape(part.num_rows, size)


Answer = Callable[[dict, Bucket, np.ndarray], list[tuple]]


def _searcher(answer: Answer, names: list[str]):
    """Batches sorted by (bucket, kind): a bucket's vectors, then the anchors that come to it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, known = None, [], {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            bucket, kind = table["bucket"].to_numpy(), table["kind"].to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (kind[1:] != kind[:-1]), [True])))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if j == i:
                    continue
                part = table.slice(i, j - i)
                if bucket[i] != at:
                    at, held, known = bucket[i], [], {}
                if kind[i] == 0:
                    held.append(part)
                    continue
                if held:
                    for rows, vectors in _by_size(pa.concat_tables(held)):
                        known[vectors.shape[1]] = Bucket(vectors, rows["row"].to_numpy(), rows["id"].to_numpy(), rows["label"].to_numpy())
                    held = []
                out = []
                for rows, vectors in _by_size(part):
                    if vectors.shape[1] in known:
                        for anchor, query in zip(rows.drop_columns(["v"]).to_pylist(), vectors, strict=True):
                            out += answer(anchor, known[vectors.shape[1]], query)
                if out:
                    columns = zip(names, zip(*out, strict=True), strict=True)
                    yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in columns})

    return search


def _searched(index: DataFrame, anchors: DataFrame, answer: Answer, schema: str) -> DataFrame:
    """`answer` for each (anchor, bucket) of `anchors`; a task holds a bucket and a batch of anchors, never all of them."""
    names = [c.split()[0] for c in schema.split(", ")]
    wanted = [c for c in anchors.columns if c not in ("bucket", "row", "id", "label", "v")]
    sides = index.select("bucket", F.lit(0).alias("kind"), "row", "id", "label", "v"), anchors.withColumn("kind", F.lit(1))
    both = sides[0].unionByName(sides[1].select("bucket", "kind", "row", "id", "label", "v", *wanted), allowMissingColumns=True)
    parts = shuffle_partitions(index.sparkSession)
    return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_searcher(answer, names), schema)


def _spread(anchors: DataFrame, lengths: DataFrame, buckets: int) -> DataFrame:
    """Each anchor once for every bucket long enough for its `least` score."""
    sent = anchors.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).join(lengths, "bucket")
    reaches = F.col("least").isNull() | (F.col("least") <= 0) | (F.col("length") * F.col("longest") * (1 + _SLACK) >= F.col("least"))
    return sent.where(reaches).drop("longest")


def _first(rows: DataFrame, keys: list[str], number: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("other"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    bucket_rows: int = BUCKET,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where `is_anchor` holds.

    Components become floor(scale x); scores are exact inner products of rows of one dimension, higher ones first,
    ties by smaller id. An anchor's positives are its first `positives` other rows of the same label; for each,
    its negatives are the first `negatives` rows of other labels with low positive <= 100 negative <= high positive.
    So positives of a negative score have none.

    Rows with a null id, label, vector or component, or one that is not finite, take no part, nor do those whose scaled
    length is 2^31 or more, as scores would pass 64 bits. Zero and empty vectors score 0. A row that repeats an id is
    another row, as anchor, positive and negative. No anchors or no rows give no result. Other columns may be anything.

    All rows are in the index: sorted by length and cut into buckets of about `bucket_rows`. Each anchor first meets one
    bucket, which gives it a score that its answers must reach, then every bucket that is long enough for that. There
    the largest coordinates of the anchor allow ranges of the bucket's sorted coordinate lists; what lies in all of
    them is scored exactly. A bucket returns a few rows for an anchor, and no pair else leaves it.
    """
    x = F.col(vector_col).cast("array<double>")
    finite = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    scaled = F.transform("x", lambda c: F.floor(c * scale))
    fits = F.aggregate("x", F.lit(0.0), lambda acc, c: acc + (F.abs(c * scale) + 1) * (F.abs(c * scale) + 1)) < float(1 << 62)
    sound = named.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(finite).where(fits)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double")))
    sound = sound.select("id", "label", "anchor", scaled.alias("v")).withColumn("length", length)
    sound = materialized(sound.withColumn("row", F.monotonically_increasing_id()), "vectors")
    buckets = max(1, -(-sound.count() // bucket_rows))
    index = sound.repartitionByRange(buckets, F.size("v"), F.desc("length"), "row").withColumn("bucket", F.spark_partition_id())
    index = materialized(index, "length-buckets")
    lengths = index.groupBy("bucket").agg(F.max("length").alias("longest"))
    buckets = (index.agg(F.max("bucket")).first()[0] or 0) + 1
    anchors = index.where("anchor").select("row", "id", "label", "v", "length")
    one = anchors.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))

    def nearest(anchor: dict, bucket: Bucket, query: np.ndarray) -> list[tuple]:
        found = positives_in(bucket, anchor["row"], anchor["label"], query, anchor["least"], positives)
        return [(anchor["row"], other, score) for other, score in found]

    schema = "row long, other long, score long"
    sample = _searched(index, one.withColumn("least", F.lit(None).cast("long")), nearest, schema)
    least = sample.groupBy("row").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= positives)
    sent = _spread(anchors.join(least.drop("n"), "row", "left"), lengths, buckets)
    best = _first(_searched(index, sent, nearest, schema), ["row"], positives)
    best = materialized(best.select("row", "other", "score"), "positives")

    def harder(anchor: dict, bucket: Bucket, query: np.ndarray) -> list[tuple]:
        least = anchor["floors"] or [None] * len(anchor["wanted"])
        ranges = [bounds(p, low, high) for p in anchor["wanted"]]
        ranges = [(a if f is None else max(a, f), b) for (a, b), f in zip(ranges, least, strict=True)]
        found = negatives_in(bucket, anchor["label"], query, ranges, negatives)
        return [(anchor["row"], p, other, score) for p, some in zip(anchor["wanted"], found, strict=True) for other, score in some]

    schema = "row long, positive long, other long, score long"
    wanted = best.where(F.expr(f"score >= 0 OR {low} >= {high}")).groupBy("row").agg(F.sort_array(F.collect_set("score")).alias("wanted"))
    asking = anchors.join(wanted, "row")
    floors = F.lit(None).cast("array<bigint>")
    seed = _searched(index, asking.join(one.select("row", "bucket"), "row").withColumn("floors", floors), harder, schema)
    known = seed.groupBy("row", "positive").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= negatives)
    known = known.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("positive", "floor"))).alias("known"))
    asking = asking.join(known, "row", "left").withColumn("floors", F.transform("wanted", lambda p: F.try_element_at("known", p)))
    # The lowest score that can still be among the answers, for the lengths.
    lowest = F.array_min(F.transform(F.arrays_zip("wanted", "floors"), lambda z: F.coalesce(z["floors"], F.ceil(z["wanted"] * low / 100) - 1)))
    sent = _spread(asking.withColumn("least", lowest.cast("long")).drop("known"), lengths, buckets)
    hard = _first(_searched(index, sent.drop("least"), harder, schema), ["row", "positive"], negatives)
    pairs = best.select("row", F.col("other").alias("positive_id"), F.col("score").alias("positive"))
    return (
        hard.join(pairs, ["row", "positive"])
        .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
            F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"),
        )
    )
