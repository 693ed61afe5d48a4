"""Near-duplicate signatures by exact banded joins.

Two signatures at most k bits apart are, cut into m bands, close in at least one band:
with k = q*m + r, either one of r + 1 bands differs by at most q bits or one of the
others by at most q - 1. Rows meet on (band, value), where both sides list values a
few flips away so that their flips together cover the band's radius. No pair is lost,
and the Hamming test runs inside the join, so only true pairs leave it, each once.

Where even the best cut files a signature under so many keys, or lets so many meet by chance, that testing all
pairs is cheaper (a low similarity, bits that are far from even), the signatures are dealt into blocks and each
pair of blocks is tested in one task, word by word over whole columns. Both ways find the same pairs.

Copies are folded first: the join sees each signature once, however many rows share it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb, isqrt, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.bits import BUCKET_BITS, bits, bucket, distance, hex_digits, max_distance, neighbor_buckets, words
from ..session import materialized, spread

MAX_BAND = 32
# Signatures that may share one band value before that value is split over several tasks.
HOT_BUCKET = 10_000
# Signatures of a block at most and, unless there are fewer, at least.
BLOCK, SMALL_BLOCK = 65_536, 512
# A shuffled row costs about so many tests in a join; blocks test so many words in the time of one.
ROW_TESTS, WORDS_A_TEST = 20, 128
# Blocks that a block is typically paired with, for the choice between blocks and bands.
TYPICAL_BLOCKS = 28
# Columns tested at a time, pairs handed on at a time, words tested before the pairs still close are picked.
TILE, BATCH, DENSE_WORDS = 8_192, 50_000, 3
# Signatures by which it is judged how evenly bits are spread.
JUDGED = 1_000


def signature_groups(images: DataFrame, key: str, signature: str) -> DataFrame:
    """(signature, first_key, n_keys): each signature once, with the listings that carry it counted."""
    pairs = images.select(signature, key).where(F.col(signature).isNotNull()).distinct()
    return pairs.groupBy(F.col(signature).alias("signature")).agg(
        F.min(key).alias("first_key"), F.count("*").alias("n_keys")
    )


def _bands(n_bits: int, m: int, k: int) -> list[tuple[int, int, int]]:
    """(start, width, radius) of each band that has to be probed."""
    q, r = divmod(k, m)
    out, start = [], 0
    for i in range(m):
        width = n_bits // m + (1 if i < n_bits % m else 0)
        radius = min(width, q if i <= r else q - 1)
        out.append((start, width, radius))
        start += width
    return out


def _reach(radius: int, left: bool) -> int:
    """The flips each side lists; together they cover the radius."""
    return (radius + 1) // 2 if left else radius // 2


def _keys(width: int, flips: int) -> int:
    return sum(comb(width, i) for i in range(flips + 1))


def band_plan(
    n_bits: int, k: int, n_signatures: float, left_copies: int = 1, evenness: float = 1.0
) -> list[tuple[int, int, int]]:
    """The cut into bands with the least keys and expected chance meetings among signatures that may meet.

    The left side is listed `left_copies` times, as for buckets around its own. `evenness` is what a bit tells,
    1 if signatures are random.
    """
    fewest = -(-n_bits // MAX_BAND)
    most = max(fewest, min(k + 1, n_bits))
    plans = (_bands(n_bits, m, k) for m in range(fewest, most + 1))
    return min(plans, key=lambda plan: _band_cost(plan, n_signatures, left_copies, evenness))


def _band_cost(plan: list[tuple[int, int, int]], n_signatures: float, left_copies: int = 1, evenness: float = 1.0) -> float:
    """Tests that a signature costs."""
    sides = [(w, _keys(w, _reach(r, True)), _keys(w, _reach(r, False))) for _, w, r in plan]
    keys = sum(left_copies * left + right for _, left, right in sides)
    meetings = sum(left_copies * left * right / 2 ** (w * evenness) for w, left, right in sides)
    # A key is shuffled, a meeting only tested.
    return ROW_TESTS * keys + n_signatures * meetings


def blocks_are_cheaper(
    n_bits: int, plan: list[tuple[int, int, int]], n_signatures: float, n_tested: float, left_copies: int = 1, evenness: float = 1.0
) -> bool:
    """Whether testing a signature against `n_tested` others in blocks costs less than the bands' keys and meetings."""
    blocks = ROW_TESTS * TYPICAL_BLOCKS + n_tested * -(-n_bits // 64) / WORDS_A_TEST
    return blocks < _band_cost(plan, n_signatures, left_copies, evenness)


def _evenness(signatures: DataFrame, n_bits: int) -> float:
    """What a bit tells, from how often two of some signatures have the same digit; it steers speed only."""
    some = signatures.where("signature IS NOT NULL").orderBy(F.xxhash64("signature")).limit(JUDGED)
    texts = [r[0] for r in some.select(hex_digits(F.col("signature"), n_bits)).collect()]
    if len(texts) < 2:
        return 1.0
    pairs = len(texts) * (len(texts) - 1)
    equal = [sum(c * (c - 1) for c in Counter(digits).values()) / pairs for digits in zip(*texts, strict=True)]
    return min(1.0, sum(-log2(max(e, 1 / 16)) / 4 for e in equal) / len(equal))


def _flips(plan: list[tuple[int, int, int]], left: bool) -> Column:
    """Constant array of (band, flip): the bit masks one side applies to each band."""
    masks = [
        (band, sum(1 << i for i in c))
        for band, (_, width, radius) in enumerate(plan)
        for n in range(_reach(radius, left) + 1)
        for c in combinations(range(width), n)
    ]
    return F.expr(f"array({', '.join(f'struct({band} AS band, {mask}L AS flip)' for band, mask in masks)})")


def _entries(known: DataFrame, plan: list[tuple[int, int, int]], left: bool) -> DataFrame:
    """One row per (band, value) under which a signature is filed."""
    probed = known.withColumn("_f", F.explode(_flips(plan, left)))
    value = F.get("_b", F.col("_f.band")).bitwiseXOR(F.col("_f.flip"))
    return probed.select("signature", "_w", "_b", "bucket", F.col("_f.band").alias("band"), value.alias("value"))


def _crowds(known: DataFrame, plan: list[tuple[int, int, int]], hot_bucket: int) -> DataFrame:
    """(bucket, band, value, _salts): values under which far more signatures are filed than one task should hold."""
    filed = known.select("bucket", F.posexplode("_b").alias("band", "value"))
    own = filed.groupBy("bucket", "band", "value").agg(F.count("*").alias("_n"))
    hot = own.where(F.col("_n") > hot_bucket).withColumn("_f", F.explode(_flips(plan, False))).where("_f.band = band")
    around = hot.select("bucket", "band", F.col("value").bitwiseXOR(F.col("_f.flip")).alias("value"), "_n")
    total = around.groupBy("bucket", "band", "value").agg(F.sum("_n").alias("_n"))
    return total.select("bucket", "band", "value", F.ceil(F.col("_n") / hot_bucket).cast("int").alias("_salts"))


def near_pairs(
    signatures: DataFrame, n_bits: int, similarity: float, expected: int | None = None, hot_bucket: int = HOT_BUCKET,
    bucket_bits: int = 0,
) -> DataFrame:
    """(left, right, distance, similarity): all pairs of distinct hex signatures that reach the similarity.

    `signatures` has a column `signature`, unique; left < right. `expected` is their number where the
    cut into bands shall be that for another; it steers speed only. With `bucket_bits`, only
    signatures whose buckets (of so many leading bits) differ by one bit at most are pairs: the
    bucket is then part of the key, so it prunes before the join, and the cut into
    bands is the one for the signatures of a bucket.

    In a join by bands a pair can meet in several bands and, through flips, at several values of a band.
    It is taken at one of them alone: in its first close band, at the value reached by
    the fewest and lowest flips of the left side. So no duplicates arise to be removed.
    """
    k = max_distance(n_bits, similarity)
    signatures = materialized(signatures.select("signature"), "signatures")
    held = signatures.count()
    near, copies = (expected or held) / 2**bucket_bits, 1 + bucket_bits
    plan = band_plan(n_bits, k, near, copies)
    tested = near * copies / 2
    if not blocks_are_cheaper(n_bits, plan, near, tested, copies) and held > JUDGED:
        evenness = _evenness(signatures, n_bits)
        plan = band_plan(n_bits, k, near, copies, evenness)
        in_blocks = blocks_are_cheaper(n_bits, plan, near, tested, copies, evenness)
    else:
        in_blocks = blocks_are_cheaper(n_bits, plan, near, tested, copies)
    if in_blocks:
        return _compared(signatures, n_bits, k, held, bucket_bits)
    return _joined(signatures, n_bits, k, held, plan, hot_bucket, bucket_bits)


def _joined(
    signatures: DataFrame, n_bits: int, k: int, held: int, plan: list[tuple[int, int, int]], hot_bucket: int = HOT_BUCKET,
    bucket_bits: int = 0,
) -> DataFrame:
    """The pairs by the banded join."""
    known = _known(signatures, n_bits, plan, bucket_bits)
    left = _entries(known, plan, True).withColumn("bucket", F.explode(neighbor_buckets(F.col("bucket"), bucket_bits)))
    right = _entries(known, plan, False)
    on = ["bucket", "band", "value"]
    # No more signatures than the table has can gather under a value.
    crowds = materialized(_crowds(known, plan, hot_bucket), "crowds") if held > hot_bucket else None
    if crowds is not None and not crowds.isEmpty():
        salts = F.coalesce("_salts", F.lit(1))
        left = left.join(crowds, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        right = right.join(crowds, on, "left").withColumn(
            "_salt", F.pmod(F.xxhash64("signature"), salts).cast("int")
        )
        on = [*on, "_salt"]
    return _met(left, right, on, plan, n_bits, k, F.col("left") < F.col("right"))


def _block_count(df: DataFrame, held: int, largest: int, block: int) -> int:
    """Blocks for `largest` of `held` signatures: small enough for all tasks to have some pairs of blocks."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(block, max(SMALL_BLOCK, -(-held // isqrt(4 * tasks))))
    return max(1, -(-largest // size))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("signature"), F.lit(blocks)).cast("int")


def _worded(signatures: DataFrame, n_bits: int) -> DataFrame:
    """Signatures that are not null with their words, as many as there are in one column each."""
    own = signatures.where("signature IS NOT NULL").select("*", words(F.col("signature"), n_bits).alias("_w"))
    return own.select(*signatures.columns, *[F.get("_w", F.lit(i)).alias(f"_w{i}") for i in range(-(-n_bits // 64))])


def _compared(signatures: DataFrame, n_bits: int, k: int, held: int, bucket_bits: int = 0, block: int = BLOCK) -> DataFrame:
    """The pairs by testing block against block: a signature goes to every pair of blocks that its own is part of.

    With `bucket_bits`, blocks lie within a bucket, and only those of buckets one bit apart at most are paired.
    """
    own = bucket(bits(F.col("signature"), n_bits), bucket_bits) if bucket_bits else F.lit(0)
    rows = spread(signatures, "signature").withColumn("bucket", own)
    largest = (rows.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0) if bucket_bits else held
    blocks = _block_count(signatures, held, largest, block)
    buckets = neighbor_buckets(F.col("bucket"), bucket_bits)
    others = F.flatten(F.transform(buckets, lambda b: F.sequence(b * blocks, b * blocks + (blocks - 1))))
    mine = F.col("bucket") * blocks + _block(blocks)
    dealt = _worded(rows, n_bits).withColumns({"_mine": mine, "_other": F.explode(others)})
    low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    dealt = dealt.withColumns({"_low": low, "_high": high, "_late": F.col("_mine") > F.col("_other")})
    number = blocks * (blocks + 1) // 2 if not bucket_bits else 2**bucket_bits * (1 + bucket_bits) * blocks**2
    return _tested(dealt.drop("bucket", "_mine", "_other"), n_bits, k, number)


def compared_across(left: DataFrame, right: DataFrame, n_bits: int, k: int, block: int = BLOCK) -> DataFrame:
    """(left, right, distance, similarity), left < right: pairs of a signature of one table with one of the other, by blocks."""
    n_left, n_right = left.count(), right.count()
    a, b = (_block_count(left, n_left + n_right, n, block) for n in (n_left, n_right))
    one = _worded(spread(left.select("signature"), "signature"), n_bits).withColumns(
        {"_low": _block(a), "_high": F.explode(F.sequence(F.lit(a), F.lit(a + b - 1))), "_late": F.lit(False)}
    )
    two = _worded(spread(right.select("signature"), "signature"), n_bits).withColumns(
        {"_low": F.explode(F.sequence(F.lit(0), F.lit(a - 1))), "_high": _block(b) + F.lit(a), "_late": F.lit(True)}
    )
    return _tested(one.unionByName(two), n_bits, k, a * b)


def _tested(dealt: DataFrame, n_bits: int, k: int, number: int) -> DataFrame:
    """The near pairs of signatures dealt to `number` pairs of blocks, (_low, _high); `_late` are those of the higher block."""
    tasks = min(number, 2 * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = dealt.repartition(tasks, "_low", "_high").groupBy("_low", "_high")
    met = groups.applyInArrow(_tester(-(-n_bits // 64), k), "a string, b string, distance int").where("a != b")
    pairs = met.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "distance")
    return pairs.withColumn("similarity", 1 - F.col("distance") / F.lit(n_bits))


def _close(others: np.ndarray, one: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the columns of `others` at most k bits from `one`; rows are words."""
    apart = np.bitwise_count(others[0] ^ one[0])
    for i in range(1, min(len(one), DENSE_WORDS)):
        apart += np.bitwise_count(others[i] ^ one[i])
    at = np.flatnonzero(apart <= k)
    far = apart[at].astype(np.int32)
    for i in range(DENSE_WORDS, len(one)):
        if len(at):
            far += np.bitwise_count(others[i, at] ^ one[i])
    near = far <= k
    return at[near], far[near]


def _tester(n_words: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All pairs at most k bits apart between two blocks, or within one; a task holds these two and a batch of pairs."""

    def matrix(rows: pa.Table) -> np.ndarray:
        return np.stack([rows[f"_w{i}"].to_numpy().view(np.uint64) for i in range(n_words)])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches)).combine_chunks()
        within = group["_low"][0] == group["_high"][0]
        first = group.filter(pc.invert(group["_late"]))
        second = first if within else group.filter(group["_late"])
        if not first.num_rows or not second.num_rows:
            return
        a, b = matrix(first), matrix(second)

        def pairs(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ones = np.repeat([i for i, _, _ in found], [len(at) for _, at, _ in found])
            others, far = (np.concatenate([f[n] for f in found]) for n in (1, 2))
            texts = first["signature"].take(pa.array(ones)), second["signature"].take(pa.array(others))
            columns = [t.combine_chunks() for t in texts]
            return pa.RecordBatch.from_arrays([*columns, pa.array(far, pa.int32())], ["a", "b", "distance"])

        found, held = [], 0
        for start in range(0, b.shape[1], TILE):
            tile = np.ascontiguousarray(b[:, start : start + TILE])
            for i in range(a.shape[1]):
                # Within a block each two meet once.
                skip = max(0, i + 1 - start) if within else 0
                if skip >= tile.shape[1]:
                    break
                at, far = _close(tile[:, skip:], a[:, i], k)
                if len(at):
                    found.append((i, at + (start + skip), far))
                    held += len(at)
                if held >= BATCH:
                    yield pairs(found)
                    found, held = [], 0
        if found:
            yield pairs(found)

    return test


def _known(signatures: DataFrame, n_bits: int, plan: list[tuple[int, int, int]], bucket_bits: int = 0) -> DataFrame:
    """Signatures with their words, the values of their bands and their bucket."""
    text = bits(F.col("signature"), n_bits)
    bands = F.array(*[F.conv(F.substring("_bits", s + 1, w), 2, 10).cast("bigint") for s, w, _ in plan])
    known = spread(signatures, "signature").select(
        "signature", words(F.col("signature"), n_bits).alias("_w"), text.alias("_bits")
    )
    own = bucket(F.col("_bits"), bucket_bits) if bucket_bits else F.lit(0)
    return known.select("signature", "_w", bands.alias("_b"), own.alias("bucket"))


def _met(
    left: DataFrame, right: DataFrame, on: list[str], plan: list[tuple[int, int, int]], n_bits: int, k: int, wanted: Column
) -> DataFrame:
    """(left, right, distance, similarity) of the wanted pairs of filed entries, each at its one meeting point."""
    a = left.select(F.col("signature").alias("left"), F.col("_w").alias("_lw"), F.col("_b").alias("_lb"), *on)
    b = right.select(F.col("signature").alias("right"), F.col("_w").alias("_rw"), F.col("_b").alias("_rb"), *on)
    total = distance(F.col("_lw"), F.col("_rw"), n_bits)

    def far_before(band: int, radius: int) -> Column:
        """True unless the pair is close in this band and meets in a later one."""
        apart = F.bit_count(F.get("_lb", F.lit(band)).bitwiseXOR(F.get("_rb", F.lit(band))))
        return (F.col("band") <= band) | (apart > radius)

    mine = F.get("_lb", F.col("band")).bitwiseXOR(F.col("value"))
    theirs = F.get("_rb", F.col("band")).bitwiseXOR(F.col("value"))
    right_reach = F.get(F.expr(f"array({', '.join(str(_reach(r, False)) for _, _, r in plan)})"), F.col("band"))
    fewest = F.bit_count(mine) == F.greatest(F.lit(0), F.bit_count(mine) + F.bit_count(theirs) - right_reach)
    lowest = (mine == 0) | (theirs == 0) | (mine < theirs.bitwiseAND(-theirs))
    one_value = (mine.bitwiseAND(theirs) == 0) & lowest & fewest
    taken = (total <= k) & wanted & one_value
    for band, (_, _, radius) in enumerate(plan[:-1]):
        taken = taken & far_before(band, radius)
    # Sizes are guessed from the table before its rows were multiplied, so no side may be broadcast.
    pairs = a.hint("merge").join(b, on).where(taken).select("left", "right", total.alias("distance"))
    return pairs.withColumn("similarity", 1 - F.col("distance") / F.lit(n_bits))


def lsh_pairs(
    signatures: DataFrame, n_bits: int, similarity: float, bucket_bits: int = BUCKET_BITS, hot_bucket: int = HOT_BUCKET
) -> DataFrame:
    """Directed pairs that reach the similarity and whose buckets differ by at most one bit."""
    return both_ways(near_pairs(signatures, n_bits, similarity, None, hot_bucket, bucket_bits))


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair in both directions, from one pass over the pairs."""
    turned = F.array(
        F.struct(F.col("left").alias("a"), F.col("right").alias("b")),
        F.struct(F.col("right").alias("a"), F.col("left").alias("b")),
    )
    rest = [c for c in pairs.columns if c not in ("left", "right")]
    return pairs.select(F.explode(turned).alias("_d"), *rest).select(
        F.col("_d.a").alias("left"), F.col("_d.b").alias("right"), *rest
    )


def nearest(images: DataFrame, key: str, signature: str, n_bits: int, similarity: float, k: int) -> DataFrame:
    """(key, neighbor, distance): the k nearest other listings of each listing within the similarity.

    Equal distances go by neighbor key. Of a signature's carriers only the k + 1 first
    can be among anyone's k nearest, so no group of copies is ever paired in full.
    """
    carriers = images.select(F.col(key).alias("key"), F.col(signature).alias("signature")).dropna().distinct()
    carriers = materialized(carriers, "carriers")
    first = Window.partitionBy("signature").orderBy("key")
    heads = carriers.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
    heads = heads.select(F.col("signature").alias("right"), F.col("key").alias("neighbor"))
    groups = carriers.select("signature").distinct()
    pairs = both_ways(near_pairs(groups, n_bits, similarity)).select("left", "right", "distance")
    own = groups.select(F.col("signature").alias("left"), F.col("signature").alias("right"), F.lit(0).alias("distance"))
    # k + 1 candidates per signature, so that one is left over for the carrier itself.
    reach = pairs.unionByName(own).join(heads, "right").groupBy("left", "neighbor").agg(F.min("distance").alias("distance"))
    by_nearness = Window.partitionBy("left").orderBy("distance", "neighbor")
    reach = reach.withColumn("_r", F.row_number().over(by_nearness)).where(F.col("_r") <= k + 1).drop("_r")
    found = carriers.join(reach, carriers["signature"] == reach["left"]).where(F.col("key") != F.col("neighbor"))
    # A listing with several signatures can reach a neighbor more than once.
    once = found.groupBy("key", "neighbor").agg(F.min("distance").alias("distance"))
    ranked = Window.partitionBy("key").orderBy("distance", "neighbor")
    return once.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
