"""N-gram Jaccard self-join: MinHash values compared step by step, hopeless pairs dropped early, the rest verified."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..session import materialized
from .common import by_group, words_of
from .graph import settled

WIDTH = 5
THRESHOLD = 0.8
# A pair of similarity THRESHOLD shares none of the bands with probability (1 - 0.8**4)**24 = 3e-6.
BANDS = 24
ROWS = 4
HASHES = 128
STEP = 16
# A pair is dropped once its probability of reaching the threshold is below this.
TOLERANCE = 1e-6
# Members of a bucket that are compared in one group; larger buckets are split into pairs of blocks.
BLOCK = 256
PAIRS = 200_000

_FACTORS = np.random.default_rng(20240229).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word n-grams; a text of fewer words, but not none, is one."""
    numbers: dict[bytes, int] = {}
    docs = []
    for text in texts:
        words = words_of(text)
        docs.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    out = []
    for doc in docs:
        size = min(width, len(doc))
        if not size:
            out.append(np.zeros(0, np.uint64))
            continue
        word = hashes[doc]
        rolled = np.full(len(doc) - size + 1, size, np.uint64)
        for i in range(size):
            rolled = _mixed(rolled + word[i : len(doc) - size + 1 + i])
        out.append(np.unique(rolled))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of the least values under HASHES multiplicative permutations."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (_FACTORS[:, None] * shingles[None, at : at + 4096]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For STEP, 2 STEP, ... compared values, the fewest matches with which a pair goes on.

    From a uniform prior, the similarity after m matches in n values is Beta(m + 1, n - m + 1);
    its chance to reach t equals that of at most m successes in n + 1 trials of probability t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance and m < n:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def candidates(table: pa.Table, signs: np.ndarray, least: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of `table` (whole groups) that stay after the comparison of MinHash values.

    A pair belongs to the first band whose values both share, and there to the one group of its
    two blocks, so it comes once at most.
    """
    group = table["g"].to_numpy()
    low, high, band, block = (table[c].to_numpy() for c in ("low", "high", "band", "block"))
    size = len(group)
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.repeat(np.append(begins[1:], size), np.diff(np.append(begins, size)))
    partners = ends - np.arange(size) - 1
    totals = np.cumsum(partners)
    done = 0
    while done < size:
        stop = max(done + 1, int(np.searchsorted(totals, (totals[done - 1] if done else 0) + PAIRS, side="right")))
        counts = partners[done:stop]
        a = np.repeat(np.arange(done, stop), counts)
        b = a + 1 + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        done = stop
        here = (band[a] == band[b]) & (low[a] == low[b]) & (high[a] == high[b]) & ((low[a] == high[a]) | (block[a] != block[b]))
        a, b = a[here], b[here]
        matches = np.zeros(len(a), np.int64)
        for step, fewest in enumerate(least):
            # The last values first: the first ones also made the bands.
            part = slice(HASHES - (step + 1) * STEP, HASHES - step * STEP)
            matches += (signs[a, part] == signs[b, part]).sum(axis=1)
            stay = matches >= fewest
            a, b, matches = a[stay], b[stay], matches[stay]
        shared = (signs[a, : BANDS * ROWS] == signs[b, : BANDS * ROWS]).reshape(-1, BANDS, ROWS).all(axis=2)
        first = shared.argmax(axis=1) == band[a]
        if first.any():
            yield a[first], b[first]


def _sketcher(width: int):
    @F.arrow_udf("digest binary, sign binary")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            digests, signs = [], []
            for at in range(0, len(texts), 2000):
                for shingles in shingle_sets(texts[at : at + 2000].to_pylist(), width):
                    digests.append(xxhash.xxh128_digest(shingles.tobytes()) if len(shingles) else None)
                    signs.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], ["digest", "sign"])

    return sketch


def _bands(sign: Column) -> Column:
    size = 4 * ROWS
    return F.array(*[F.xxhash64(F.lit(k), F.substring(sign, k * size + 1, size)) for k in range(BANDS)])


def _meetings(classes: DataFrame, block: int) -> DataFrame:
    """(g, low, high, band, block, class, copies) of classes that meet others in a bucket, once for each group they compare in."""
    bands = classes.select("class", "copies", "digest", F.posexplode(_bands(F.col("sign"))).alias("band", "key"))
    crowds = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    met = bands.join(crowds.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    other = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return other.select(
        F.xxhash64("key", low, high).alias("g"), low.alias("low"), high.alias("high"), "band", "block", "class", "copies", "digest"
    )


def _chooser(least: list[int]):
    def choose(table: pa.Table) -> pa.Table | None:
        signs = np.frombuffer(b"".join(table["sign"].to_pylist()), np.uint32).reshape(-1, HASHES)
        stays = np.zeros(table.num_rows, bool)
        for a, b in candidates(table, signs, least):
            stays[a] = stays[b] = True
        return table.filter(pa.array(stays)).drop_columns(["sign"])

    return choose


def _verifier(least: list[int], width: int, threshold: float):
    def verify(table: pa.Table) -> pa.Table | None:
        sets = shingle_sets(table["text"].to_pylist(), width)
        # An id can stand for several texts; only the one with the digest of the class is meant.
        right = [len(s) > 0 and xxhash.xxh128_digest(s.tobytes()) == d for s, d in zip(sets, table["digest"].to_pylist(), strict=True)]
        names = list(zip(table["g"].to_pylist(), table["class"].to_pylist(), table["digest"].to_pylist(), strict=True))
        seen: set[tuple] = set()
        for i, name in enumerate(names):
            right[i] = right[i] and name not in seen
            if right[i]:
                seen.add(name)
        table = table.filter(pa.array(right, pa.bool_()))
        sets = [s for s, r in zip(sets, right, strict=True) if r]
        if len(sets) < 2:
            return None
        signs = np.stack([signature(s) for s in sets])
        ids, copies = table["class"].to_pylist(), table["copies"].to_pylist()
        parent = list(range(len(ids)))
        links = [0] * len(ids)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for left, other in candidates(table, signs, least):
            for a, b in zip(left.tolist(), other.tolist(), strict=True):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if both < threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    continue
                links[a] += copies[b]
                links[b] += copies[a]
                x, y = root(a), root(b)
                if ids[x] <= ids[y]:
                    parent[y] = x
                else:
                    parent[x] = y
        linked = [i for i, n in enumerate(links) if n]
        return pa.table(
            {
                "class": pa.array([ids[i] for i in linked], pa.int64()),
                "root": pa.array([ids[root(i)] for i in linked], pa.int64()),
                "links": pa.array([links[i] for i in linked], pa.int64()),
            }
        )

    return verify


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """(`id_col`, class_id, n_links, component_id, kept) for each row of `docs`.

    Texts are sets of `width` consecutive words (digits, a-z and characters beyond ASCII, A-Z in
    lower case); a text with fewer words, but not none, is one such set. Documents with the same set
    are a class, named by its smallest id. Two classes are linked if the Jaccard similarity of
    their sets is at least `threshold`. `n_links` counts the other documents a document equals or
    is linked to, `component_id` is the smallest id that links reach, `kept` holds for that one.

    Null and empty texts, and those without words, are alone. A row without an id takes no part:
    nulls, 0 links, kept. Ids are whole numbers; a row repeated with its id counts as a copy, and
    its copies are kept or not alike. An id with several texts stands in each of their classes.
    Other columns are not looked at.

    Classes are compared where they share one of BANDS bands of ROWS MinHash values, in blocks of
    about `block`, and no pair leaves a comparison: what moves on are the members that still have a
    partner, then link counts and one edge for each member. Nothing is capped: the chance to
    lose a pair of exactly `threshold` is about 3e-6 by the bands and `tolerance` a step.
    """
    least = least_matches(threshold, tolerance)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketch = _sketcher(width)(F.col("text"))
    sketches = materialized(keyed.withColumn("s", sketch).select("id", "s.digest", "s.sign"), "sketches")
    known = sketches.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = materialized(
        known.groupBy("digest").agg(F.min("id").alias("class"), F.count("*").alias("copies"), F.any_value("sign").alias("sign")),
        "classes",
    )
    met = _meetings(classes, block).join(classes.select("digest", "sign").hint("merge"), "digest")
    columns = "g long, low int, high int, band int, block int, class long, copies long, digest binary"
    names = [c.split()[0] for c in columns.split(", ")]
    chosen = by_group(met.select(*names, "sign"), "g", _chooser(least), columns)
    chosen = materialized(chosen, "partners")
    texts = keyed.join(chosen.hint("merge"), F.col("id") == F.col("class")).select(*names, "text")
    found = by_group(texts, "g", _verifier(least, width, threshold), "class long, root long, links long", rows=3000)
    found = materialized(found, "links")

    answer = settled(classes.select("digest", "class", "copies"), found)
    rows = lookup_join(sketches.select("id", "digest"), answer, ["digest"], F.col("id").isNotNull() & F.col("digest").isNotNull())
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: float) -> DataFrame:
    """`docs` without the documents that are linked, over any number of steps, to one of a smaller id.

    All columns stay as they are. Rows that repeat an id are kept or dropped together; rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, **settings)
    gone = found.where("NOT kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), F.col(id_col) == F.col("__gone"), "left_anti")
