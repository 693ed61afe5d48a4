"""Embedding near-dedup: random projections decoded to E8 lattice points, neighbor cells probed, cosines verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from math import ceil, fsum, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..session import materialized
from .common import by_group
from .graph import settled

THRESHOLD = 0.98
# At cosine 0.98 one lattice point brings a pair together with probability 0.967 (0.98 at 0.985); there are as many tables
# as let all of them miss it with MISS at most: four for one point, five for two.
TOGETHER = 0.967
MISS = 2e-6
PROBES = 2
# Cells per unit of projected length: narrower cells hold fewer strangers and miss more neighbors.
WIDTH = 1.5
# Likely cells of one lattice point, and vectors of a label that a cell should hold at most, on average.
LIKELY_CELLS = 10_000
CELL = 1000
BLOCK = 256
PAIRS = 20_000
SEED = 11


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minuses."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


SHORTEST = _shortest()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum: round, and where the sum is odd move the worst entry the other way."""
    near = np.rint(x)
    rest = x - near
    worst = np.abs(rest).argmax(axis=1)
    row = np.arange(len(x))
    odd = near.sum(axis=1) % 2 != 0
    near[row, worst] += np.where(odd, np.where(rest[row, worst] >= 0, 1, -1), 0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point to each row: of the even whole points and those shifted by 1/2."""
    whole = _nearest_even(x)
    half = _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cells(vectors: np.ndarray, labels: list[int], tables: int, probes: int, width: float, projections: int) -> np.ndarray:
    """For each unit vector tables x (1 + probes) hashes: its own cell in each table, and the nearest cells around it.

    Cells of different labels, lengths or tables never meet. Probing moves one of a cell's lattice points at a time.
    """
    rng = np.random.default_rng([SEED, vectors.shape[1]])
    length = np.int64(vectors.shape[1]).tobytes()
    out = np.zeros((len(vectors), tables * (1 + probes)), np.int64)
    for t in range(tables):
        points, gains = [], []
        for _ in range(projections):
            x = vectors @ rng.standard_normal((vectors.shape[1], 8)) / width + rng.uniform(0, 1, 8)
            point = nearest_point(x)
            points.append((2 * point).astype(np.int32))
            gains.append((x - point) @ SHORTEST.T)
        own = np.concatenate(points, axis=1)
        best = np.argsort(-np.concatenate(gains, axis=1), axis=1, kind="stable")[:, :probes]
        for p in range(1 + probes):
            cell = own.copy()
            if p:
                which, move = np.divmod(best[:, p - 1], len(SHORTEST))
                columns = which[:, None] * 8 + np.arange(8)
                cell[np.arange(len(cell))[:, None], columns] += (2 * SHORTEST[move]).astype(np.int32)
            for i, label in enumerate(labels):
                key = xxhash.xxh64_intdigest(length + cell[i].tobytes(), seed=(label * 1009 + t) % (1 << 63))
                out[i, t * (1 + probes) + p] = key - (1 << 63)
    return out


def settings(crowd: int) -> tuple[int, int]:
    """(projections, tables) for `crowd` vectors of one label: lattice points that make a cell, and tables to keep the recall."""
    projections = 1
    while crowd > CELL * LIKELY_CELLS**projections:
        projections += 1
    return projections, ceil(log(MISS) / log(1 - TOGETHER**projections))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; first by the largest entry, as squares of very large or small ones leave the doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _coder(tables: int, probes: int, width: float, projections: int):
    @F.arrow_udf("array<bigint>")
    def code(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for vectors, labels in batches:
            rows, names = vectors.to_pylist(), labels.to_pylist()
            out: list[list[int] | None] = [None] * len(rows)
            by_size: dict[int, list[int]] = {}
            for i, row in enumerate(rows):
                by_size.setdefault(len(row), []).append(i)
            for group in by_size.values():
                x = _unit(np.array([rows[i] for i in group], np.float64))
                found = cells(x, [names[i] for i in group], tables, probes, width, projections)
                for i, f in zip(group, found.tolist(), strict=True):
                    out[i] = f
            yield pa.array(out, pa.list_(pa.int64()))

    return code


def _linker(threshold: float):
    def link(table: pa.Table) -> pa.Table | None:
        group, key, low, high, block = (table[c].to_numpy() for c in ("g", "key", "low", "high", "block"))
        ids, copies = table["class"].to_numpy(), table["copies"].to_numpy()
        links = np.zeros(len(ids), np.int64)
        parent = np.arange(len(ids))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        vectors, codes = table["vector"], table["codes"]
        for first, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if stop - first < 2:
                continue
            x = _unit(np.array(vectors.slice(first, stop - first).to_pylist(), np.float64))
            code = np.array(codes.slice(first, stop - first).to_pylist(), np.int64)
            a, b = np.nonzero(np.triu(x @ x.T >= threshold - 1e-9, 1))
            p, q = a + first, b + first
            here = (key[p] == key[q]) & (low[p] == low[q]) & (high[p] == high[q]) & ((low[p] == high[p]) | (block[p] != block[q]))
            a, b = a[here], b[here]
            for at in range(0, len(a), PAIRS):
                i, j = a[at : at + PAIRS], b[at : at + PAIRS]
                # A pair counts in the smallest cell that both went to, and nowhere else.
                shared = (code[i][:, :, None] == code[j][:, None, :]).any(axis=2)
                smallest = np.where(shared, code[i], np.iinfo(np.int64).max).min(axis=1) == key[first + i]
                cosine = np.einsum("ij,ij->i", x[i], x[j])
                for k in np.flatnonzero(smallest & (np.abs(cosine - threshold) < 1e-9)):
                    cosine[k] = fsum(x[i[k]] * x[j[k]])
                linked = np.flatnonzero(smallest & (cosine >= threshold))
                i, j = i[linked] + first, j[linked] + first
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for m, n in zip(i.tolist(), j.tolist(), strict=True):
                    r, s = root(m), root(n)
                    if ids[r] <= ids[s]:
                        parent[s] = r
                    else:
                        parent[r] = s
        linked = np.flatnonzero(links)
        roots = ids[[root(i) for i in linked.tolist()]] if len(linked) else np.zeros(0, np.int64)
        return pa.table({"class": pa.array(ids[linked], pa.int64()), "root": pa.array(roots, pa.int64()), "links": pa.array(links[linked])})

    return link


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tables: int | None = None,
    probes: int = PROBES,
    width: float = WIDTH,
    projections: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """(`id_col`, n_links, component_id, kept) for each row.

    Two vectors of one (whole, not null) label and one length are linked if the index brings them
    together and their cosine in double precision is at least `threshold`. `n_links` counts the other
    vectors linked directly, `component_id` is the smallest id that links reach, `kept` holds for that
    one. Vectors that are null, empty, zero, or hold nulls or non-finite numbers, and those without a
    label, are alone; a row without an id takes no part (null, 0 links, kept). A row repeated with its id
    counts as another vector. Other columns are not looked at.

    `projections` and `tables` follow from the largest label's number of distinct vectors (`settings`) unless given.
    Equal vectors are one member with a count. The members of a cell are compared in blocks of about
    `block`; no pair leaves a comparison, only link counts and one edge for each member. Every vector
    is in the index, nothing is capped.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    keyed = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.col(label_col).cast("long").alias("label"))
    digest = F.unhex(F.sha2(F.concat_ws(",", F.col("label"), F.transform("vector", lambda x: x.cast("string"))).cast("binary"), 256))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(usable, F.lit(False))
    marked = keyed.withColumn("digest", F.when(sound, digest))
    classes = (
        marked.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("class"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"), F.any_value("label").alias("label"))
    )
    crowd = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0 if None in (tables, projections) else 0
    derived = settings(crowd)
    projections = projections or derived[0]
    tables = tables or derived[1]
    code = _coder(tables, probes, width, projections)(F.col("vector"), F.col("label"))
    classes = materialized(classes.withColumn("codes", code), "vectors")

    entries = classes.select("class", "copies", "digest", F.explode(F.array_distinct("codes")).alias("key"))
    crowds = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    met = entries.join(crowds.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    met = met.select(F.xxhash64("key", low, high).alias("g"), "key", low.alias("low"), high.alias("high"), "block", "class", "copies", "digest")
    full = met.join(classes.select("digest", "vector", "codes").hint("merge"), "digest").drop("digest")
    found = by_group(full, "g", _linker(threshold), "class long, root long, links long", rows=4000)

    answer = settled(classes, materialized(found, "vector-links"))
    out = lookup_join(marked.select("id", "digest"), answer, ["digest"], F.col("digest").isNotNull())
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
