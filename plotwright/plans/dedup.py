"""Stage 4: duplicates among listings by the signatures of their photos."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.bits import SIGNATURE_BITS, SIMILARITY
from ..operators.duplicates import adjacency, duplicate_counts, duplicate_statistics, hash_maps
from ..operators.neighbors import near_pairs, signature_groups
from ..session import materialized


@dataclass
class Duplicates:
    """`pairs` relates signatures; `groups` says how many listings carry each of them."""

    groups: DataFrame
    pairs: DataFrame
    adjacency: DataFrame
    counts: DataFrame
    statistics: DataFrame
    hashes: DataFrame


def find_duplicates(images: DataFrame, n_bits: int = SIGNATURE_BITS, similarity: float = SIMILARITY) -> Duplicates:
    """`images` has internal_id, source, pos and signature (hex).

    The pairs are written once, as three results start from them.
    """
    groups = signature_groups(images, "internal_id", "signature")
    pairs = materialized(near_pairs(groups.select("signature"), n_bits, similarity), "near-pairs")
    return Duplicates(
        groups,
        pairs,
        adjacency(pairs),
        duplicate_counts(images, "internal_id", "signature", pairs),
        duplicate_statistics(pairs),
        hash_maps(images, "internal_id"),
    )
