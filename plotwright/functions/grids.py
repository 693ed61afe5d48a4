"""Bit signatures of gray grids: array<double>, row by row, `side` values per row."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the signature function inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Default signature kind and its side in bits.
DEFAULT_KIND = "phash"
HASH_SIDE = 16


KINDS = ("ahash", "dhash", "phash", "whash")


def _means(side: int, parts: int) -> np.ndarray:
    """parts x side: the mean of each of `parts` equal stretches of a row; shared cells count by their share."""
    edges = np.arange(parts + 1) * side / parts
    cells = np.arange(side)
    overlap = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
    return np.maximum(overlap, 0) * parts / side


def _cosines(side: int, kept: int) -> np.ndarray:
    x, u = np.arange(side), np.arange(kept)[:, None]
    return 2 * np.cos(np.pi * u * (2 * x + 1) / (2 * side))


def _flags(pixels: np.ndarray, side: int, hash_side: int, kind: str) -> np.ndarray:
    """hash_side x hash_side bits of every grid."""
    if kind == "dhash":
        small = _means(side, hash_side) @ pixels @ _means(side, hash_side + 1).T
        return (small[:, :, 1:] > small[:, :, :-1]).reshape(len(pixels), -1)
    basis = _cosines(side, hash_side) if kind == "phash" else _means(side, hash_side)
    bands = (basis @ pixels @ basis.T).reshape(len(pixels), -1)
    level = bands.mean(axis=1, keepdims=True) if kind == "ahash" else np.median(bands, axis=1, keepdims=True)
    return bands > level


def grid_signature(grid: Column, side: int, hash_side: int = HASH_SIDE, kind: str = DEFAULT_KIND) -> Column:
    """Bit text of hash_side x hash_side bits; null for a null grid.

    `ahash`: where a block mean is above their mean; `dhash`: where it is above its left neighbor, in
    hash_side + 1 columns of blocks; `whash`: where the low-pass wavelet band (a block mean) is above
    the median; `phash`: where a low-frequency cosine coefficient is above the median.

    Two matrix products per Arrow batch: as nested array functions this would cost up to
    side^2 * hash_side^2 interpreted steps per row.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    if kind != "phash" and kind != "dhash" and side % hash_side:
        raise ValueError("hash_side must divide the grid side")

    @F.pandas_udf(T.StringType())
    def signature(grids: pd.Series) -> pd.Series:
        present = grids.notna()
        out = pd.Series([None] * len(grids), index=grids.index, dtype=object)
        if not present.any():
            return out
        pixels = np.stack(grids[present].to_list()).reshape(-1, side, side)
        text = np.where(_flags(pixels, side, hash_side, kind), "1", "0")
        out[present] = ["".join(row) for row in text]
        return out

    return signature(grid.cast("array<double>"))
