"""String scores for pairs that a join has already brought together.

Both scores are 200 * LCS / (len a + len b). Spark has no longest-common-subsequence
function, so a batch of pairs is scored at once as numpy matrices.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the scorers inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


CELLS = 1_000_000


def _codes(texts: list[str], width: int) -> np.ndarray:
    """One row of code points per text, zero-filled to the width."""
    padded = "".join(t.ljust(width, "\0") for t in texts)
    return np.frombuffer(padded.encode("utf-32-le"), dtype=np.uint32).reshape(len(texts), width)


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    if not left:
        return np.zeros(0, dtype=np.int64)
    a = _codes(left, max(1, max(map(len, left))))
    b = _codes(right, max(1, max(map(len, right))))
    b = np.where(b == 0, np.uint32(0xFFFFFFFF), b)
    best = np.zeros((len(left), b.shape[1] + 1), dtype=np.int32)
    for i in range(a.shape[1]):
        diagonal = np.where(b == a[:, i : i + 1], best[:, :-1] + 1, best[:, 1:])
        best[:, 1:] = np.maximum.accumulate(diagonal, axis=1)
    return best[:, -1].astype(np.int64)


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Ratio of each pair; pairs of like length share a matrix of at most CELLS values."""
    short = [min(x, y, key=len) for x, y in zip(left, right)]
    long = [max(y, x, key=len) for x, y in zip(left, right)]
    widths = np.fromiter(map(len, long), dtype=np.int64, count=len(long))
    totals = widths + np.fromiter(map(len, short), dtype=np.int64, count=len(short))
    order = np.argsort(widths, kind="stable")
    out = np.full(len(left), 100.0)
    end = len(order)
    while end > 0:
        start = max(0, end - max(1, CELLS // max(1, int(widths[order[end - 1]]))))
        rows = order[start:end]
        matched = lcs_lengths([short[i] for i in rows], [long[i] for i in rows])
        out[rows] = np.where(totals[rows] == 0, 100.0, 200.0 * matched / np.maximum(totals[rows], 1))
        end = start
    return out


def windows(text: str, width: int) -> list[str]:
    """Every window of the width, and the shorter ones at both edges."""
    inner = [text[i : i + width] for i in range(len(text) - width + 1)]
    edges = [text[:i] for i in range(1, width)] + [text[-i:] for i in range(1, width)]
    return inner + edges


def _window_pairs(x: str, y: str) -> list[tuple[str, str]]:
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    pairs = [(short, w) for w in dict.fromkeys(windows(long, len(short)))]
    if len(x) == len(y):
        pairs += [(long, w) for w in dict.fromkeys(windows(short, len(short)))]
    return pairs


def partial_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Best ratio of the shorter text against the windows of the longer one."""
    out = np.zeros(len(left))
    owners, shorts, cuts = [], [], []
    for i, (x, y) in enumerate(zip(left, right)):
        if not x or not y:
            out[i] = 100.0 if x == y else 0.0
            continue
        for short, cut in _window_pairs(x, y):
            owners.append(i)
            shorts.append(short)
            cuts.append(cut)
        if len(owners) >= 200_000:
            np.maximum.at(out, np.array(owners), ratios(shorts, cuts))
            owners, shorts, cuts = [], [], []
    if owners:
        np.maximum.at(out, np.array(owners), ratios(shorts, cuts))
    return out


def _scored(score, left: pd.Series, right: pd.Series) -> pd.Series:
    present = left.notna() & right.notna()
    out = pd.Series(np.nan, index=left.index)
    out[present] = score(left[present].tolist(), right[present].tolist())
    return out


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(ratios, left, right)


@F.pandas_udf(T.DoubleType())
def indel_partial_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(partial_ratios, left, right)


def register(spark: SparkSession) -> None:
    """Make both scores callable from SQL."""
    spark.udf.register("indel_ratio", indel_ratio)
    spark.udf.register("indel_partial_ratio", indel_partial_ratio)
