"""Mutual information from the distances of nearest neighbours (Kraskov, Stögbauer and
Grassberger, 2004), per series.

Both sides are scaled to unit deviation. The radius of a row is its distance to the k-th
nearest row, the larger of the two sides counting; the rows closer than that on one side
alone tell how much the other side adds. Equal values are parted by a tiny seeded jitter,
which depends on the series, the feature and the row's place in time only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.schema import SERIES, TARGET

NEIGHBOURS = 3
JITTER = 1e-10
FIRST_REACH = 32
PAIRS = 200_000
"""Distances held at once, about."""


def _spread(values: np.ndarray, seed: str) -> np.ndarray:
    """`values` at unit deviation and apart from each other."""
    deviation = values.std()
    scaled = values / deviation if deviation > 1e-12 else values
    noise = np.random.default_rng(zlib.crc32(seed.encode())).standard_normal(len(values))
    return scaled + JITTER * max(1.0, np.abs(scaled).mean()) * noise


def _radii(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Distance of each row to its k-th nearest; `a` is in order.

    A row looks at the places around its own. It is done when the next place to either side
    is, on `a` alone, no nearer than the k-th found; the others look four times as far, and at
    all rows in the end.
    """
    n = len(a)
    radii = np.empty(n)
    rows, reach = np.arange(n), FIRST_REACH
    while len(rows) and 2 * reach < n:
        edge = np.full(reach + 1, np.inf)
        along = sliding_window_view(np.concatenate([-edge, a, edge]), 2 * reach + 3)
        across = sliding_window_view(np.pad(b, reach + 1), 2 * reach + 3)
        left = []
        for part in np.array_split(rows, -(-2 * len(rows) * reach // PAIRS)):
            apart = np.abs(along[part] - a[part, None])
            distance = np.maximum(apart, np.abs(across[part] - b[part, None]))[:, 1:-1]
            distance[:, reach] = np.inf  # the row itself
            radii[part] = np.partition(distance, k - 1, axis=1)[:, k - 1]
            left.append(part[np.minimum(apart[:, 0], apart[:, -1]) < radii[part]])
        rows, reach = np.concatenate(left), 4 * reach
    for part in np.array_split(rows, max(1, -(-len(rows) * n // PAIRS))):
        distance = np.maximum(np.abs(a - a[part, None]), np.abs(b - b[part, None]))
        distance[np.arange(len(part)), part] = np.inf
        radii[part] = np.partition(distance, k - 1, axis=1)[:, k - 1]
    return radii


def _closer(a: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """How many rows of `a` are closer than the radius of each, itself included."""
    order = np.sort(a)
    low = np.searchsorted(order, a - radii, "left")
    high = np.searchsorted(order, a + radii, "right") - 1
    # The sums above are rounded; the distances themselves decide at both ends.
    while (off := a - order[low] >= radii).any():
        low = low + off
    while (off := (low > 0) & (a - order[np.maximum(low - 1, 0)] < radii)).any():
        low = low - off
    while (off := order[high] - a >= radii).any():
        high = high - off
    last = len(order) - 1
    while (off := (high < last) & (order[np.minimum(high + 1, last)] - a < radii)).any():
        high = high + off
    return high - low + 1


def estimate(x: np.ndarray, y: np.ndarray, k: int = NEIGHBOURS) -> float:
    """Mutual information of two columns without equal values; zero for k rows or fewer."""
    n = len(x)
    if n <= k:
        return 0.0
    # Few distinct values lie far apart or together: the sweep ends sooner along the other side.
    wide = len(np.unique(x.round(6))) >= len(np.unique(y.round(6)))
    a, b = (x, y) if wide else (y, x)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    radii = _radii(a, b, k)
    # The digamma function of whole numbers, but for a constant that cancels.
    digamma = np.concatenate([[0.0, 0.0], np.cumsum(1 / np.arange(1, n))])
    inside = digamma[_closer(a, radii)] + digamma[_closer(b, radii)]
    return max(0.0, float(digamma[n] + digamma[k] - inside.mean()))


def neighbour_information(
    df: DataFrame,
    features: list[str],
    target: str = TARGET,
    k: int = NEIGHBOURS,
    seed: int = 0,
    keys: list[str] = SERIES,
) -> DataFrame:
    """Mutual information of each feature with the target, per series.

    A task holds one series at a time, of one row per day; rows already spread by series do
    not move. Rows that lack the target or the feature are left out for that feature; a series
    of `k` rows or fewer, and an empty table, tell nothing (zero, and no rows). Days that
    repeat are told apart by their target and features.
    """
    types = [df.schema[key] for key in keys]
    columns = [*types, T.StructField("feature", T.StringType()), T.StructField("mutual_information", T.DoubleType())]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["date", target, *features], kind="stable")
        series = f"{seed}:{':'.join(map(str, key))}"
        y = rows[target].to_numpy(dtype=float)
        scores = []
        for feature in features:
            x = rows[feature].to_numpy(dtype=float)
            known = ~(np.isnan(x) | np.isnan(y))
            spread = _spread(x[known], f"{series}:{feature}"), _spread(y[known], series)
            scores.append((*key, feature, estimate(*spread, k)))
        return pd.DataFrame(scores, columns=[c.name for c in columns])

    numbers = [F.col(c).cast("double").alias(c) for c in (target, *features)]
    return df.select(*keys, "date", *numbers).groupBy(*keys).applyInPandas(run, T.StructType(columns))
