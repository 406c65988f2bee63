"""One regressor per store-item series, chosen on time-ordered folds.

Fitting is the only place that runs Python: a task receives the rows of one series
(at most one per calendar day) and returns one row of the model table.
"""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.boosting import aligned_trees, tree_score
from shelfcast.operators.folds import FOLDS, TEST_ROWS, fold_bounds
from shelfcast.operators.panel import with_series_id
from shelfcast.schema import SERIES, TARGET

GRID = {"l2": [0.0001, 0.001, 0.01, 0.1, 1.0]}
"""Penalties per row on standardised features."""

MODEL_COLUMNS = (
    "store_id string, item_id string, features array<string>, weights array<double>, "
    "intercept double, l2 double, cv_mae double, rows bigint"
)
SPARSE_COLUMNS = f"{MODEL_COLUMNS}, positions array<bigint>"
"""Of models on a one-hot block: the position of each feature in it, null outside of it."""
SEARCH_COLUMNS = "store_id string, item_id string, l2 double, mean_mae double, folds int, errors array<double>"


def draw_candidates(
    grid: dict[str, list[float]] = GRID, n_iter: int | None = None, seed: int = 0
) -> list[dict[str, float]]:
    """The whole grid, or so many different points drawn from it."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    if n_iter is None or n_iter >= len(points):
        return points
    return random.Random(seed).sample(points, n_iter)


class _Ridge:
    """Ridge fits of the same rows for any penalty, from one decomposition."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.centre, self.mean = x.mean(axis=0), y.mean()
        scale = x.std(axis=0)
        self.scale = np.where(scale > 1e-12, scale, np.inf)
        z = (x - self.centre) / self.scale
        self.values, self.vectors = np.linalg.eigh(z.T @ z / len(y))
        self.turned = self.vectors.T @ (z.T @ (y - self.mean) / len(y))

    def solve(self, l2: float) -> tuple[np.ndarray, float]:
        """Weights on the original scale of x, and the intercept."""
        weights = self.vectors @ (self.turned / (self.values + l2)) / self.scale
        return weights, float(self.mean - self.centre @ weights)


def _solve(x: np.ndarray, y: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    return _Ridge(x, y).solve(l2)


def _search(
    x: np.ndarray, y: np.ndarray, candidates: list[dict[str, float]], folds: int, test_rows: int
) -> list[tuple[float, float, int, list[float]]]:
    """(l2, mean absolute error over the folds, folds used, error of each); x and y in date
    order, folds from the newest."""
    errors: list[list[float]] = [[] for _ in candidates]
    for start, end in fold_bounds(len(y), folds, test_rows):
        fit = _Ridge(x[:start], y[:start])
        for candidate, found in zip(candidates, errors):
            weights, intercept = fit.solve(candidate["l2"])
            found.append(np.abs(x[start:end] @ weights + intercept - y[start:end]).mean())
    return [(c["l2"], float(np.mean(e)) if e else None, len(e), [float(v) for v in e]) for c, e in zip(candidates, errors)]


def _matrix(rows: pd.DataFrame, chosen: pd.DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    rows = rows.sort_values("date")
    chosen = chosen.sort_values("rank")
    names, y = chosen["feature"].tolist(), rows[TARGET].to_numpy(dtype=float)
    if "position" not in chosen:
        return names, rows[names].to_numpy(dtype=float), y
    x = np.zeros((len(rows), len(names)))
    at = chosen["position"].to_numpy(dtype=float)
    named = np.flatnonzero(np.isnan(at))
    x[:, named] = rows[[names[i] for i in named]].to_numpy(dtype=float)
    # Ones go to the places of the chosen positions; the others were not chosen.
    places = np.flatnonzero(~np.isnan(at))
    places = places[np.argsort(at[places])]
    if len(places):
        ones = np.concatenate([np.asarray(block, dtype=float) for block in rows["one_hot"]])
        row = np.repeat(np.arange(len(rows)), rows["one_hot"].map(len))
        found = np.minimum(np.searchsorted(at[places], ones), len(places) - 1)
        known = at[places][found] == ones
        x[row[known], places[found[known]]] = 1.0
    return names, x, y


def _training_rows(encoded: DataFrame, features: list[str]) -> DataFrame:
    block = [c for c in ("one_hot",) if c in encoded.columns]
    return encoded.select(
        *SERIES, "date", TARGET, *block, *[F.col(f).cast("double").alias(f) for f in features]
    )


def search(
    encoded: DataFrame,
    selected: DataFrame,
    features: list[str],
    candidates: list[dict[str, float]] | None = None,
    folds: int = FOLDS,
    test_rows: int = TEST_ROWS,
) -> DataFrame:
    """Fold error of every candidate for every series."""
    tried = candidates or draw_candidates()

    def run(key: tuple, rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or chosen.empty:
            return pd.DataFrame(columns=["store_id", "item_id", "l2", "mean_mae", "folds", "errors"])
        _, x, y = _matrix(rows, chosen)
        results = _search(x, y, tried, folds, test_rows)
        frame = pd.DataFrame(results, columns=["l2", "mean_mae", "folds", "errors"])
        frame.insert(0, "item_id", key[1])
        frame.insert(0, "store_id", key[0])
        return frame

    left = _training_rows(encoded, features).groupBy(*SERIES)
    return left.cogroup(selected.groupBy(*SERIES)).applyInPandas(run, SEARCH_COLUMNS)


def train(
    encoded: DataFrame,
    selected: DataFrame,
    features: list[str],
    candidates: list[dict[str, float]] | None = None,
    folds: int = FOLDS,
    test_rows: int = TEST_ROWS,
) -> DataFrame:
    """The model table: search, then the best candidate refitted on all rows.

    A series too short for a single fold takes the first candidate, with no error. Features
    selected with a `position` are read from the rows' one-hot block, the others by name.
    """
    tried = candidates or draw_candidates()
    schema = SPARSE_COLUMNS if "position" in selected.columns else MODEL_COLUMNS

    def run(key: tuple, rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in schema.split(", ")]
        if rows.empty or chosen.empty:
            return pd.DataFrame(columns=columns)
        names, x, y = _matrix(rows, chosen)
        results = _search(x, y, tried, folds, test_rows)
        l2, mae, *_ = min(results, key=lambda r: (r[1] is None, r[1] or 0.0))
        weights, intercept = _solve(x, y, l2)
        values = [key[0], key[1], names, weights.tolist(), intercept, l2, mae, len(y)]
        if "position" in chosen:
            places = chosen.sort_values("rank")["position"]
            values.append([None if pd.isna(p) else int(p) for p in places])
        return pd.DataFrame([values], columns=columns)

    left = _training_rows(encoded, features).groupBy(*SERIES)
    return left.cogroup(selected.groupBy(*SERIES)).applyInPandas(run, schema)


def aligned_models(models: DataFrame, features: list[str]) -> DataFrame:
    """Weights in one common feature order, zero where a model leaves a feature out."""
    own = F.map_from_arrays("features", "weights")
    names = F.array(*[F.lit(f) for f in features])
    aligned = F.transform(names, lambda n: F.coalesce(F.try_element_at(own, n), F.lit(0.0)))
    found = [F.col("intercept").alias("_intercept"), aligned.alias("_weights")]
    if "positions" in models.columns:
        pairs = F.filter(F.arrays_zip("positions", "weights"), lambda p: p["positions"].isNotNull())
        found.append(F.map_from_entries(pairs).alias("_one_hot"))
    return models.select(*SERIES, *found)


def linear_score(values: list[Column]) -> Column:
    """Intercept plus the weighted values, for a row joined to its aligned model."""
    score = F.col("_intercept")
    for i, value in enumerate(values):
        score = score + value * F.get(F.col("_weights"), F.lit(i))
    return score


def one_hot_score(block: Column) -> Column:
    """The weights of a row's ones, for a row joined to its aligned model."""
    return F.aggregate(block, F.lit(0.0), lambda s, p: s + F.coalesce(F.try_element_at("_one_hot", p), F.lit(0.0)))


def whole_units(score: Column) -> Column:
    """Cut towards zero; the last digits of a sum of fractions do not decide a unit."""
    return F.round(score, 6).cast("int")


def aligned(models: DataFrame, features: list[str]) -> DataFrame:
    """Models of either kind, linear or of trees, in one common feature order."""
    return aligned_trees(models, features) if "trees" in models.columns else aligned_models(models, features)


def predicted(models: DataFrame, values: list[Column], block: Column | None = None) -> Column:
    """What the aligned model next to a row says of its values and one-hot block, in whole units."""
    if "trees" in models.columns:
        return whole_units(tree_score(F.array(*[v.cast("double") for v in values])))
    if "positions" in models.columns:
        return whole_units(linear_score(values) + one_hot_score(block))
    return whole_units(linear_score(values))


def score(encoded: DataFrame, models: DataFrame, features: list[str]) -> DataFrame:
    """Predict every row with the model of its series; null for a series without one."""
    joined = encoded.join(aligned(models, features), SERIES, "left")
    block = F.col("one_hot") if "positions" in models.columns else None
    prediction = predicted(models, [F.col(f) for f in features], block)
    return with_series_id(joined).select(*SERIES, "series_id", "date", TARGET, prediction.alias("prediction"))


def mean_absolute_error(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("prediction").isNotNull()).agg(
        F.avg(F.abs(F.col(TARGET) - F.col("prediction"))).alias("mae"), F.count("*").alias("rows")
    )
