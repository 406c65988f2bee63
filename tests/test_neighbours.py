from __future__ import annotations

import numpy as np
import pytest

from shelfcast.operators import neighbours, selection


def all_pairs(x: np.ndarray, y: np.ndarray, k: int) -> float:
    """The estimate from every distance."""
    dx, dy = np.abs(x[:, None] - x[None]), np.abs(y[:, None] - y[None])
    both = np.maximum(dx, dy)
    np.fill_diagonal(both, np.inf)
    radius = np.sort(both, axis=1)[:, k - 1 : k]
    psi = lambda m: -np.euler_gamma + sum(1 / i for i in range(1, m))
    inside = [psi(int(a)) + psi(int(b)) for a, b in zip((dx < radius).sum(axis=1), (dy < radius).sum(axis=1))]
    return max(0.0, psi(len(x)) + psi(k) - np.mean(inside))


@pytest.mark.parametrize("k", [1, 3, 5])
@pytest.mark.parametrize("kind", ["smooth", "counts", "flag", "constant", "same"])
def test_estimate_equals_all_pairs(kind, k):
    rng = np.random.default_rng(3)
    y = rng.poisson(2, 200).astype(float)
    x = {
        "smooth": y + rng.normal(size=200),
        "counts": rng.poisson(4, 200) + y,
        "flag": (y > 3).astype(float),
        "constant": np.ones(200),
        "same": y,
    }[kind]
    a, b = neighbours._spread(x, "x"), neighbours._spread(y, "y")
    assert neighbours.estimate(a, b, k) == pytest.approx(all_pairs(a, b, k), abs=1e-12)


def test_normal_pair_comes_near_its_known_information():
    rng = np.random.default_rng(8)
    x = rng.normal(size=4_000)
    y = 0.8 * x + 0.6 * rng.normal(size=4_000)
    found = neighbours.estimate(neighbours._spread(x, "x"), neighbours._spread(y, "y"))
    assert found == pytest.approx(-0.5 * np.log(1 - 0.8**2), abs=0.05)


def test_series_are_scored_apart_whatever_the_order_of_rows(spark):
    rng = np.random.default_rng(4)
    rows = []
    for store in ("a", "b"):
        for i, y in enumerate(rng.poisson(3, 150)):
            noise = float(rng.normal())
            rows.append((store, "x", f"2020-01-{i:03d}", int(y), float(y) + 0.1 * noise, noise, None if i % 2 else float(y)))
    rows += [("c", "x", f"2020-01-{i:03d}", i, 1.0, None, None) for i in range(3)]
    schema = "store_id string, item_id string, date string, sales int, near double, far double, half double"
    df = spark.createDataFrame(rows, schema)
    names = ["near", "far", "half"]
    scores = neighbours.neighbour_information(df, names)
    got = {(r.store_id, r.feature): r.mutual_information for r in scores.collect()}
    again = neighbours.neighbour_information(df.orderBy("sales", "far").repartition(3), names)
    assert {(r.store_id, r.feature): r.mutual_information for r in again.collect()} == got
    pdf = df.toPandas()
    for store in ("a", "b"):
        one = pdf[pdf.store_id == store].sort_values("date")
        for name in names:
            known = one[one[name].notna()]
            x = neighbours._spread(known[name].to_numpy(), f"0:{store}:x:{name}")
            y = neighbours._spread(known.sales.to_numpy(dtype=float), f"0:{store}:x")
            assert got[store, name] == pytest.approx(all_pairs(x, y, 3), abs=1e-12)
        assert got[store, "near"] > got[store, "far"]
    assert all(got["c", name] == 0 for name in names)
    ranks = {(r.store_id, r.feature): r["rank"] for r in selection.rank_features(scores).collect()}
    assert ranks["a", "far"] == 2
    assert not neighbours.neighbour_information(df.limit(0), names).count()
