from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from shelfcast.operators import boosting
from shelfcast.operators.boosting import UNIT, Boost, Task
from shelfcast.session import stage_by_series

START = date(2014, 9, 1)
SERIES = [("CA_1", "I1"), ("CA_2", "I1"), ("CA_1", "I2")]
FEATURES = ["a", "b", "c"]


def made(days=70):
    rng = np.random.default_rng(3)
    rows = []
    for s, (store, item) in enumerate(SERIES):
        for i in range(days):
            a, b, c = int(rng.integers(0, 30)), float(rng.normal()), int(rng.integers(0, 2))
            rows.append((store, item, START + timedelta(days=i), int(a // 5 + 4 * c + (s + 1) * (b > 0)), a, b, c))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(made(), "store_id string, item_id string, date date, sales int, a int, b double, c int").repartition(3)


def binned(x, bins=boosting.BINS):
    n = len(x)
    edges = [np.unique(np.sort(col)[[-(-i * n // bins) - 1 for i in range(1, bins)]]) for col in x.T]
    return edges, np.array([[sum(e < v for e in edges[f]) for f, v in enumerate(row)] for row in x])


def plain(x_bins, y, boost, bins=boosting.BINS):
    """The same trees one node at a time: {(tree, node): (feature, bin) or value}, predictions."""
    margin = np.full(len(y), int(np.floor(y.mean() * UNIT + 0.5)))
    found = {}
    for tree in range(boost.rounds):
        node = np.ones(len(y), int)
        g = margin - y * UNIT
        for level in range(boost.depth):
            for at in sorted(set(node[node >= 2**level].tolist())):
                mine = node == at
                score = lambda m: (g[m].sum() / UNIT) ** 2 / (m.sum() + boost.l2)
                best = (boosting.LEAST_GAIN, None)
                for f in range(x_bins.shape[1]):
                    for b in range(bins):
                        left = mine & (x_bins[:, f] <= b)
                        right = mine & ~left
                        if min(left.sum(), right.sum()) >= boost.least_rows:
                            gain = score(left) + score(right) - score(mine)
                            if gain > best[0]:
                                best = (gain, (f, b))
                if best[1]:
                    found[tree, at] = best[1]
                    node[mine] = 2 * at + (x_bins[mine, best[1][0]] > best[1][1])
        for at in set(node.tolist()):
            mine = node == at
            exact = boost.learning_rate * float(-g[mine].sum()) / (mine.sum() + boost.l2)
            value = int(np.sign(exact) * np.floor(abs(exact) + 0.5))
            found[tree, at] = value / UNIT
            margin[mine] += value
    return found, margin / UNIT


def of_series(key):
    own = sorted((r for r in made() if r[:2] == key), key=lambda r: r[2])
    return np.array([r[4:] for r in own], float), np.array([r[3] for r in own])


def test_trees_of_every_series(spark, rows):
    boost = Boost(learning_rate=0.3, rounds=3, depth=3, l2=0.5, least_rows=5)
    trees, models = boosting.train_boosted(rows, FEATURES, boost)
    got = {}
    for r in trees.collect():
        said = (r["feature"], r["cut"]) if r["feature"] else r["value"]
        got[r["store_id"], r["item_id"], r["tree"], r["node"]] = said
    want = {}
    predicted = {}
    for key in SERIES:
        x, y = of_series(key)
        edges, bins = binned(x)
        nodes, predicted[key] = plain(bins, y, boost)
        want |= {(*key, t, n): (FEATURES[v[0]], edges[v[0]][v[1]]) if isinstance(v, tuple) else v for (t, n), v in nodes.items()}
    assert got == want
    aligned = boosting.aligned_trees(models, ["c", "unused", "b", "a"])
    from pyspark.sql import functions as F

    values = F.array(F.col("c").cast("double"), F.lit(0.0), "b", F.col("a").cast("double"))
    scored = rows.join(aligned, ["store_id", "item_id"]).withColumn("p", boosting.tree_score(values)).orderBy("date").collect()
    for key in SERIES:
        assert [r["p"] for r in scored if (r["store_id"], r["item_id"]) == key] == pytest.approx(predicted[key].tolist())


def test_search_learns_from_the_days_before_a_fold(spark, rows):
    candidates = [Boost(0.5, 2, 2, 0.0, 5), Boost(0.1, 1, 1, 1.0, 5), Boost(0.5, 1, 2, 0.0, 5)]
    got = {}
    for r in boosting.search_boosted(rows, FEATURES, candidates, folds=2, test_rows=6).collect():
        got[r["store_id"], r["item_id"], r["candidate"]] = (r["errors"], r["mean_mae"], r["rank"])
    for key in SERIES:
        x, y = of_series(key)
        edges, bins = binned(x)
        means = []
        for i, boost in enumerate(candidates):
            errors = []
            for fold in range(2):
                end = len(y) - 6 * fold
                learn = slice(0, end - 6)
                nodes, _ = plain(bins[learn], y[learn], boost)
                base = np.floor(y[learn].mean() * UNIT + 0.5) / UNIT
                guess = []
                for row in bins[end - 6 : end]:
                    total = base
                    for tree in range(boost.rounds):
                        at = 1
                        while isinstance(nodes[tree, at], tuple):
                            at = 2 * at + (row[nodes[tree, at][0]] > nodes[tree, at][1])
                        total += nodes[tree, at]
                    guess.append(total)
                errors.append(np.abs(np.array(guess) - y[end - 6 : end]).mean())
            assert got[(*key, i)][0] == pytest.approx(errors)
            means.append(np.mean(errors))
        assert [got[(*key, i)][2] for i in range(3)] == [1 + sorted(range(3), key=lambda j: (round(means[j], 9), j)).index(i) for i in range(3)]


def test_a_series_too_short_for_a_fold_or_a_cut(spark):
    few = [("A", "x", START + timedelta(days=i), 2, i, 0.5, 1) for i in range(7)]
    rows = spark.createDataFrame(few, "store_id string, item_id string, date date, sales int, a int, b double, c int")
    trees, models = boosting.train_boosted(rows, FEATURES, Boost(rounds=1, depth=2))
    assert [(r["node"], r["feature"], r["value"]) for r in trees.collect()] == [(1, None, 0.0)]
    assert models.first()["base"] == 2.0
    found = boosting.search_boosted(rows, FEATURES, [Boost(rounds=1, depth=1)], folds=2).collect()
    assert [(r["errors"], r["mean_mae"]) for r in found] == [([None, None], None)]
    none = rows.limit(0)
    assert boosting.train_boosted(none, FEATURES, Boost(rounds=1, depth=1))[0].count() == 0


def test_series_stay_where_they_are(spark, rows):
    held = stage_by_series(rows, "held", ["store_id", "item_id"])
    plan = held.groupBy("store_id", "item_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    binned_rows = boosting.bin_rows(held, FEATURES)
    assert "Exchange" not in binned_rows._jdf.queryExecution().executedPlan().toString()
    assert Task(Boost(), 1).boost.levels == 5
