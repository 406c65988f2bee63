"""One-hot blocks held as positions, against named columns."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import encoding, selection
from shelfcast.operators.training import score, train
from shelfcast.plans.forecasting import recursive_forecast, score_one_day
from shelfcast.plans.retraining import Registry, retrain, retrain_block
from shelfcast.schema import SERIES
from shelfcast.session import stage
from test_forecasting import DAYS, START, frame, to_spark


@pytest.fixture(scope="module")
def production():
    pdf = frame()[lambda d: d.date >= START + timedelta(days=DAYS - 23)].reset_index(drop=True)
    pdf.loc[pdf.date >= START + timedelta(days=DAYS - 8), "sales"] = 0
    return pdf


@pytest.fixture(scope="module")
def registries(spark):
    work = to_spark(spark, frame()[lambda d: d.date < START + timedelta(days=DAYS - 23)])
    return retrain(work, kept=1_000), retrain_block(work, kept=1_000)


def test_a_block_trains_the_models_of_named_columns(registries):
    named, block = ({(m.store_id, m.item_id): m for m in r.models.collect()} for r in registries)
    assert set(named) == set(block)
    for key, model in named.items():
        other = block[key]
        weights = dict(zip(other.features, other.weights))
        for feature, weight in zip(model.features, model.weights):
            # A category the series has not seen has no weight at all.
            assert weights.get(feature, 0.0) == pytest.approx(weight, abs=1e-9)
        assert (other.intercept, other.l2, other.cv_mae) == pytest.approx((model.intercept, model.l2, model.cv_mae))
        known = {f for f, p in zip(other.features, other.positions) if p is not None}
        assert known and all(f.startswith("event_name_1_") for f in known)


def test_a_block_scores_and_forecasts_alike(spark, production, registries, tmp_path, monkeypatch):
    named, block = registries
    block.save(str(tmp_path))
    block = Registry.load(spark, str(tmp_path))
    rows = to_spark(spark, production)
    days = [sorted(map(tuple, recursive_forecast(rows, named).collect()), key=str)]
    scores = [sorted(score_one_day(rows, named).collect())]

    def collected(state):
        raise AssertionError("categories went to the driver")

    monkeypatch.setattr(encoding, "one_hot_categories", collected)
    monkeypatch.setattr("shelfcast.plans.preparation.one_hot_categories", collected)
    days.append(sorted(map(tuple, recursive_forecast(rows, block).collect()), key=str))
    scores.append(sorted(score_one_day(rows, block).collect()))
    assert days[0] == days[1] and scores[0] == scores[1]


def test_information_of_positions_equals_that_of_columns(spark):
    rng = np.random.default_rng(2)
    rows = [
        (store, "x", int(rng.poisson(3)), f"c{min(int(rng.exponential(1.5)), 5)}" if store == "a" else "c0")
        for store in ("a", "b")
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "store_id string, item_id string, sales int, c string")
    state = encoding.with_positions(encoding.fit_one_hot(df, ["c"]))
    found = selection.one_hot_information(encoding.encode_positions(df, state, ["c"]), state)
    got = {(r.store_id, r.feature): r.mutual_information for r in found.collect()}
    categories = encoding.one_hot_categories(state)
    named = selection.mutual_information(encoding.apply_one_hot(df, state, categories), encoding.one_hot_names(categories))
    expected = {(r.store_id, r.feature): r.mutual_information for r in named.collect()}
    assert ("b", "c_c1") not in got and ("a", "c_c1") in got
    assert all(expected[k] == pytest.approx(v, abs=1e-12) for k, v in got.items())
    assert all(v == pytest.approx(0, abs=1e-12) for k, v in expected.items() if k not in got)


def test_ten_thousand_categories_train_and_score(spark):
    """Every series has 101 categories of its own, which decide what is sold."""
    rows = [
        (f"S{s}", "I", date(2020, 1, 1) + timedelta(days=i), (i % 101) % 9, 1.0, f"c{s}-{i % 101}")
        for s in range(100)
        for i in range(202)
    ]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, sales int, f double, c string")
    state = stage(encoding.with_positions(encoding.fit_one_hot(df, ["c"])), "one-hot")
    assert state.select("position").distinct().count() == 10_100
    encoded = stage(encoding.encode_positions(df, state, ["c"]), "encoded")
    scores = selection.one_hot_information(encoded, state)
    selected = stage(selection.preselect(scores, kept=101), "selected")
    models = train(encoded, selected, ["f"], candidates=[{"l2": 1e-9}])
    got = score(encoded, models, ["f"])
    assert models.count() == 100
    assert not got.where(F.col("prediction") != F.col("sales")).count()
    assert got.count() == df.count()
    assert not train(encoded.limit(0), selected.limit(0), ["f"]).count()
    unseen = df.limit(1).withColumn("c", F.lit("new"))
    assert encoding.encode_positions(unseen, state, ["c"]).first().one_hot == []
    assert set(SERIES) <= set(encoded.columns)
