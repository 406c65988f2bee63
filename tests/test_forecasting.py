from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from shelfcast.operators.training import _solve, draw_candidates, search, train
from shelfcast.plans.forecasting import evaluate, forecast_days, recursive_forecast, score_one_day
from shelfcast.plans.retraining import Registry, retrain, training_set
from shelfcast.schema import MODEL_SCHEMA, NO_EVENT, TARGET_ENCODED_COLUMNS

START = date(2014, 9, 1)
DAYS = 150
SERIES = [("CA_1", "I1"), ("CA_2", "I1"), ("CA_1", "I2")]


def event_of(day: date) -> str | None:
    return {(10, 31): "Halloween", (12, 25): "Christmas", (1, 20): "Sale"}.get((day.month, day.day))


def frame() -> pd.DataFrame:
    rng = np.random.default_rng(11)
    rows = []
    for s, (store, item) in enumerate(SERIES):
        for i in range(DAYS):
            day = START + timedelta(days=i)
            sales = int(rng.poisson(2 + 3 * (day.weekday() >= 5) + s))
            price = None if rng.random() < 0.2 else float(rng.choice([4.0, 5.0, 6.5]))
            rows.append((day, store, item, event_of(day), day.month, price, day.isoweekday() % 7 + 1,
                         day.strftime("%A"), sales))
    return pd.DataFrame(rows, columns=MODEL_SCHEMA.fieldNames())


def to_spark(spark, pdf: pd.DataFrame):
    rows = [tuple(None if v is None or v != v else v for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


@pytest.fixture(scope="module")
def work() -> pd.DataFrame:
    return frame()[lambda d: d.date < START + timedelta(days=DAYS - 23)]


@pytest.fixture(scope="module")
def production() -> pd.DataFrame:
    pdf = frame()[lambda d: d.date >= START + timedelta(days=DAYS - 23)].reset_index(drop=True)
    pdf.loc[pdf.date >= START + timedelta(days=DAYS - 8), "sales"] = 0
    return pdf


@pytest.fixture(scope="module")
def registry(spark, work):
    return retrain(to_spark(spark, work), kept=40)


def by_hand(production: pd.DataFrame, registry: Registry) -> dict:
    """Eight rounds of: fill prices, build one day, predict, write back, drop a day."""
    models = {(r.store_id, r.item_id): r for r in registry.models.collect()}
    seen = {(r.store_id, r.item_id, r.category) for r in registry.encoders.one_hot.collect()}
    codes, priors = {}, {}
    for r in registry.encoders.target.collect():
        codes[r.store_id, r.item_id, r.variable, r.category] = r.encoding
        priors[r.store_id, r.item_id] = r.prior
    x = production.copy()
    found = {}
    for _ in range(8):
        filled = x.copy()
        for item, rows in x.groupby("item_id"):
            mode = rows.sell_price.dropna().mode()[0]
            filled.loc[(filled.item_id == item) & filled.sell_price.isna(), "sell_price"] = mode
        target = x.date.min() + timedelta(days=15)
        for store, item in SERIES:
            rows = filled[(filled.store_id == store) & (filled.item_id == item)].sort_values("date")
            past = rows[rows.date < target]
            today = rows[rows.date == target].iloc[0]
            sales = past.sales.tolist()[::-1]
            prices = past.sell_price.tolist()[::-1]
            values = {f"sell_price_lag_{k}": prices[k - 1] for k in range(1, 8)}
            values |= {f"stockout_{n}_lag_1": int(all(v == 0 for v in sales[:n])) for n in (3, 7, 15)}
            values |= {f"sales_lag_{k}": sales[k - 1] for k in range(1, 16)}
            for k in range(2, 16):
                values[f"sales_rollmin_{k}"] = min(sales[:k])
                values[f"sales_rollmean_{k}"] = sum(sales[:k]) / k
                values[f"sales_rollmax_{k}"] = max(sales[:k])
            event = today.event_name_1 or NO_EVENT
            if (store, item, event) in seen:
                values[f"event_name_1_{event}"] = 1.0
            for c in TARGET_ENCODED_COLUMNS:
                values[f"{c}_te"] = codes.get((store, item, c, str(today[c])), priors[store, item])
            model = models[store, item]
            score = model.intercept + sum(w * values.get(f, 0.0) for f, w in zip(model.features, model.weights))
            score = round(score, 6)
            found[store, item, target] = int(score)
            x.loc[(x.store_id == store) & (x.item_id == item) & (x.date == target), "sales"] = int(score)
        x = x[x.date != x.date.min()]
    return found


def test_recursive_forecast_equals_the_plain_loop(spark, production, registry):
    rows = to_spark(spark, production)
    expected = by_hand(production, registry)
    got = {(r.store_id, r.item_id, r.date): r.prediction for r in forecast_days(rows, registry).collect()}
    assert got == expected
    result = recursive_forecast(rows, registry).toPandas()
    assert len(result) == 3 * 15
    known = production.set_index(["store_id", "item_id", "date"]).sales
    for r in result.itertuples():
        key = (r.store_id, r.item_id, r.date)
        assert r.sales == expected.get(key, known[key])


def test_one_day_score_is_the_first_forecast_day(spark, production, registry):
    rows = to_spark(spark, production)
    one = {(r.series_id, r.date): r.prediction for r in score_one_day(rows, registry).collect()}
    expected = by_hand(production, registry)
    first = min(d for _, _, d in expected)
    assert one == {(f"{s}_{i}", d): v for (s, i, d), v in expected.items() if d == first}
    assert evaluate(rows, registry).first().rows == 3


def test_series_with_a_missing_day_or_no_model_has_no_forecast(spark, production, registry):
    gap = production[~((production.item_id == "I2") & (production.date == production.date.min() + timedelta(days=9)))]
    got = {(r.store_id, r.item_id) for r in forecast_days(to_spark(spark, gap), registry).collect()}
    assert got == {("CA_1", "I1"), ("CA_2", "I1")}
    fewer = Registry(registry.encoders, registry.models.where("store_id = 'CA_1'"))
    got = {(r.store_id, r.item_id) for r in forecast_days(to_spark(spark, production), fewer).collect()}
    assert got == {("CA_1", "I1"), ("CA_1", "I2")}


def test_days_without_a_forecast_say_why(spark, production, registry):
    second = production.date.min() + timedelta(days=1)
    gap = production[~((production.item_id == "I2") & (production.date == production.date.min() + timedelta(days=9)))]
    late = gap[~((gap.store_id == "CA_2") & (gap.date < second))]
    fewer = Registry(registry.encoders, registry.models.where("NOT (store_id = 'CA_1' AND item_id = 'I1')"))
    rows = recursive_forecast(to_spark(spark, late), fewer).toPandas()
    start = production.date.max() - timedelta(days=7)
    to_come = rows[rows.date >= start]
    why = {(r.store_id, r.item_id): r.origin for r in to_come.itertuples()}
    assert why == {("CA_1", "I1"): "no model", ("CA_2", "I1"): "gap in history", ("CA_1", "I2"): "gap in history"}
    assert to_come.sales.isna().all()
    assert (rows[rows.date < start].origin == "known").all() and rows[rows.date < start].sales.notna().all()
    one = score_one_day(to_spark(spark, production), fewer).toPandas()
    assert one.prediction.isna().tolist().count(True) == 1


def test_registry_survives_saving(spark, production, registry, tmp_path):
    path = str(tmp_path / "registry")
    registry.save(path)
    rows = to_spark(spark, production)
    loaded = Registry.load(spark, path)
    assert sorted(forecast_days(rows, loaded).collect()) == sorted(forecast_days(rows, registry).collect())


def test_search_tests_the_newest_blocks_in_time_order(spark, work):
    ready = training_set(to_spark(spark, work), kept=10)
    found = search(ready.encoded, ready.selected, ready.features, [{"l2": 0.1}]).toPandas()
    assert len(found) == 3 and (found.folds == 5).all()
    rows = ready.encoded.where("store_id = 'CA_2'").toPandas().sort_values("date")
    names = [r.feature for r in ready.selected.where("store_id = 'CA_2'").orderBy("rank").collect()]
    x, y = rows[names].to_numpy(float), rows.sales.to_numpy(float)
    errors = []
    for fold in range(5):
        end = len(y) - 8 * fold
        w, b = _solve(x[: end - 8], y[: end - 8], 0.1)
        errors.append(np.abs(x[end - 8 : end] @ w + b - y[end - 8 : end]).mean())
    assert found[found.store_id == "CA_2"].mean_mae.iloc[0] == pytest.approx(np.mean(errors))
    models = train(ready.encoded, ready.selected, ready.features).collect()
    assert all(len(m.features) == 10 == len(m.weights) for m in models)


def test_ridge_solves_its_normal_equations():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    x[:, 2] = 4.0
    y = x @ [1.0, -2.0, 0.0] + 3
    w, b = _solve(x, y, 1e-9)
    np.testing.assert_allclose(x @ w + b, y, atol=1e-5)
    assert w[2] == 0


def test_candidates_are_seeded_draws():
    assert len(draw_candidates()) == 5
    assert draw_candidates(n_iter=2, seed=4) == draw_candidates(n_iter=2, seed=4)
    assert len(draw_candidates(n_iter=2)) == 2
