from __future__ import annotations

from datetime import date, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest

from shelfcast import catalog
from shelfcast.operators.training import GRID, _solve
from shelfcast.oracle import ORACLE

START = date(1995, 1, 1)
DAYS = 416
TABLES = ("region", "nation", "supplier", "part", "lineitem")


@pytest.fixture(scope="module")
def folder(tmp_path_factory) -> str:
    """Two series over all yearly events; sales follow several lags, so that features add up."""
    rng = np.random.default_rng(5)
    path = tmp_path_factory.mktemp("tables")
    lines = []
    for key in (1, 2):
        sold = [3, 4, 5]
        for i in range(DAYS):
            day = START + timedelta(days=i)
            sales = int(rng.poisson(1 + key * (day.weekday() >= 5) + 0.3 * sold[-1] + 0.3 * sold[-3]))
            sold.append(sales)
            if sales or i in (0, DAYS - 1):
                lines.append((key, key, float(sales or 1), float((sales or 1) * rng.choice([150, 250, 420])), pd.Timestamp(day)))
    region = pd.DataFrame({"r_regionkey": [0, 1], "r_name": ["AFRICA", "ASIA"]}).astype({"r_regionkey": "int32"})
    nation = pd.DataFrame({"n_nationkey": [0, 1], "n_name": ["A", "B"], "n_regionkey": [0, 1]})
    nation = nation.astype({"n_nationkey": "int32", "n_regionkey": "int32"})
    supplier = pd.DataFrame({"s_suppkey": [1, 2], "s_name": ["S1", "S2"], "s_nationkey": [0, 1]}).astype({"s_nationkey": "int32"})
    part = pd.DataFrame({"p_partkey": [1, 2], "p_brand": ["Brand#1", "Brand#2"]})
    lineitem = pd.DataFrame(lines, columns=["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    lineitem = lineitem.astype({"l_shipdate": "datetime64[us]"})
    frames = dict(zip(TABLES, (region, nation, supplier, part, lineitem)))
    with duckdb.connect() as con:
        for name, frame in frames.items():
            con.register("frame", frame)
            con.execute(f"COPY (SELECT * FROM frame) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return str(path)


@pytest.fixture(scope="module")
def found(spark, folder) -> pd.DataFrame:
    return catalog.hyper_search(spark, folder).toPandas()


def test_every_penalty_is_tried_on_all_selected_features(spark, folder, found):
    ready = catalog._training_set(spark, folder)
    assert len(found) == 2 * len(GRID["l2"])
    for (store, item), got in found.groupby(["store_id", "item_id"]):
        rows = ready.encoded.where(f"store_id = '{store}'").toPandas().sort_values("date")
        names = [r.feature for r in ready.selected.where(f"store_id = '{store}'").collect()]
        assert len(names) == 70
        x, y = rows[names].to_numpy(float), rows.sales.to_numpy(float)
        for r in got.itertuples():
            errors = []
            for fold in range(5):
                end = len(y) - 8 * fold
                w, b = _solve(x[: end - 8], y[: end - 8], r.l2)
                errors.append(np.abs(x[end - 8 : end] @ w + b - y[end - 8 : end]).mean())
            assert [r.error_0, r.error_1, r.error_2, r.error_3, r.error_4] == pytest.approx(errors, abs=1e-6)
            assert r.mean_mae == pytest.approx(np.mean(errors), abs=1e-6)
            assert (r.folds, r.rows) == (5, len(y))
            assert (r.first_test_date, r.last_test_date) == (rows.date.iloc[-40], rows.date.iloc[-1])
        ranked = got.sort_values(["mean_mae", "l2"])
        assert ranked["rank"].tolist() == [1, 2, 3, 4, 5]


def test_search_equals_its_sql(folder, found):
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        want = con.execute(ORACLE["hyper_search"]).df()
    order = ["store_id", "item_id", "rank"]
    got, want = (f.sort_values(order).reset_index(drop=True) for f in (found, want))
    assert list(got.columns) == list(want.columns)
    days = ["first_test_date", "last_test_date"]
    for c in days:
        assert pd.to_datetime(got[c]).tolist() == pd.to_datetime(want[c]).tolist()
    pd.testing.assert_frame_equal(got.drop(columns=days), want.drop(columns=days), check_dtype=False, atol=2e-6, rtol=0)
