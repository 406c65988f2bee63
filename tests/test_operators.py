from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import encoding, explore, features, folds, panel, quality, selection
from shelfcast.sources import tables
from shelfcast.schema import MODEL_SCHEMA

START = date(2015, 1, 1)


def day(n: int) -> date:
    return START + timedelta(days=n)


def series_frame(spark, sales, store="S1", item="I1", prices=None):
    prices = prices or [5.0] * len(sales)
    rows = [
        (day(i), store, item, None, 1 + i // 30, p, 1 + i % 7, f"W{i % 7}", s)
        for i, (s, p) in enumerate(zip(sales, prices))
    ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def test_mode_takes_lowest_on_a_tie_and_leaves_an_all_null_item(spark):
    rows = [("a", "x", 3.0), ("b", "x", 2.0), ("a", "x", None), ("a", "y", None), ("b", "x", None)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, sell_price double")
    got = sorted((r.store_id, r.item_id, r.sell_price or 0.0) for r in quality.fill_by_mode(df).collect())
    assert got == [("a", "x", 2.0), ("a", "x", 3.0), ("a", "y", 0.0), ("b", "x", 2.0), ("b", "x", 2.0)]


def test_densify_fills_inner_leading_and_trailing_gaps(spark):
    days = spark.createDataFrame([(day(i),) for i in range(6)], "date date")
    sold = spark.createDataFrame(
        [("a", "x", day(1), 4), ("a", "x", day(3), 5), ("b", "x", day(0), 7), ("b", "x", day(5), 1)],
        "store_id string, item_id string, date date, sales int",
    )
    got = panel.densify(sold, days).orderBy("store_id", "date").collect()
    assert [r.sales for r in got] == [0, 4, 0, 5, 0, 0, 7, 0, 0, 0, 0, 1]
    assert [r.date for r in got[:6]] == [day(i) for i in range(6)]


def test_melt_keeps_empty_cells(spark):
    wide = spark.createDataFrame([("i", 1, None), ("j", 2, 3)], "id string, d_1 int, d_2 int")
    got = {(r.id, r.d): r.sales for r in panel.melt_days(wide, ["id"]).collect()}
    assert got == {("i", "d_1"): 1, ("i", "d_2"): None, ("j", "d_1"): 2, ("j", "d_2"): 3}


@pytest.mark.parametrize("length, kept", [(14, 0), (15, 0), (16, 1), (20, 5)])
def test_features_need_fifteen_days_of_history(spark, length, kept):
    df = series_frame(spark, list(range(length)))
    assert features.build_features(quality.clean(df)).count() == kept


def test_lags_rolling_and_stockouts_equal_pandas(spark):
    rng = np.random.default_rng(3)
    sales = [int(x) for x in rng.poisson(0.7, 90)]
    frame = series_frame(spark, sales).unionByName(series_frame(spark, sales[::-1], store="S2"))
    got = features.build_features(quality.clean(frame)).toPandas()
    for store, values in (("S1", sales), ("S2", sales[::-1])):
        mine = got[got.store_id == store].sort_values("date").reset_index(drop=True)
        s = pd.Series(values, dtype=float)
        assert len(mine) == 75
        for k in range(1, 16):
            np.testing.assert_array_equal(mine[f"sales_lag_{k}"], s.shift(k)[15:])
        for k in range(2, 16):
            past = s.shift(1).rolling(k)
            np.testing.assert_allclose(mine[f"sales_rollmin_{k}"], past.min()[15:])
            np.testing.assert_allclose(mine[f"sales_rollmean_{k}"], past.mean()[15:])
            np.testing.assert_allclose(mine[f"sales_rollmax_{k}"], past.max()[15:])
        for n in (3, 7, 15):
            flag = ((s == 0).astype(int).rolling(n).sum() == n).astype(int).shift(1)
            np.testing.assert_array_equal(mine[f"stockout_{n}_lag_1"], flag[15:])
    assert (got.sales_rollmin_5 <= got.sales_rollmean_5).all()
    assert len(features.feature_names()) == 67


def test_rolling_is_null_around_a_missing_value(spark):
    df = series_frame(spark, [1, 2, None, 4, 5, 6]).select("store_id", "item_id", "date", "sales")
    got = features.add_rolling(df, (2,)).orderBy("date").toPandas()
    assert got.sales_rollmean_2.isna().tolist() == [True, True, False, True, True, False]
    assert got.sales_rollmin_2.tolist()[5] == 4


def test_stockout_needs_exactly_n_zeros(spark):
    df = series_frame(spark, [1, 0, 0, 0, 0, None, 0]).select("store_id", "item_id", "date", "sales")
    flags = [r.stockout_3 for r in features.add_stockouts(df, (3,)).orderBy("date").collect()]
    assert flags == [0, 0, 0, 1, 1, 0, 0]


def test_features_of_a_day_ignore_that_day_and_later_ones(spark):
    base = list(range(1, 31))
    changed = base[:20] + [999] * 10
    a, b = (
        features.build_features(quality.clean(series_frame(spark, s))).where(F.col("date") == day(20))
        .drop("sales").first()
        for s in (base, changed)
    )
    assert a == b


def test_quantiles_are_exact_for_any_number_of_cells(spark):
    values = np.random.default_rng(1).exponential(100, 500).round(1)
    values[:200] = 7.0
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    counts = quality.value_counts(df, ["x"], "double")
    for cells in (2, 7, 64):
        got = {r.p: r.quantile for r in quality.quantiles(counts, (0.0, 0.25, 0.5, 0.75, 1.0), cells).collect()}
        for p, q in got.items():
            assert q == pytest.approx(np.quantile(values, p))
    single = spark.createDataFrame([(4.0,), (None,)], "x double")
    assert quality.numeric_summary(single, ["x"]).first()["median"] == 4.0


def test_outliers_use_population_deviation(spark):
    values = [0.0] * 50 + [100.0]
    df = spark.createDataFrame([(v,) for v in values], "sales double")
    bounds = quality.outlier_bounds(df, ["sales"]).first()
    assert bounds.upper == pytest.approx(np.mean(values) + 4 * np.std(values))
    assert [(r.value, r.n) for r in quality.outlier_counts(df, ["sales"]).collect()] == [(100.0, 1)]


def test_one_hot_gives_zeros_for_a_category_its_series_has_not_seen(spark):
    seen = spark.createDataFrame(
        [("a", "x", "E1"), ("a", "x", "E2"), ("b", "x", "E1")], "store_id string, item_id string, event string"
    )
    state = encoding.fit_one_hot(seen, ["event"])
    later = spark.createDataFrame(
        [("a", "x", "E2"), ("b", "x", "E2"), ("b", "x", "E3"), ("b", "x", "E1")], seen.schema
    )
    got = encoding.apply_one_hot(later, state, {"event": ["E1", "E2"]}).collect()
    assert sorted((r.store_id, r.event, r.event_E1, r.event_E2) for r in got) == [
        ("a", "E2", 0.0, 1.0),
        ("b", "E1", 1.0, 0.0),
        ("b", "E2", 0.0, 0.0),
        ("b", "E3", 0.0, 0.0),
    ]


@pytest.mark.parametrize("keys", [["store_id", "item_id"], []])
def test_target_encoding_smooths_and_falls_back_to_the_prior(spark, keys):
    rows = [("a", "x", 1, 10)] * 150 + [("a", "x", 2, 0)] * 99 + [("a", "x", 3, 7)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, month int, sales int")
    state = encoding.fit_target_encoding(df, ["month"], keys)
    prior = 1507 / 250
    got = {r.category: r.encoding for r in state.collect()}
    weight = 1 / (1 + np.exp(1))
    assert got["1"] == pytest.approx(10, abs=1e-9)
    assert got["2"] == pytest.approx(prior * (1 - weight))
    assert got["3"] == pytest.approx(prior)
    unseen = spark.createDataFrame([("a", "x", 9, 0)], df.schema)
    assert encoding.apply_target_encoding(unseen, state, ["month"], keys).first()["month_te"] == pytest.approx(prior)


def brute_force_information(x, y, bins):
    def cut(v):
        return np.array([(bins * (v < one).sum()) // len(v) for one in v])

    a, b, total = cut(x), cut(y), 0.0
    for i in set(a):
        for j in set(b):
            p = ((a == i) & (b == j)).mean()
            if p:
                total += p * np.log(p / ((a == i).mean() * (b == j).mean()))
    return total


def test_mutual_information_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for store in ("a", "b"):
        y = rng.poisson(3, 120)
        rows += [(store, "x", int(v), float(v * 2), float(rng.integers(0, 4)), 1.0) for v in y]
    df = spark.createDataFrame(rows, "store_id string, item_id string, sales int, f double, g double, c double")
    scores = selection.mutual_information(df, ["f", "g", "c"], bins=5)
    got = {(r.store_id, r.feature): r.mutual_information for r in scores.collect()}
    pdf = df.toPandas()
    for (store, name), value in got.items():
        one = pdf[pdf.store_id == store]
        assert value == pytest.approx(brute_force_information(one[name].values, one.sales.values, 5), abs=1e-9)
    ranks = {(r.store_id, r.feature): r["rank"] for r in selection.rank_features(scores).collect()}
    assert ranks["a", "f"] == 0 and ranks["a", "c"] == 2
    assert selection.preselect(scores, kept=2).count() == 4


@pytest.mark.parametrize("rows, train", [(40, 0), (41, 1)])
def test_oldest_fold_trains_only_on_rows_before_its_test_block(spark, rows, train):
    df = series_frame(spark, [1] * rows).select("store_id", "item_id", "date", "sales")
    roles = folds.time_folds(df).where("fold = 4").groupBy("role").count().collect()
    counts = {r.role: r["count"] for r in roles}
    assert counts.get("train", 0) == train and counts["test"] == 8


def test_splits_semi_join_and_overwrite(spark):
    df = series_frame(spark, list(range(10))).select("store_id", "item_id", "date", "sales")
    work, held = panel.temporal_split(df, F.lit(day(5)), F.lit(day(6)))
    assert (work.count(), held.count()) == (5, 2)
    assert [r.date for r in panel.missing_days(work, "2015-01-04", "2015-01-07").orderBy("date").collect()] == [
        day(5),
        day(6),
    ]
    assert panel.drop_oldest_day(df).agg(F.min("date")).first()[0] == day(1)
    assert panel.keep_oldest_day(df).count() == 1
    assert [r.sales for r in panel.last_rows(df, 3).orderBy("date").collect()] == [7, 8, 9]
    forecast = spark.createDataFrame(
        [("S1", "I1", day(9), 77)], "store_id string, item_id string, date date, prediction int"
    )
    assert [r.sales for r in panel.overwrite_sales(df, forecast).orderBy("date").collect()][-2:] == [8, 77]


def test_profile_duplicates_and_cross_table(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    got = {r.variable: (r.non_null, r.nulls, r.distinct_values) for r in quality.profile_columns(df).collect()}
    assert got == {"k": (2, 1, 1), "v": (3, 0, 2)}
    found = quality.duplicate_rows(df, {"both": ["k", "v"], "k": ["k"]}).collect()
    assert {r.compared: r.duplicates for r in found}["both"] == 1
    cross = quality.cross_table(df.withColumn("v", F.col("v").cast("string")), "k", "v", ["1", "2"]).collect()
    assert [tuple(r) for r in cross] == [("a", 2, 0)]
    shares = explore.category_frequencies(df, ["k", "v"]).collect()
    assert sum(r.frequency for r in shares if r.variable == "v") == pytest.approx(1.0)


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_round_trip_matches_columns_by_header(spark, tmp_path, sep):
    df = series_frame(spark, [1, 2, None], prices=[1.5, None, 2.25])
    path = str(tmp_path / "csv")
    tables.write_csv(df.select(*reversed(df.columns)), path, sep)
    back = tables.read_csv(spark, path, MODEL_SCHEMA, sep)
    assert back.schema == MODEL_SCHEMA
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_a_wide_catalogue_keeps_its_rows(spark):
    items = spark.range(10_001).selectExpr("concat('I', id) AS item_id", "date'2015-01-01' AS date", "int(id) AS sales")
    assert explore.total_by(items, "date", "item_id").count() == 10_001
    assert len(explore.labels_of(items, "item_id")) == 10_001


@pytest.mark.parametrize("keys", [["store_id"], []])
def test_one_hot_block_of_any_width(spark, keys):
    df = spark.range(1_001).selectExpr("concat('S', id % 2) AS store_id", "format_string('c%04d', id) AS a", "concat('b', id % 3) AS b")
    state = encoding.fit_one_hot(df, ["a", "b"], keys)
    got = {r.a: r.one_hot for r in encoding.encode_positions(df, state, ["a", "b"], keys).collect()}
    assert len(got) == 1_001
    assert all(got[f"c{i:04d}"] == [i, 1_001 + i % 3] for i in range(1_001))
    unseen = spark.createDataFrame([("S0", "new", "b1")], df.schema)
    assert encoding.encode_positions(unseen, state, ["a", "b"], keys).first().one_hot == [1_002]


def test_pooled_states_are_joined_on_the_category(spark):
    rows = [(f"c{i % 1_500}", i % 7) for i in range(6_000)]
    df = spark.createDataFrame(rows, "a string, sales int")
    state = encoding.fit_target_encoding(df, ["a"], keys=[], min_samples=0)
    encoded = encoding.apply_target_encoding(df, state, ["a"], keys=[])
    assert not encoded.where("a_te IS NULL").count()
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    other = spark.createDataFrame([("unseen", 1)], df.schema)
    prior = sum(r[1] for r in rows) / len(rows)
    assert encoding.apply_target_encoding(other, state, ["a"], keys=[]).first().a_te == pytest.approx(prior)
    flags = encoding.apply_one_hot(other, encoding.fit_one_hot(df, ["a"], []), {"a": ["c1", "unseen"]}, []).first()
    assert flags["a_c1"] == flags["a_unseen"] == 0.0


def test_series_keys_split_at_their_store(spark):
    pairs = [("CA_3", "Brand#1"), ("CA", "3_x"), ("MIDDLE EAST", "A_B_C"), ("X", "_y")]
    series = spark.createDataFrame(pairs, "store_id string, item_id string")
    for chosen in (pairs[:1] + pairs[2:], pairs[1:2]):
        known = spark.createDataFrame(chosen, series.schema)
        got = panel.split_series_id(panel.with_series_id(known).select("series_id"), known).collect()
        assert sorted((r.store_id, r.item_id) for r in got) == sorted(chosen)


def test_csv_is_strict(spark, tmp_path):
    good = "date,store_id,item_id,event_name_1,month,sell_price,wday,weekday,sales\n2015-01-01,S,I,,1,2.5,1,Mon,3\n"
    (tmp_path / "ok").mkdir()
    (tmp_path / "ok" / "a.csv").write_text(good)
    assert tables.read_csv(spark, str(tmp_path / "ok"), MODEL_SCHEMA).first().sell_price == 2.5
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.csv").write_text(good.replace("2.5", "x7"))
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(tmp_path / "bad"), MODEL_SCHEMA).select("sell_price").collect()
    assert tables.read_csv(spark, str(tmp_path / "bad"), MODEL_SCHEMA, mode="PERMISSIVE").first().sell_price is None
    (tmp_path / "ok" / "b.csv").write_text("store_id,date,item_id,event_name_1,month,sell_price,wday,weekday,sales\nS,2015-01-01,I,,1,2.5,1,Mon,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(tmp_path / "ok"), MODEL_SCHEMA).collect()


def test_integer_codes_become_categories(spark):
    typed = dict(quality.as_categories(series_frame(spark, [1, 2])).dtypes)
    assert typed["month"] == typed["wday"] == "string" and typed["sales"] == "int"


def test_staged_tables_go_when_released(spark, tmp_path):
    from pathlib import Path

    from shelfcast.session import shared_folder, stage, tune

    folder = Path(shared_folder(spark)) / spark.sparkContext.applicationId
    before = len(list(folder.glob("*"))) if folder.exists() else 0
    stage(spark.range(3).toDF("x"), "probe")
    assert len(list(folder.glob("*"))) == before + 1
    mine = dict(spark.conf.getAll)
    own = tune(spark)
    assert own.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    assert dict(spark.conf.getAll) == mine


def test_release_deletes_the_folder_of_the_application(spark, monkeypatch, tmp_path):
    from shelfcast import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    session.stage(spark.range(3).toDF("x"), "probe")
    assert len(list(tmp_path.iterdir())) == 1
    session.release(spark)
    assert not list(tmp_path.iterdir())


def test_functions_reach_workers_without_the_package(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from shelfcast.session import build_session\n"
        "from shelfcast.operators.training import train\n"
        "spark = build_session('local[2]', 2)\n"
        "rows = [('S', 'I', i, float(i % 5), i % 5) for i in range(60)]\n"
        "df = spark.createDataFrame(rows, 'store_id string, item_id string, date int, x double, sales int')\n"
        "chosen = spark.createDataFrame([('S', 'I', 'x', 0)], 'store_id string, item_id string, feature string, rank int')\n"
        "print('MODELS', train(df, chosen, ['x']).count())\n"
    )
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "MODELS 1" in done.stdout, done.stderr[-2000:]
