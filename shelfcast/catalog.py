"""The registered queries: each takes a session and a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.history import all_zero
from shelfcast.operators import encoding, explore, features, folds, panel as P, quality, selection
from shelfcast.operators.boosting import Boost, search_boosted
from shelfcast.operators.boosting import train_boosted as fit_boosted
from shelfcast.operators.neighbours import neighbour_information as by_neighbours
from shelfcast.operators.training import aligned_models, linear_score, mean_absolute_error, search, train
from shelfcast.plans import forecasting
from shelfcast.plans.preparation import (
    Encoders,
    encode,
    encoded_feature_names,
    fit_encoders,
    model_rows,
    prepare,
    with_block_positions,
)
from shelfcast.plans.retraining import Registry, TrainingSet, block_training_set, encoded_rows, with_selected
from shelfcast.schema import (
    HORIZON,
    MODEL_COLUMNS,
    MODEL_SCHEMA,
    PANEL_COLUMNS,
    PRICE_LAGS,
    ROLLING_SPANS,
    SALES_LAGS,
    SERIES,
    STOCKOUT_SPANS,
    TARGET_ENCODED_COLUMNS,
    WIDE_IDS,
)
from shelfcast.session import shared_folder, stage, tune
from shelfcast.sources import retail, tables

KEY = [*SERIES, "date"]

HOLDOUT = ("2000-12-01", "2000-12-31")
"""A hold-out month inside the data: later days belong to neither side."""

EVALUATION_DAYS = 31
FORECAST_FRAME_DAYS = SALES_LAGS + HORIZON

CATEGORIES = ["store_id", "item_id", "year", "month", "wday", "weekday", "event_name_1", "event_type_1"]
POOLED_CATEGORIES = ["year", "month", "wday", "weekday", "event_name_1", "event_type_1"]
EVENT_COLUMNS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
AMOUNTS = ["sales", "sell_price"]

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals where sums of fractions may differ in their last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def feature_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """All rows with the given columns as numbers of six decimals."""
    return df.select(*KEY, *[F.round(F.col(c).cast("double"), 6).alias(c) for c in columns])


def _staged_panel(spark: SparkSession, folder: str, columns: list[str] = PANEL_COLUMNS) -> DataFrame:
    """The panel as the written table that cleaning and later steps start from.

    They read it several times, each time other columns.
    """
    return stage(retail.panel(spark, folder).select(*columns), "panel")


# Sources and panel


def src_tables(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    parts = [
        tables.read_table(spark, folder, name)
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("source"), "rows")
        for name in ("region", "nation", "supplier", "part", "lineitem")
    ] + [
        source(totals).agg(F.count("*").alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, source in (("calendar", retail.calendar), ("sell_prices", retail.sell_prices))
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def unpivot_sales(spark: SparkSession, folder: str) -> DataFrame:
    return P.melt_days(retail.sales_wide(retail.day_totals(spark, folder)), WIDE_IDS).drop("id")


def join_calendar(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    joined = P.attach_calendar(retail.sales_long(totals), retail.calendar(totals))
    return joined.drop("state_id", "dept_id", "cat_id")


def join_prices(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    dated = P.attach_calendar(
        retail.sales_long(totals), retail.calendar(totals).select("d", "date", "wm_yr_wk")
    )
    priced = P.attach_prices(dated, retail.sell_prices(totals))
    return priced.select(*KEY, "wm_yr_wk", "sales", "sell_price")


def analytic_table(spark: SparkSession, folder: str) -> DataFrame:
    return retail.panel(spark, folder)


def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    first, last = (F.lit(d).cast("date") for d in HOLDOUT)
    work, holdout = P.temporal_split(retail.panel(spark, folder), first, last)
    both = work.withColumn("part", F.lit("work")).unionByName(
        holdout.withColumn("part", F.lit("holdout"))
    )
    return both.groupBy("part", *SERIES).agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("sales").alias("sales"),
    )


def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    work = P.before(retail.panel(spark, folder), F.lit(HOLDOUT[0]).cast("date"))
    year = HOLDOUT[0][:4]
    return P.missing_days(work.where(F.year("date") == int(year)), f"{year}-01-01", f"{year}-12-31")


def series_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of days without a sale, for every series, between the first and last day of all."""
    totals = retail.day_totals(spark, folder)
    first, last = totals.agg(F.min("date").alias("d")).scalar(), totals.agg(F.max("date").alias("d")).scalar()
    return P.gap_intervals(retail.daily_sales(totals), first, last)


def semi_filter(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    known = P.keep_known(retail.panel_of(totals), retail.sell_prices(totals), [*SERIES, "wm_yr_wk"])
    return known.select(*KEY, "wm_yr_wk", "sales")


def sorted_head(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*SERIES, "wm_yr_wk", "d", "sell_price"]
    return explore.sorted_head(retail.panel(spark, folder).select(*columns), columns[:4], 10)


def series_key(spark: SparkSession, folder: str) -> DataFrame:
    """Each series by its one key and by the store and item split from it again."""
    series = retail.day_totals(spark, folder).select(*SERIES).distinct()
    return P.split_series_id(P.with_series_id(series).select("series_id"), series)


def drop_oldest_day(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    oldest = totals.agg(F.min("date").alias("oldest")).scalar()
    return P.drop_oldest_day(retail.panel_of(totals), oldest).select(*KEY, "sales")


def tail_per_series(spark: SparkSession, folder: str) -> DataFrame:
    return P.last_rows(retail.panel(spark, folder).select(*KEY, "sales"), 100)


# Profile and repair


def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return quality.profile_columns(retail.panel(spark, folder))


def merged_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of single days merged for all: exact counters, and whether the estimates keep
    their bounds: distinct values within five in a hundred, a median's place within three."""
    rows = _staged_panel(spark, folder, PROFILED)
    profiles = stage(quality.daily_profiles(rows), "profiles")
    merged = stage(rounded(quality.merge_profiles(profiles), "low", "high", "total"), "merged")
    columns = [c for c in PROFILED if c != "date"]
    medians = merged.where("median_estimate IS NOT NULL").select("variable", "median_estimate")
    # One row per column.
    counts = quality.value_counts(rows, columns).join(F.broadcast(medians), "variable", "left")
    value = F.col("value").try_cast("double")
    exact = counts.where("value IS NOT NULL").groupBy("variable").agg(
        F.count("*").alias("distinct_values"),
        F.sum("n").alias("filled"),
        F.sum(F.when(value < F.col("median_estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(value <= F.col("median_estimate"), F.col("n")).otherwise(0)).alias("up_to"),
    )
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.ceil(0.05 * F.col("distinct_values"))
    middle = (F.col("below") <= 0.53 * F.col("filled")) & (F.col("up_to") >= 0.47 * F.col("filled"))
    return merged.join(exact, "variable").select(
        "variable", "non_null", "nulls", "low", "high", "total", "distinct_values",
        (near & (F.col("median_estimate").isNull() | middle)).alias("within_bound"),
    )


PROFILED = ["date", "store_id", "item_id", "d", "sales", "sell_price", "month", "weekday", "event_name_1"]


def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = retail.panel(spark, folder).drop("date")
    without_day = [c for c in table.columns if c != "d"]
    return quality.duplicate_rows(table, {"all": table.columns, "all but the day": without_day})


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.value_counts(retail.panel(spark, folder), ["d", *CATEGORIES, "event_name_2", "event_type_2"])


def event_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    labels = [e[1] for e in retail.SECOND_EVENTS]
    return quality.cross_table(retail.panel(spark, folder), "event_name_1", "event_name_2", labels)


def days_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_per_group(retail.panel(spark, folder), "year", "d")


def null_price_by_item(spark: SparkSession, folder: str) -> DataFrame:
    return quality.nulls_by(retail.panel(spark, folder), "item_id", "sell_price")


def null_price_by_sales(spark: SparkSession, folder: str) -> DataFrame:
    return quality.nulls_by(retail.panel(spark, folder), "sales", "sell_price")


def price_counts_by_item(spark: SparkSession, folder: str) -> DataFrame:
    return quality.counts_by(retail.panel(spark, folder), "item_id", "sell_price")


def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    table = retail.panel(spark, folder)
    summary = quality.numeric_summary(table, quality.columns_by_type(table, numeric=True))
    return rounded(summary, "mean", "std", "q25", "median", "q75")


def outlier_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        quality.outlier_bounds(retail.panel(spark, folder), AMOUNTS), "mean", "lower", "upper"
    )


def outlier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.outlier_counts(retail.panel(spark, folder), AMOUNTS)


def impute_mode_price(spark: SparkSession, folder: str) -> DataFrame:
    return quality.fill_by_mode(_staged_panel(spark, folder, [*KEY, "sell_price"]))


def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    return quality.as_categories(quality.clean(_staged_panel(spark, folder)))


# Exploration


def category_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    events = quality.fill_events(retail.panel(spark, folder), ["event_name_1", "event_type_1"])
    return explore.category_frequencies(events, CATEGORIES)


def sales_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return explore.total_by(retail.panel(spark, folder), "date")


def pivot_sales_by_item(spark: SparkSession, folder: str) -> DataFrame:
    grouped = explore.total_by(retail.panel(spark, folder), "date", "item_id")
    items = explore.labels_of(
        tables.read_table(spark, folder, "part").select(F.col("p_brand").alias("item_id")), "item_id"
    )
    return explore.side_by_side(grouped, "date", "item_id", "sales", items)


def sales_by_store_day_item(spark: SparkSession, folder: str) -> DataFrame:
    one_store = retail.panel(spark, folder).where(F.col("store_id") == "ASIA")
    return explore.total_by(one_store, "date", "item_id")


def price_by_day_item(spark: SparkSession, folder: str) -> DataFrame:
    priced = quality.fill_by_mode(_staged_panel(spark, folder, [*KEY, "sell_price"]))
    return explore.mean_by(priced, "sell_price", "date", "item_id")


def _season(column: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        events = quality.fill_events(retail.panel(spark, folder), ["event_name_1", "event_type_1"])
        return explore.mean_by(events, "sales", column, "item_id")

    return query


def sales_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return explore.sales_distribution(retail.panel(spark, folder))


# Features


def stockout_flags(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_stockouts(retail.panel(spark, folder).select(*KEY, "sales"))


def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = retail.panel(spark, folder).select(*KEY, "sales", "sell_price")
    lagged = features.add_lags(rows, {"sales": SALES_LAGS, "sell_price": PRICE_LAGS})
    recent = features.lag_columns("sales", SALES_LAGS)
    flags = {f"stockout_{n}_lag_1": all_zero(recent, n) for n in STOCKOUT_SPANS}
    names = [
        *[f"sales_lag_{k}" for k in range(1, SALES_LAGS + 1)],
        *[f"sell_price_lag_{k}" for k in range(1, PRICE_LAGS + 1)],
        *flags,
    ]
    return feature_rows(lagged.withColumns(flags), names)


def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    rolled = features.add_rolling(retail.panel(spark, folder).select(*KEY, "sales"))
    names = [f"sales_{kind}_{k}" for kind in ("rollmin", "rollmean", "rollmax") for k in ROLLING_SPANS]
    return feature_rows(rolled, names)


def features_full(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare(_staged_panel(spark, folder, MODEL_COLUMNS))
    return feature_rows(prepared, ["sales", *features.feature_names()])


# Encoders


def onehot_event(spark: SparkSession, folder: str) -> DataFrame:
    events = quality.fill_events(_staged_panel(spark, folder, [*KEY, "event_name_1"]), ["event_name_1"])
    return _one_hot(spark, folder, events, events)


def onehot_unseen(spark: SparkSession, folder: str) -> DataFrame:
    events = quality.fill_events(_staged_panel(spark, folder, [*KEY, "event_name_1"]), ["event_name_1"])
    return _one_hot(spark, folder, events.where(F.month("date") <= 6), events)


def _one_hot(spark: SparkSession, folder: str, fitted_on: DataFrame, applied_to: DataFrame) -> DataFrame:
    state = stage(encoding.fit_one_hot(fitted_on, ["event_name_1"]), "one-hot")
    categories = encoding.one_hot_categories(state)
    return encoding.apply_one_hot(applied_to, state, categories).drop("event_name_1")


def _coded_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _staged_panel(spark, folder, [*KEY, *TARGET_ENCODED_COLUMNS, "sales"])


def target_encode(spark: SparkSession, folder: str) -> DataFrame:
    state = encoding.fit_target_encoding(_coded_sales(spark, folder), TARGET_ENCODED_COLUMNS)
    return rounded(state, "mean", "prior", "encoding")


def target_encode_unseen(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coded_sales(spark, folder)
    state = encoding.fit_target_encoding(rows.where(F.col("month") <= 6), TARGET_ENCODED_COLUMNS)
    encoded = encoding.apply_target_encoding(rows, state, TARGET_ENCODED_COLUMNS)
    names = [f"{c}_te" for c in TARGET_ENCODED_COLUMNS]
    return rounded(encoded.select(*KEY, *names), *names)


def target_encode_folds(spark: SparkSession, folder: str) -> DataFrame:
    """The encoder's state for each fold, which sees only what lies before its test block."""
    state = encoding.fit_target_encoding_by_fold(_coded_sales(spark, folder), TARGET_ENCODED_COLUMNS)
    return rounded(state, "mean", "prior", "encoding")


def target_encode_past(spark: SparkSession, folder: str) -> DataFrame:
    """Every row encoded from the rows before it."""
    names = [f"{c}_te" for c in TARGET_ENCODED_COLUMNS]
    encoded = encoding.encode_from_past(_coded_sales(spark, folder), TARGET_ENCODED_COLUMNS)
    return rounded(encoded.select(*KEY, *names), *names)


def encoded_table(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare(_staged_panel(spark, folder, MODEL_COLUMNS))
    encoders = fit_encoders(prepared)
    categories = encoders.categories()
    return feature_rows(
        encode(prepared, encoders, categories), ["sales", *encoded_feature_names(categories)]
    )


def encoded_pooled(spark: SparkSession, folder: str) -> DataFrame:
    """One state for all series, and more columns, as in exploratory encoding."""
    rows = _staged_panel(spark, folder, [*KEY, *POOLED_CATEGORIES, "sales"])
    rows = quality.fill_events(rows, ["event_name_1", "event_type_1"])
    one_hot = stage(encoding.fit_one_hot(rows, POOLED_CATEGORIES, keys=[]), "one-hot")
    target = stage(encoding.fit_target_encoding(rows, POOLED_CATEGORIES, keys=[]), "target-encoding")
    categories = encoding.one_hot_categories(one_hot)
    encoded = encoding.apply_one_hot(rows, one_hot, categories, keys=[])
    encoded = encoding.apply_target_encoding(encoded, target, POOLED_CATEGORIES, keys=[])
    names = encoding.one_hot_names(categories) + [f"{c}_te" for c in POOLED_CATEGORIES]
    return feature_rows(encoded, names)


def encoder_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*KEY, "event_name_1", *TARGET_ENCODED_COLUMNS, "sales"]
    events = quality.fill_events(_staged_panel(spark, folder, columns), ["event_name_1"])
    fitted = Encoders(
        encoding.fit_one_hot(events, ["event_name_1"]),
        encoding.fit_target_encoding(events, TARGET_ENCODED_COLUMNS),
    )
    path = _new_path(spark, "encoders")
    fitted.save(path)
    loaded = Encoders.load(spark, path)
    both = loaded.target.unionByName(loaded.one_hot, allowMissingColumns=True)
    return rounded(both, "mean", "prior", "encoding")


# Selection and folds


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare(_staged_panel(spark, folder, MODEL_COLUMNS))
    encoders = fit_encoders(prepared)
    categories = encoders.categories()
    encoded = encode(prepared, encoders, categories)
    return selection.mutual_information(encoded, encoded_feature_names(categories))


def mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_scores(spark, folder), "mutual_information")


def feature_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return selection.preselect(_scores(spark, folder)).drop("mutual_information")


def ts_folds(spark: SparkSession, folder: str) -> DataFrame:
    split = folds.time_folds(retail.panel(spark, folder).select(*KEY, "sales"))
    return split.groupBy(*SERIES, "fold", "role").agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("sales").alias("sales"),
    )


# Training, scoring, forecasting

_trained: dict[tuple, object] = {}


def _version(spark: SparkSession, folder: str) -> int:
    """Tells one state of the input's files from another, from their listing alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = store.listStatus(path)
    return hash(tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)))


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    """Train once per application and state of the input, as a registry is."""
    key = (spark.sparkContext.applicationId, folder, _version(spark, folder), name)
    if key not in _trained:
        _trained[key] = make()
    return _trained[key]


def forget_trained() -> None:
    _trained.clear()


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _days_left(spark: SparkSession, folder: str):
    """Days from a row's date to the last day of the staged panel."""
    last = _all_rows(spark, folder).agg(F.max("date").alias("last")).scalar()
    return F.date_diff(last, F.col("date"))


def _all_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _once(
        spark, folder, "panel", lambda: stage(model_rows(retail.panel(spark, folder)), "panel")
    )


def work_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rows(spark, folder).where(_days_left(spark, folder) >= EVALUATION_DAYS)


def holdout_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rows(spark, folder).where(_days_left(spark, folder) < EVALUATION_DAYS)


def production_rows(spark: SparkSession, folder: str) -> DataFrame:
    """15 days of history and 8 days to come, whose sales are not known yet."""
    left = _days_left(spark, folder)
    sales = F.when(left < HORIZON, 0).otherwise(F.col("sales"))
    frame = _all_rows(spark, folder).where(left < FORECAST_FRAME_DAYS)
    return frame.withColumn("sales", sales).select(*MODEL_COLUMNS)


def _encoded_set(spark: SparkSession, folder: str) -> TrainingSet:
    return _once(spark, folder, "encoded-set", lambda: encoded_rows(work_rows(spark, folder)))


def _training_set(spark: SparkSession, folder: str) -> TrainingSet:
    return _once(spark, folder, "training-set", lambda: with_selected(_encoded_set(spark, folder)))


def _registry(spark: SparkSession, folder: str) -> Registry:
    def make() -> Registry:
        ready = _training_set(spark, folder)
        models = train(ready.encoded, ready.selected, ready.features)
        return Registry(ready.encoders, stage(models, "models"))

    return _once(spark, folder, "registry", make)


GIVEN_WEIGHTS = {
    "sales_rollmean_7": 0.25,
    "sell_price_lag_1": 0.001,
    "event_name_1_Christmas": 1.5,
    "month_te": 0.1,
}


def _given_registry(spark: SparkSession, folder: str) -> Registry:
    """Encoders fitted on the work rows, and models that plain statistics give.

    Half the slope of sales on the sales a week before, its intercept, and fixed weights:
    scoring and the recursion can be followed in SQL with these, over all series.
    """

    def make() -> Registry:
        rows = prepare(work_rows(spark, folder))
        week = F.col("sales_lag_7").cast("double")
        sold = F.col("sales").cast("double")
        fitted = rows.groupBy(*SERIES).agg(
            F.round(F.coalesce(F.regr_slope(sold, week), F.lit(0.0)), 6).alias("slope"),
            F.round(F.coalesce(F.regr_intercept(sold, week), F.avg(sold)), 6).alias("intercept"),
            F.count("*").alias("rows"),
        )
        names = F.array(*[F.lit(n) for n in ("sales_lag_7", *GIVEN_WEIGHTS)])
        weights = F.array(F.col("slope") / 2, *[F.lit(w) for w in GIVEN_WEIGHTS.values()])
        models = fitted.select(*SERIES, names.alias("features"), weights.alias("weights"), "intercept", "rows")
        return Registry(fit_encoders(rows), stage(models, "models"))

    return _once(spark, folder, "given-registry", make)


def _left_gradients(spark: SparkSession, folder: str, models: DataFrame) -> DataFrame:
    """How far each weight of each series is from the optimum of its penalised loss.

    The optimum of ridge is unique, and there the slope of the loss is zero: the covariance
    of a feature with what is left over, less the penalty on its weight, both for features
    of unit deviation.
    """
    ready = _training_set(spark, folder)
    position = {f: i for i, f in enumerate(ready.features)}
    aligned = aligned_models(models, ready.features)
    fitted = linear_score([F.col(f).cast("double") for f in ready.features])
    numbers = {f: F.col(f).cast("double") for f in ready.features}
    left = ready.encoded.join(aligned, SERIES).withColumn("_left", F.col("sales") - fitted)
    slopes = left.groupBy(*SERIES).agg(
        F.array(*[F.covar_pop("_left", x) for x in numbers.values()]).alias("slopes"),
        F.array(*[F.stddev_pop(x) for x in numbers.values()]).alias("deviations"),
    )
    own = models.select(*SERIES, "l2", F.posexplode(F.arrays_zip("features", "weights")).alias("place", "w")).select(
        *SERIES, "l2", "place", "w.*"
    )
    index = F.create_map(*[F.lit(x) for pair in position.items() for x in pair])
    at = index[F.col("features")]
    joined = own.join(slopes, SERIES).withColumns(
        {"slope": F.get("slopes", at), "deviation": F.get("deviations", at)}
    )
    penalty = F.col("l2") * F.col("weights") * F.col("deviation")
    gradient = F.when(F.col("deviation") > 1e-12, F.col("slope") / F.col("deviation") - penalty).otherwise(F.col("weights"))
    return P.with_series_id(joined).select(
        "series_id", F.col("place").alias("rank"), F.col("features").alias("feature"),
        F.abs(F.round(gradient, 6)).alias("gradient"),
    )


def neighbour_information(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature of every series by rank of its information from neighbour distances."""
    ready = _encoded_set(spark, folder)
    return rounded(selection.rank_features(by_neighbours(ready.encoded, ready.features)), "mutual_information")


def hyper_search(spark: SparkSession, folder: str) -> DataFrame:
    """The penalties of every series by rank: ridge on all its selected features, with the error
    on each fold and the days they were tested on."""
    ready = _training_set(spark, folder)
    best = W.partitionBy(*SERIES).orderBy("mean_mae", "l2")
    found = search(ready.encoded, ready.selected, ready.features)
    found = rounded(found, "mean_mae").withColumn("rank", F.row_number().over(best))
    errors = [F.round(F.get("errors", F.lit(i)), 6).alias(f"error_{i}") for i in range(folds.FOLDS)]
    # A fold without rows to learn from tests no days.
    used = F.least(F.lit(folds.FOLDS), F.floor((F.col("rows") - 1) / folds.TEST_ROWS))
    tested = F.col("recency") <= used * folds.TEST_ROWS
    numbered = folds.with_recency(ready.encoded.select(*KEY))
    days = numbered.withColumn("rows", F.count("*").over(W.partitionBy(*SERIES))).groupBy(*SERIES, "rows").agg(
        F.min(F.when(tested, F.col("date"))).alias("first_test_date"),
        F.max(F.when(tested, F.col("date"))).alias("last_test_date"),
    )
    same = [F.col(f"found.{k}").eqNullSafe(F.col(f"days.{k}")) for k in SERIES]
    return found.alias("found").join(days.alias("days"), same).select(
        *[f"found.{k}" for k in SERIES], "l2", "rank", "folds", "mean_mae", *errors, "rows", "first_test_date", "last_test_date"
    )


BOOST = Boost(learning_rate=0.1, rounds=2, depth=2, l2=1.0)
"""Small enough for SQL to grow the same trees."""
SPLITS = [Boost(rate, 1, 1, l2) for rate in (0.1, 0.5) for l2 in (0.0, 1.0)]


def _boosted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    def make() -> tuple[DataFrame, DataFrame]:
        ready = _encoded_set(spark, folder)
        trees, models = fit_boosted(ready.encoded, ready.features, BOOST)
        return stage(trees, "trees"), stage(models, "models")

    return _once(spark, folder, "boosted", make)


def train_boosted(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the boosted trees of every series."""
    trees, _ = _boosted(spark, folder)
    return rounded(trees, "cut", "gain", "value")


def boosted_search(spark: SparkSession, folder: str) -> DataFrame:
    """Learning rates and penalties of one-split ensembles by rank, with the error of each fold."""
    ready = _encoded_set(spark, folder)
    found = search_boosted(ready.encoded, ready.features, SPLITS)
    errors = [F.round(F.get("errors", F.lit(i)), 6).alias(f"error_{i}") for i in range(folds.FOLDS)]
    return rounded(found.select(*SERIES, "learning_rate", "l2", "rank", "mean_mae", *errors), "mean_mae")


def boosted_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Eight days of every series, each predicted by its trees from the days before it."""
    _, models = _boosted(spark, folder)
    registry = Registry(_encoded_set(spark, folder).encoders, models)
    return forecasting.recursive_forecast(production_rows(spark, folder), registry)


def train_per_series(spark: SparkSession, folder: str) -> DataFrame:
    """The selected features of every series in rank order, each with what is left to gain
    by its fitted weight; the model table itself is what `train` returns."""
    return _left_gradients(spark, folder, _registry(spark, folder).models)


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = _new_path(spark, "registry")
    _registry(spark, folder).save(path)
    return _left_gradients(spark, folder, Registry.load(spark, path).models)


def train_block(spark: SparkSession, folder: str) -> DataFrame:
    """Like `train_per_series`, trained on one-hot positions; what is left to gain is worked
    out over named columns."""

    def make() -> DataFrame:
        ready = block_training_set(work_rows(spark, folder))
        return stage(train(ready.encoded, ready.selected, ready.features), "models")

    return _left_gradients(spark, folder, _once(spark, folder, "block-models", make))


def _given_block_registry(spark: SparkSession, folder: str) -> Registry:
    """The given models, with the weight of an event kept by its position."""

    def make() -> Registry:
        given = _given_registry(spark, folder)
        encoders = with_block_positions(given.encoders)
        name = F.concat_ws("_", "variable", "category")
        event = encoders.one_hot.where(name.isin(list(GIVEN_WEIGHTS))).select(name.alias("name"), "position").distinct()
        # One row per given weight at most.
        known = event.agg(F.map_from_entries(F.collect_list(F.struct("name", "position")))).scalar()
        places = F.transform("features", lambda f: F.try_element_at("known", f)).alias("positions")
        models = given.models.withColumn("known", known).select(*given.models.columns, places)
        return Registry(encoders, stage(models, "models"))

    return _once(spark, folder, "given-block-registry", make)


def score_block(spark: SparkSession, folder: str) -> DataFrame:
    """`score_one_day` with one-hot positions."""
    return forecasting.score_one_day(production_rows(spark, folder), _given_block_registry(spark, folder))


def forecast_block(spark: SparkSession, folder: str) -> DataFrame:
    """`recursive_forecast` with one-hot positions."""
    return forecasting.recursive_forecast(production_rows(spark, folder), _given_block_registry(spark, folder))


def score_one_day(spark: SparkSession, folder: str) -> DataFrame:
    return forecasting.score_one_day(production_rows(spark, folder), _given_registry(spark, folder))


def evaluate_holdout(spark: SparkSession, folder: str) -> DataFrame:
    return forecasting.evaluate(holdout_rows(spark, folder), _given_registry(spark, folder))


def fit_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare(work_rows(spark, folder))
    return forecasting.fit_versus_actual(prepared, _given_registry(spark, folder)).drop(*SERIES)


def recursive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return forecasting.recursive_forecast(production_rows(spark, folder), _given_registry(spark, folder))


def _naive(rows: DataFrame) -> DataFrame:
    """Forecast by the mean of the 15 days before, cut to whole units."""
    rolled = features.add_rolling(rows, (SALES_LAGS,))
    known = rolled.where(F.col(f"sales_rollmean_{SALES_LAGS}").isNotNull())
    return known.select(
        *KEY, "sales", F.col(f"sales_rollmean_{SALES_LAGS}").cast("int").alias("prediction")
    )


def mae(spark: SparkSession, folder: str) -> DataFrame:
    return mean_absolute_error(_naive(retail.panel(spark, folder).select(*KEY, "sales")))


def apply_forecast(spark: SparkSession, folder: str) -> DataFrame:
    totals = retail.day_totals(spark, folder)
    last = totals.agg(F.max("date").alias("last")).scalar()
    rows = stage(retail.panel_of(totals).select(*KEY, "sales"), "panel")
    forecast = _naive(rows).where(F.date_diff(last, F.col("date")) < HORIZON)
    return P.overwrite_sales(rows, forecast)


# Files


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = model_rows(retail.panel(spark, folder))
    for sep in (",", ";"):
        path = _new_path(spark, "csv")
        tables.write_csv(rows, path, sep)
        rows = tables.read_csv(spark, path, MODEL_SCHEMA, sep)
    return rows


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written as text, some spoilt, and read again: those that parse, and the others
    with the reason."""
    rows, day = model_rows(retail.panel(spark, folder)), F.day("date")
    spoilt = rows.select(
        F.when(day == 21, "some day").otherwise(F.col("date").cast("string")).alias("date"),
        *[c for c in MODEL_COLUMNS if c not in ("date", "sales")],
        F.when(day == 13, "n/a").otherwise(F.col("sales").cast("string")).alias("sales"),
        F.date_format("date", "yyyyMMdd").alias("line"),
    )
    path = _new_path(spark, "csv")
    tables.write_csv(spoilt, path)
    good, bad = tables.read_csv_apart(spark, path, T.StructType([*MODEL_SCHEMA.fields, T.StructField("line", T.StringType())]))
    fields = F.split("record", ",")
    at = lambda name: F.element_at(fields, [*MODEL_COLUMNS, "line"].index(name) + 1).alias(name)
    told = bad.select(at("store_id"), at("item_id"), F.element_at(fields, -1).alias("line"), "reason")
    return good.select(*SERIES, "line", F.lit(None).cast("string").alias("reason")).unionByName(told)


def stage_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = _new_path(spark, "stage")
    tables.write_stage(retail.panel(spark, folder), path, ["store_id"])
    return tables.read_stage(spark, path)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        src_tables,
        unpivot_sales,
        join_calendar,
        join_prices,
        analytic_table,
        temporal_split,
        missing_days,
        series_gaps,
        semi_filter,
        sorted_head,
        series_key,
        drop_oldest_day,
        tail_per_series,
        profile_columns,
        merged_profile,
        duplicate_rows,
        value_counts,
        event_crosstab,
        days_per_year,
        null_price_by_item,
        null_price_by_sales,
        price_counts_by_item,
        numeric_summary,
        outlier_bounds,
        outlier_counts,
        impute_mode_price,
        clean_table,
        category_frequencies,
        sales_by_day,
        pivot_sales_by_item,
        sales_by_store_day_item,
        price_by_day_item,
        sales_distribution,
        stockout_flags,
        lag_features,
        rolling_features,
        features_full,
        onehot_event,
        onehot_unseen,
        target_encode,
        target_encode_unseen,
        target_encode_folds,
        target_encode_past,
        encoded_table,
        encoded_pooled,
        encoder_roundtrip,
        mutual_information,
        feature_ranking,
        ts_folds,
        neighbour_information,
        hyper_search,
        train_boosted,
        boosted_search,
        boosted_forecast,
        train_per_series,
        model_roundtrip,
        train_block,
        score_block,
        forecast_block,
        score_one_day,
        evaluate_holdout,
        fit_vs_actual,
        recursive_forecast,
        mae,
        apply_forecast,
        csv_roundtrip,
        csv_quarantine,
        stage_roundtrip,
    )
} | {
    "season_month": _season("month"),
    "season_weekday": _season("weekday"),
    "season_event": _season("event_name_1"),
    "season_event_type": _season("event_type_1"),
}


def registered() -> dict[str, Query]:
    def tuned(query: Query) -> Query:
        return lambda spark, folder: query(tune(spark), folder)

    return {name: tuned(query) for name, query in QUERIES.items()}
