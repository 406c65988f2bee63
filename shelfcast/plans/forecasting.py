"""Scoring with a trained registry: one day, a hold-out, or a recursive forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.history import history_features
from shelfcast.operators.encoding import folded_one_hot, folded_positions, folded_target_encoding, positions_in
from shelfcast.operators.features import feature_names
from shelfcast.operators.panel import keep_oldest_day, last_rows
from shelfcast.operators.training import (
    aligned,
    mean_absolute_error,
    predicted,
    score,
)
from shelfcast.plans.preparation import encode, encode_block, encoded_feature_names, prepare
from shelfcast.plans.retraining import Registry
from shelfcast.schema import (
    HORIZON,
    NO_EVENT,
    ONE_HOT_COLUMNS,
    PRICE_LAGS,
    ROLLING_SPANS,
    SALES_LAGS,
    SERIES,
    STOCKOUT_SPANS,
    TARGET_ENCODED_COLUMNS,
)


def score_rows(features: DataFrame, registry: Registry) -> DataFrame:
    """With models on a one-hot block no category is collected."""
    if "positions" in registry.models.columns:
        return score(encode_block(features, registry.encoders), registry.models, encoded_feature_names({}))
    categories = registry.encoders.categories()
    encoded = encode(features, registry.encoders, categories)
    return score(encoded, registry.models, encoded_feature_names(categories))


def score_one_day(rows: DataFrame, registry: Registry) -> DataFrame:
    """Predictions for the earliest day that has a full history; null without a model."""
    return score_rows(keep_oldest_day(prepare(rows)), registry).drop(*SERIES)


def evaluate(rows: DataFrame, registry: Registry) -> DataFrame:
    """Mean absolute error of that one day."""
    return mean_absolute_error(score_one_day(rows, registry))


def fit_versus_actual(features: DataFrame, registry: Registry, newest: int = 100) -> DataFrame:
    """Predicted next to sold for the newest training rows of every series."""
    return last_rows(score_rows(features, registry), newest)


def step_prices(rows: DataFrame, offset, steps: int) -> DataFrame:
    """Per item, the most frequent price of the rows still in use at each step.

    Step s no longer sees the s oldest days. Prices are counted per item and day
    position first, so the repetition over steps is of counts, not of rows.
    """
    counts = (
        rows.where(F.col("sell_price").isNotNull())
        .groupBy("item_id", "sell_price", F.least(offset, F.lit(steps - 1)).alias("day"))
        .agg(F.count("*").alias("n"))
        .select("item_id", "sell_price", "n", F.explode(F.sequence(F.lit(0), F.col("day"))).alias("step"))
        .groupBy("item_id", "step", "sell_price")
        .agg(F.sum("n").alias("n"))
    )
    best = F.max_by("sell_price", F.struct(F.col("n"), -F.col("sell_price")))
    return (
        counts.groupBy("item_id", "step")
        .agg(best.alias("price"))
        .groupBy("item_id")
        .agg(F.array(*[F.max(F.when(F.col("step") == s, F.col("price"))) for s in range(steps)]).alias("_modes"))
    )


def forecast_days(rows: DataFrame, registry: Registry, steps: int = HORIZON) -> DataFrame:
    """The next days of every series, each predicted from the ones before it.

    A series becomes one row: its 15 days of history and the days to come. The
    recursion is a fold over the days to come that puts each prediction in front of
    the history. A series with a day missing from its history has no forecast.
    """
    first = rows.agg(F.min("date").alias("first")).scalar()
    span = SALES_LAGS + steps
    placed = rows.withColumn("_at", F.date_diff("date", first))
    day = F.struct("sales", "sell_price", "event_name_1", *TARGET_ENCODED_COLUMNS)
    packed = (
        placed.where(F.col("_at") < span)
        .groupBy(*SERIES)
        .agg(F.map_from_entries(F.collect_list(F.struct("_at", day))).alias("_days"))
        .join(step_prices(placed, F.col("_at"), steps), "item_id", "left")
    )
    encoders = registry.encoders
    by_position = "positions" in registry.models.columns
    categories = {} if by_position else encoders.categories()
    names = encoded_feature_names(categories)
    seen = folded_positions if by_position else folded_one_hot
    known_days = (
        packed.join(aligned(registry.models, names), SERIES)
        .join(seen(encoders.one_hot, ONE_HOT_COLUMNS), SERIES, "left")
        .join(folded_target_encoding(encoders.target, TARGET_ENCODED_COLUMNS), SERIES, "left")
    )

    def on(position: Column | int) -> Column:
        return F.try_element_at("_days", F.lit(position) if isinstance(position, int) else position)

    def day_to_come(step: Column) -> Column:
        target = step + SALES_LAGS
        prices = [
            F.coalesce(on(target - k)["sell_price"], F.get("_modes", step)) for k in range(1, PRICE_LAGS + 1)
        ]
        event = F.coalesce(on(target)["event_name_1"], F.lit(NO_EVENT)).alias("event_name_1")
        codes = [on(target)[c].cast("string").alias(c) for c in TARGET_ENCODED_COLUMNS]
        return F.struct(F.array(*prices).alias("prices"), event, *codes)

    def predict(recent: Column, day: Column) -> Column:
        history = history_features(
            [F.get(recent, F.lit(k)) for k in range(SALES_LAGS)],
            [F.get(day["prices"], F.lit(k)) for k in range(PRICE_LAGS)],
            STOCKOUT_SPANS,
            ROLLING_SPANS,
        )
        values = [history[f] for f in feature_names()]
        for column, known in categories.items():
            values += [
                F.when((day[column] == v) & F.array_contains(f"_seen_{column}", v), 1.0).otherwise(0.0)
                for v in known
            ]
        for column in TARGET_ENCODED_COLUMNS:
            values.append(F.coalesce(F.try_element_at(f"_map_{column}", day[column]), F.col("_prior")))
        block = positions_in({c: day[c] for c in ONE_HOT_COLUMNS}) if by_position else None
        return predicted(registry.models, values, block)

    history = F.array(*[on(SALES_LAGS - k)["sales"] for k in range(1, SALES_LAGS + 1)])
    to_come = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), day_to_come)
    grown = F.aggregate(
        to_come, history, lambda recent, day: F.concat(F.array(predict(recent, day)), recent)
    )
    return (
        known_days.select(*SERIES, F.posexplode(F.reverse(F.slice(grown, 1, steps))).alias("_step", "prediction"))
        .where(F.col("prediction").isNotNull())
        .select(*SERIES, F.date_add(first, F.col("_step") + SALES_LAGS).alias("date"), "prediction")
    )


KNOWN, FORECAST, NO_MODEL, GAP = "known", "forecast", "no model", "gap in history"


def recursive_forecast(rows: DataFrame, registry: Registry, steps: int = HORIZON) -> DataFrame:
    """The given rows with forecast days filled in and the oldest days dropped.

    `origin` tells what a sale is. A day to come that nothing could be forecast for has no
    sale, whatever stood there, and says why: its series has no model, or a day of its
    history is missing.
    """
    first = rows.agg(F.min("date").alias("first")).scalar()
    placed = F.date_diff("date", first)
    kept = rows.where(placed >= steps)
    models = registry.models.select(*SERIES).distinct().withColumn("_model", F.lit(True))
    joined = kept.join(forecast_days(rows, registry, steps), [*SERIES, "date"], "left").join(models, SERIES, "left")
    to_come = placed >= SALES_LAGS
    origin = (
        F.when(~to_come, KNOWN)
        .when(F.col("prediction").isNotNull(), FORECAST)
        .when(F.col("_model").isNull(), NO_MODEL)
        .otherwise(GAP)
    )
    sales = F.when(to_come, F.col("prediction")).otherwise(F.col("sales"))
    return joined.withColumns({"origin": origin, "sales": sales}).select(*rows.columns, "origin")
