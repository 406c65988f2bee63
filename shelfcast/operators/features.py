"""Lag, rolling and stock-out features of each store-item series.

Every window here is partitioned by the series. A series has one row per day, so
the rows that meet in one place are bounded by the length of the calendar.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.functions.history import all_zero, history_features, rolling
from shelfcast.operators.panel import with_series_id
from shelfcast.schema import PRICE_LAGS, ROLLING_SPANS, SALES_LAGS, SERIES, STOCKOUT_SPANS


def in_series(keys: list[str] = SERIES):
    return W.partitionBy(*keys).orderBy("date")


def lags(column: str | Column, name: str, depth: int) -> list[Column]:
    return [F.lag(column, k).over(in_series()).alias(f"{name}_lag_{k}") for k in range(1, depth + 1)]


def lag_columns(name: str, depth: int) -> list[Column]:
    return [F.col(f"{name}_lag_{k}") for k in range(1, depth + 1)]


def add_lags(df: DataFrame, depths: dict[str, int]) -> DataFrame:
    """The 1st to k-th previous value of each column, by row."""
    return df.select("*", *[c for name, depth in depths.items() for c in lags(name, name, depth)])


def add_stockouts(df: DataFrame, spans: tuple[int, ...] = STOCKOUT_SPANS) -> DataFrame:
    """1 when this and the previous n-1 rows sold nothing; 0 on a short history."""
    depth = max(spans) - 1
    recent = [F.col("sales"), *lag_columns("sales", depth)]
    flags = [all_zero(recent, n).alias(f"stockout_{n}") for n in spans]
    return add_lags(df, {"sales": depth}).select(*df.columns, *flags)


def add_rolling(df: DataFrame, spans: tuple[int, ...] = ROLLING_SPANS) -> DataFrame:
    """Minimum, mean and maximum of the k previous rows; null until k rows exist.

    Computed from the lags: one window pass for all spans, and the rest is plain
    arithmetic on the row.
    """
    recent = lag_columns("sales", max(spans))
    columns = []
    for name, value in rolling(recent, spans).items():
        complete = reduce(and_, [c.isNotNull() for c in recent[: int(name.rsplit("_", 1)[1])]])
        columns.append(F.when(complete, value).alias(name))
    return add_lags(df, {"sales": max(spans)}).select(*df.columns, *columns)


def feature_names() -> list[str]:
    """The numeric features, in their fixed order."""
    stub = F.lit(None)
    return list(history_features([stub] * SALES_LAGS, [stub] * PRICE_LAGS, STOCKOUT_SPANS, ROLLING_SPANS))


def build_features(df: DataFrame) -> DataFrame:
    """Model rows of every series: past values only, rows with a gap removed.

    One exchange, one sort and one window serve all features. A feature is null
    only where one of the lags it is made from is, so the rows are dropped on the
    lags, before the wide projection.
    """
    lagged = add_lags(df, {"sell_price": PRICE_LAGS, "sales": SALES_LAGS}).na.drop("any")
    features = history_features(
        lag_columns("sales", SALES_LAGS),
        lag_columns("sell_price", PRICE_LAGS),
        STOCKOUT_SPANS,
        ROLLING_SPANS,
    )
    kept = [c for c in lagged.columns if c != "sell_price"]
    # Lags keep their own columns: an alias of each would make the optimizer derive
    # the null filter anew for every subset of them.
    computed = [c.alias(name) for name, c in features.items() if name not in kept]
    return with_series_id(lagged.select(*kept, *computed))
