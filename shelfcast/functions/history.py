"""Column expressions over the latest values of a series, newest first.

They take plain columns, so the same expression serves lag columns from a window
and the moving history of a recursive forecast.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_zero(recent: list[Column], span: int) -> Column:
    """1 when the newest `span` values are all zero; a missing value is not zero."""
    if len(recent) < span:
        raise ValueError(f"{span} values needed, {len(recent)} given")
    zeros = [F.coalesce(c == 0, F.lit(False)) for c in recent[:span]]
    return F.when(reduce(lambda a, b: a & b, zeros), 1).otherwise(0)


def rolling(recent: list[Column], spans: tuple[int, ...]) -> dict[str, Column]:
    """Minimum, mean and maximum of the newest k values for every span.

    Each span extends the one before it, so a value is compared and added once per
    row. The history must be complete: `least` and `greatest` pass over nulls.
    """
    low, total, high = recent[0], recent[0], recent[0]
    found: dict[tuple[str, int], Column] = {}
    for k, value in enumerate(recent[1 : max(spans)], 2):
        low, total, high = F.least(low, value), total + value, F.greatest(high, value)
        found |= {("rollmin", k): low, ("rollmean", k): total / F.lit(float(k)), ("rollmax", k): high}
    return {
        f"sales_{kind}_{k}": found[kind, k] for kind in ("rollmin", "rollmean", "rollmax") for k in spans
    }


def history_features(
    sales: list[Column],
    prices: list[Column],
    stockout_spans: tuple[int, ...],
    rolling_spans: tuple[int, ...],
) -> dict[str, Column]:
    """All features of one day from the complete values of the days before it."""
    features = {f"sell_price_lag_{k}": c for k, c in enumerate(prices, 1)}
    for span in stockout_spans:
        features[f"stockout_{span}_lag_1"] = all_zero(sales, span)
    for k, c in enumerate(sales, 1):
        features[f"sales_lag_{k}"] = c
    return features | rolling(sales, rolling_spans)
