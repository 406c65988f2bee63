"""Column names and types shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ["store_id", "item_id"]
TARGET = "sales"

# Identifier columns that lead the wide sales table; every other column is a day.
WIDE_IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

PANEL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("dept_id", T.StringType()),
        T.StructField("cat_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.IntegerType()),
        T.StructField("d", T.StringType()),
        T.StructField("sales", T.IntegerType()),
        T.StructField("sell_price", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("wday", T.IntegerType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
        T.StructField("event_name_2", T.StringType()),
        T.StructField("event_type_2", T.StringType()),
    ]
)
PANEL_COLUMNS = PANEL_SCHEMA.fieldNames()

# What training and forecasting read from the panel.
MODEL_COLUMNS = [
    "date",
    "store_id",
    "item_id",
    "event_name_1",
    "month",
    "sell_price",
    "wday",
    "weekday",
    "sales",
]
MODEL_SCHEMA = T.StructType([PANEL_SCHEMA[c] for c in MODEL_COLUMNS])

# Integers that stand for categories rather than amounts.
CATEGORICAL_INTEGERS = ["year", "month", "wday"]

NO_EVENT = "Sin_evento"

ONE_HOT_COLUMNS = ["event_name_1"]
TARGET_ENCODED_COLUMNS = ["month", "wday", "weekday"]

SALES_LAGS = 15
PRICE_LAGS = 7
STOCKOUT_SPANS = (3, 7, 15)
ROLLING_SPANS = tuple(range(2, 16))

HORIZON = 8
"""Days in one forecast."""
