"""Calendar, sales and price tables derived from the order tables.

A store is a sales region, an item is a brand, a sale is a shipped quantity.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.panel import analytic_table, densify
from shelfcast.schema import SERIES, WIDE_IDS
from shelfcast.session import stage
from shelfcast.sources.tables import read_table

# Yearly events as (month and day, name, type).
EVENTS = [
    ("01-01", "NewYear", "National"),
    ("07-04", "Independence", "National"),
    ("10-31", "Halloween", "Cultural"),
    ("12-25", "Christmas", "Cultural"),
]
SECOND_EVENTS = [("07-04", "Parade", "Cultural"), ("12-25", "YearEnd", "National")]


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shipped line: store, item, day, quantity and price."""
    stores = (
        read_table(spark, folder, "supplier")
        .join(read_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("store_id"))
    )
    items = read_table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("item_id"))
    return (
        read_table(spark, folder, "lineitem")
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(items, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            *SERIES,
            F.to_date("l_shipdate").alias("date"),
            "l_quantity",
            "l_extendedprice",
        )
    )


def day_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Units and lowest unit price per store, item and day, written once.

    The one pass over the lines: sales, prices and the calendar all come from this table,
    which has one row per key, however hot the key is.
    """
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    totals = (
        shipments(spark, folder)
        .groupBy(*SERIES, "date")
        .agg(F.sum("l_quantity").cast("int").alias("sales"), F.min(unit_price).alias("unit_price"))
    )
    return stage(totals, "days")


def daily_sales(totals: DataFrame) -> DataFrame:
    """Units per store, item and day."""
    return totals.select(*SERIES, "date", "sales")


def _by_day(events: list[tuple[str, str, str]], field: int):
    month_day = F.date_format("date", "MM-dd")
    value = F.lit(None).cast("string")
    for event in events:
        value = F.when(month_day == event[0], event[field]).otherwise(value)
    return value


def week_key(day: str = "date"):
    return (
        F.expr(f"extract(YEAROFWEEK FROM {day})") * 100 + F.weekofyear(day)
    ).cast("int")


def calendar(totals: DataFrame) -> DataFrame:
    """One row per day between the first and the last shipment."""
    days = totals.agg(F.min("date").alias("first"), F.max("date").alias("last")).select(
        "first", F.explode(F.sequence("first", "last")).alias("date")
    )
    return days.select(
        F.concat(F.lit("d_"), F.date_diff("date", "first") + 1).alias("d"),
        "date",
        week_key().alias("wm_yr_wk"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofweek("date").alias("wday"),
        F.date_format("date", "EEEE").alias("weekday"),
        _by_day(EVENTS, 1).alias("event_name_1"),
        _by_day(EVENTS, 2).alias("event_type_1"),
        _by_day(SECOND_EVENTS, 1).alias("event_name_2"),
        _by_day(SECOND_EVENTS, 2).alias("event_type_2"),
    )


def sell_prices(totals: DataFrame) -> DataFrame:
    """Weekly price per store and item; a week without sales has no row."""
    return totals.groupBy(*SERIES, week_key().alias("wm_yr_wk")).agg(
        (F.floor(F.min("unit_price") / 100) * 100).cast("double").alias("sell_price")
    )


def _with_groups(df: DataFrame) -> DataFrame:
    number = F.regexp_extract("item_id", r"(\d+)$", 1).cast("int")
    return df.withColumns(
        {
            "state_id": F.substring("store_id", 1, 2),
            "dept_id": F.concat(F.lit("DEPT_"), number % 7),
            "cat_id": F.concat(F.lit("CAT_"), number % 3),
        }
    )


def sales_long(totals: DataFrame) -> DataFrame:
    """Dense daily sales: the wide table after it is turned into rows."""
    days = calendar(totals).select("date")
    dense = densify(daily_sales(totals), days)
    first = days.agg(F.min("date").alias("first")).scalar()
    label = F.concat(F.lit("d_"), F.date_diff("date", first) + 1)
    return _with_groups(dense.select(*SERIES, label.alias("d"), "sales"))


def sales_wide(totals: DataFrame) -> DataFrame:
    """One row per series and one column per day.

    The column names are the day labels, so the two ends of the calendar are
    fetched when the plan is made.
    """
    first, last = totals.agg(F.min("date"), F.max("date")).first()
    labels = day_labels(first, last)
    labelled = totals.select(
        *SERIES,
        F.concat(F.lit("d_"), F.date_diff("date", F.lit(first)) + 1).alias("d"),
        "sales",
    )
    wide = labelled.groupBy(*SERIES).pivot("d", labels).agg(F.sum("sales").cast("int")).na.fill(0)
    ids = _with_groups(wide).withColumn("id", F.concat_ws("_", "item_id", "store_id"))
    return ids.select(*WIDE_IDS, *labels)


def day_labels(first: date, last: date) -> list[str]:
    span: timedelta = last - first
    return [f"d_{n}" for n in range(1, span.days + 2)]


def panel_of(totals: DataFrame) -> DataFrame:
    """The analytic table over every store, item and day."""
    return analytic_table(sales_long(totals), calendar(totals), sell_prices(totals))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return panel_of(day_totals(spark, folder))
