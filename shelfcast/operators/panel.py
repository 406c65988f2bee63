"""From source tables to one row per store, item and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.schema import PANEL_COLUMNS, SERIES


def melt_days(wide: DataFrame, ids: list[str], name: str = "d", value: str = "sales") -> DataFrame:
    """Every non-id column becomes a row; empty cells are kept.

    The day columns travel as one array and are exploded: the plan stays two
    nodes however many thousand day columns there are.
    """
    held = set(ids)
    days = [c for c in wide.columns if c not in held]
    labels = F.array(*[F.lit(c) for c in days])
    cells = F.posexplode(F.array(*[F.col(f"`{c}`") for c in days])).alias("_at", value)
    return wide.select(*ids, cells).select(
        *ids, F.get(labels, F.col("_at")).alias(name), value
    )


def spread(df: DataFrame, keys: list[str] = SERIES, partitions: int | None = None) -> DataFrame:
    """Spread series over partitions: so many, or what adaptive execution makes of them."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


DENSE_ROWS = 40_000
"""Dense rows a task of `densify` makes, about; a series stays in one task."""


def densify(daily: DataFrame, days: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Give every series a row for every day of the calendar, zero where none sold.

    The number of partitions follows the rows that come out, series times days: adaptive
    execution would size them by the few sparse rows that enter.

    Each row is stretched to the day before the next one, so the gaps are filled
    inside the series' own partition: no series-by-day product is joined, and the
    result stays partitioned by the series for the windows that follow.
    """
    first = days.agg(F.min("date").alias("first")).scalar()
    last = days.agg(F.max("date").alias("last")).scalar()
    order = W.partitionBy(*keys).orderBy("date")
    series = daily.select(*keys).distinct().count()
    partitions = max(1, min(series, -(-series * days.count() // DENSE_ROWS)))
    inside = spread(daily.where(F.col("date").between(first, last)), keys, partitions)
    stretched = inside.select(
        *keys,
        "date",
        "sales",
        F.when(F.lag("date").over(order).isNull(), first).otherwise(F.col("date")).alias("_from"),
        F.coalesce(F.date_sub(F.lead("date").over(order), 1), last).alias("_to"),
    )
    return stretched.select(
        *keys, "date", "sales", F.explode(F.sequence("_from", "_to")).alias("_day")
    ).select(
        *keys,
        F.col("_day").alias("date"),
        F.when(F.col("_day") == F.col("date"), F.col("sales")).otherwise(0).alias("sales"),
    )


def gap_intervals(days: DataFrame, first: Column, last: Column, keys: list[str] = SERIES) -> DataFrame:
    """Stretches of days between `first` and `last` that a series has no row for: first_date,
    last_date and days of each. A day with several rows counts once."""
    in_order = W.partitionBy(*keys).orderBy("date")
    around = days.select(*keys, "date", F.lag("date").over(in_order).alias("_before"), F.lead("date").over(in_order).alias("_after"))

    def stretch(start: Column, end: Column) -> Column:
        return F.struct(start.alias("first_date"), end.alias("last_date"), (F.date_diff(end, start) + 1).alias("days"))

    after = stretch(F.date_add("date", 1), F.coalesce(F.date_sub("_after", 1), last))
    before = F.when(F.col("_before").isNull(), stretch(first, F.date_sub("date", 1)))
    found = around.select(*keys, F.explode(F.array(before, after)).alias("gap"))
    return found.where("gap.days > 0").select(*keys, "gap.*")


def attach_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the day label; Spark broadcasts the calendar while it is small."""
    return sales.join(calendar, "d", "left")


def attach_prices(sales: DataFrame, prices: DataFrame) -> DataFrame:
    return sales.join(prices, [*SERIES, "wm_yr_wk"], "left")


def analytic_table(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    return attach_prices(attach_calendar(sales, calendar), prices).select(*PANEL_COLUMNS)


def before(df: DataFrame, day: Column) -> DataFrame:
    return df.where(F.col("date") < day)


def between(df: DataFrame, first: Column, last: Column) -> DataFrame:
    return df.where(F.col("date").between(first, last))


def temporal_split(df: DataFrame, first: Column, last: Column) -> tuple[DataFrame, DataFrame]:
    """Work rows before the hold-out, hold-out rows inside it; later rows in neither."""
    return before(df, first), between(df, first, last)


def missing_days(df: DataFrame, first: str, last: str) -> DataFrame:
    """Days of a range that never occur in the table."""
    expected = df.sparkSession.sql(
        "SELECT explode(sequence(to_date(:a), to_date(:b))) AS date", args={"a": first, "b": last}
    )
    return expected.join(df.select("date").distinct(), "date", "left_anti")


def keep_known(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in another table."""
    return df.join(known.select(*on), on, "left_semi")


def with_series_id(df: DataFrame) -> DataFrame:
    return df.withColumn("series_id", F.concat_ws("_", *SERIES))


def split_series_id(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Undo the key: cut it behind the store it begins with.

    Store names may hold the separator themselves, so the cut is looked up: a key is offered
    at each of its separators, and joins where the part before is a store. Of several such
    stores the longest is taken.
    """
    parts = F.split("series_id", "_")
    cuts = F.sequence(F.lit(1), F.size(parts) - 1)
    offered = df.where(F.size(parts) > 1).select("*", F.explode(cuts).alias("_cut"))
    cut = offered.select(
        *df.columns,
        F.array_join(F.slice(parts, 1, F.col("_cut")), "_").alias("store_id"),
        F.array_join(F.slice(parts, F.col("_cut") + 1, F.size(parts)), "_").alias("item_id"),
    )
    known = cut.join(stores.select("store_id").distinct(), "store_id", "left_semi")
    best = F.max_by(F.struct("store_id", "item_id"), F.length("store_id")).alias("_best")
    return known.groupBy(*df.columns).agg(best).select(*df.columns, "_best.*")


def drop_oldest_day(df: DataFrame, oldest: Column | None = None) -> DataFrame:
    """All days but the first; a caller that knows it spares a pass."""
    oldest = df.agg(F.min("date").alias("oldest")).scalar() if oldest is None else oldest
    return df.where(F.col("date") > oldest)


def keep_oldest_day(df: DataFrame) -> DataFrame:
    oldest = df.agg(F.min("date").alias("oldest")).scalar()
    return df.where(F.col("date") == oldest)


def last_rows(df: DataFrame, n: int, keys: list[str] = SERIES) -> DataFrame:
    """The newest n rows of every series."""
    newest = W.partitionBy(*keys).orderBy(F.col("date").desc())
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")


def overwrite_sales(df: DataFrame, forecast: DataFrame) -> DataFrame:
    """Replace sales by the forecast of the same store, item and day."""
    values = forecast.select(*SERIES, "date", "prediction")
    return (
        df.join(values, [*SERIES, "date"], "left")
        .withColumn("sales", F.coalesce("prediction", "sales"))
        .drop("prediction")
    )
