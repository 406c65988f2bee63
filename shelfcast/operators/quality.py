"""Profiling and repair of the analytic table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.schema import CATEGORICAL_INTEGERS, NO_EVENT, SERIES
from shelfcast.session import stage


def columns_by_type(df: DataFrame, numeric: bool) -> list[str]:
    """Numeric columns, or the others; integer codes count as categories."""
    amounts = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in CATEGORICAL_INTEGERS
    ]
    return amounts if numeric else [c for c in df.columns if c not in amounts]


def stacked(df: DataFrame, columns: list[str], as_type: str, keep: list[str] | None = None) -> DataFrame:
    """(variable, value) rows for the given columns, next to the kept ones."""
    keep = keep or []
    cast = df.select(*keep, *[F.col(c).cast(as_type).alias(c) for c in columns])
    return cast.unpivot(keep, columns, "variable", "value")


def value_counts(df: DataFrame, columns: list[str], as_type: str = "string") -> DataFrame:
    """Rows per variable and value, nulls included.

    Counts are combined inside each task before the shuffle, so a value that
    fills a third of the table moves as one row per task.
    """
    return stacked(df, columns, as_type).groupBy("variable", "value").agg(F.count("*").alias("n"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, filled rows, empty rows and exact distinct values of every column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return (
        value_counts(df, df.columns)
        .groupBy("variable")
        .agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
        )
        .select("variable", types[F.col("variable")].alias("type"), "non_null", "nulls", "distinct_values")
    )


def daily_profiles(df: DataFrame, day: str = "date") -> DataFrame:
    """Profile of each column and day, to be stored and merged: counters that add up and a
    sketch of the distinct values; for amounts also their extremes, total and squares."""
    columns = [c for c in df.columns if c != day]
    amounts = columns_by_type(df.select(*columns), numeric=True)
    counted = (
        stacked(df, columns, "string", keep=[day])
        .groupBy(day, "variable")
        .agg(F.count("*").alias("rows"), F.count("value").alias("non_null"), F.hll_sketch_agg("value").alias("distinct"))
    )
    if not amounts:
        return counted
    value = F.col("value")
    measured = (
        stacked(df, amounts, "double", keep=[day])
        .groupBy(day, "variable")
        .agg(F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value).alias("total"), F.kll_sketch_agg_double(value).alias("spread"))
    )
    return counted.join(measured, [day, "variable"], "left")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of any days as one per column: exact counters, extremes and mean, and distinct
    values and median within the bounds of their sketches. No row of the data is read again."""
    merged = profiles.groupBy("variable").agg(
        F.sum("non_null").alias("non_null"),
        (F.sum("rows") - F.sum("non_null")).alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_estimate"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("total").alias("total"),
        F.kll_merge_agg_double("spread").alias("spread"),
    )
    median = F.when(F.col("total").isNotNull(), F.kll_sketch_get_quantile_double("spread", F.lit(0.5)))
    return merged.withColumn("median_estimate", median).drop("spread")


def duplicate_rows(df: DataFrame, compared: dict[str, list[str]]) -> DataFrame:
    """How many rows repeat an earlier row in the columns of each comparison.

    The rows are read once and grouped by the columns of all comparisons; each comparison
    then groups those counts further, by its own columns.
    """
    every = [c for c in df.columns if any(c in columns for columns in compared.values())]
    groups = df.groupBy(*every).agg(F.count("*").alias("_n"))
    if len(compared) > 1:
        groups = stage(groups, "row-groups")
    parts = [
        groups.groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
        .withColumn("compared", F.lit(name))
        for name, columns in compared.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cross_table(df: DataFrame, rows: str, columns: str, labels: list[str]) -> DataFrame:
    """Two-way counts; rows with a null on either side are left out."""
    known = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows).pivot(columns, labels).count().na.fill(0)


def distinct_per_group(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group).agg(F.countDistinct(column).alias("distinct_values"))


def nulls_by(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group).agg(F.count_if(F.col(column).isNull()).alias("nulls"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of known values."""
    known = df.na.drop("any", subset=list(columns))
    return known.groupBy(*columns).agg(F.count("*").alias("n"))


QUARTILES = (0.25, 0.5, 0.75)


CELL_VALUES = 100_000
"""Distinct values a cell of `quantiles` holds, about."""


def quantiles(counts: DataFrame, probabilities: tuple[float, ...], cells: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles from (variable, value, n) rows.

    The distinct values of a variable are cut into about equal cells along an
    approximate quantile sketch. Only the cell totals are summed in one place (at
    most `cells` rows per variable); the order inside a cell is settled cell by
    cell, so no task holds all values. The sketch only balances the work: any cut
    points give the same exact answer.
    """
    counts = counts.where(F.col("value").isNotNull())
    if cells is None:
        # As many as the values of the widest variable need, and enough for all tasks.
        tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        widest = counts.groupBy("variable").count().agg(F.max("count")).first()[0] or 0
        cells = max(2, min(tasks, widest), -(-widest // CELL_VALUES))
    steps = [i / cells for i in range(1, cells)]
    cuts = counts.groupBy("variable").agg(F.percentile_approx("value", steps, 10000).alias("cuts"))
    # One row per variable, of as many cuts as cells; they differ and are in order.
    cuts = cuts.select("variable", F.array_sort(F.array_distinct("cuts")).alias("cuts"))
    below = F.size(F.filter("cuts", lambda p: p < F.col("value")))
    placed = counts.join(F.broadcast(cuts), "variable").withColumn("cell", below).drop("cuts")

    totals = placed.groupBy("variable", "cell").agg(F.sum("n").alias("in_cell"))
    up_to = W.partitionBy("variable").orderBy("cell")
    starts = totals.select(
        "variable",
        "cell",
        (F.sum("in_cell").over(up_to) - F.col("in_cell")).alias("before_cell"),
        F.sum("in_cell").over(W.partitionBy("variable")).alias("rows"),
    )
    in_order = W.partitionBy("variable", "cell").orderBy("value")
    ranked = placed.join(starts, ["variable", "cell"]).withColumn(
        "end", F.col("before_cell") + F.sum("n").over(in_order)
    )
    wanted = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p).alias("p"),
                    F.floor(F.lit(p) * (F.col("rows") - 1)).alias("low"),
                    F.ceil(F.lit(p) * (F.col("rows") - 1)).alias("high"),
                )
                for p in probabilities
            ]
        )
    )
    first = F.col("end") - F.col("n")

    def at(rank: str) -> Column:
        return (F.col(rank) >= first) & (F.col(rank) < F.col("end"))

    hits = (
        ranked.select("variable", "value", "n", "end", "rows", wanted.alias("w"))
        .select("variable", "value", "n", "end", "rows", "w.*")
        .where(at("low") | at("high"))
    )
    share = F.col("p") * (F.col("rows") - 1) - F.col("low")
    return (
        hits.groupBy("variable", "p", "rows", "low")
        .agg(
            F.max(F.when(at("low"), F.col("value"))).alias("below"),
            F.max(F.when(at("high"), F.col("value"))).alias("above"),
        )
        .select(
            "variable",
            "p",
            (F.col("below") + (F.col("above") - F.col("below")) * share).alias("quantile"),
        )
    )


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, median, spread, range and quartiles of each numeric column.

    The table is read once, to count its values; the rest works on those counts.
    """
    counts = stage(value_counts(df, columns, "double"), "value-counts")
    known = counts.where(F.col("value").isNotNull())
    basics = known.groupBy("variable").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row of basics per column, so this side is as small as the column list.
    deviation = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2))
    moments = (
        known.join(F.broadcast(basics), "variable")
        .groupBy("variable", "count", "mean", "min", "max")
        .agg(F.sqrt(deviation / F.nullif(F.col("count") - 1, F.lit(0))).alias("std"))
    )
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    wide = (
        quantiles(counts, QUARTILES)
        .groupBy("variable")
        .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n) for p, n in names.items()])
    )
    return moments.join(wide, "variable", "left").select(
        "variable", "count", "mean", "median", "std", "min", "q25", "q75", "max"
    )


def _bounds_of(counts: DataFrame, deviations: float) -> DataFrame:
    """Bounds per variable from its distinct values and how often each occurs."""
    known = counts.where(F.col("value").isNotNull())
    means = known.groupBy("variable").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("rows")
    )
    # One row per column that was asked for.
    squares = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2))
    spread = F.sqrt(squares / F.col("rows")) * deviations
    return (
        known.join(F.broadcast(means), "variable")
        .groupBy("variable", "mean", "rows")
        .agg(spread.alias("spread"))
        .select("variable", "mean", (F.col("mean") - F.col("spread")).alias("lower"), (F.col("mean") + F.col("spread")).alias("upper"))
    )


def outlier_bounds(df: DataFrame, columns: list[str], deviations: float = 4) -> DataFrame:
    """Mean plus and minus so many population deviations, per column."""
    return _bounds_of(stage(value_counts(df, columns, "double"), "value-counts"), deviations)


def outlier_counts(df: DataFrame, columns: list[str], deviations: float = 4) -> DataFrame:
    """How often each value outside the bounds occurs.

    The table is read once, to count its values. Bounds are one row per column, so the
    counts stay where they are.
    """
    counts = stage(value_counts(df, columns, "double"), "value-counts")
    return (
        counts.join(F.broadcast(_bounds_of(counts, deviations)), "variable")
        .where((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
        .select("variable", "value", "n")
    )


def fill_events(df: DataFrame, columns: list[str], label: str = NO_EVENT) -> DataFrame:
    return df.na.fill({c: label for c in columns})


def most_frequent(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """The most frequent known value per group; the lowest one on a tie.

    Values are counted first, so what meets in a group is its distinct values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.sum("n").alias("n"))
    best = F.max_by(F.col(column), F.struct(F.col("n"), -F.col(column)))
    return counts.groupBy(*by).agg(best.alias("_mode"))


def fill_by_mode(
    df: DataFrame, column: str = "sell_price", by: str = "item_id", keys: list[str] = SERIES
) -> DataFrame:
    """Fill nulls with the group's most frequent value; a group of nulls stays null.

    The value is first handed to the group's series and then joined on the series
    key. The big side therefore moves on the evenly spread key its windows need
    anyway, never on the group, which may be hot.
    """
    counts = df.groupBy(*keys, column).agg(F.count("*").alias("n"))
    series = counts.select(*keys).distinct()
    per_series = series.join(most_frequent(counts, [by], column), by).select(*keys, "_mode")
    return (
        df.join(per_series, keys, "left")
        .withColumn(column, F.coalesce(column, "_mode"))
        .drop("_mode")
        .select(*df.columns)
    )


def as_categories(df: DataFrame, columns: list[str] = CATEGORICAL_INTEGERS) -> DataFrame:
    """Integer codes turned into the categories they stand for."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})


def clean(df: DataFrame) -> DataFrame:
    """No null event names, no null prices; integer codes are left to `as_categories`."""
    events = [c for c in ("event_name_1", "event_type_1") if c in df.columns]
    dropped = [c for c in ("event_name_2", "event_type_2") if c in df.columns]
    return fill_by_mode(fill_events(df.drop(*dropped), events))
