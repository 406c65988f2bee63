"""Aggregates for looking at the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.quality import value_counts


def category_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of each known value among the known values of its column."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    totals = counts.groupBy("variable").agg(F.sum("n").alias("rows"))
    # One total per column: as many rows as columns were asked for.
    return counts.join(F.broadcast(totals), "variable").select(
        "variable", "value", (F.col("n") / F.col("rows")).alias("frequency")
    )


def total_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("sales").alias("sales"))


def mean_by(df: DataFrame, column: str, *keys: str) -> DataFrame:
    known = df.na.drop("any", subset=list(keys))
    return known.groupBy(*keys).agg(F.avg(column).alias(f"mean_{column}"))


def side_by_side(grouped: DataFrame, key: str, across: str, value: str, labels: list[str]) -> DataFrame:
    """One column per label of `across`; the labels are given, not searched for."""
    return grouped.groupBy(key).pivot(across, labels).agg(F.first(value))


def labels_of(df: DataFrame, column: str) -> list[str]:
    """The values a caller wants as columns. `total_by` gives the same cells as rows, which
    needs no labels and is the form for a catalogue of any size."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def sales_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("sales").agg(F.count("*").alias("n"))


def sorted_head(df: DataFrame, by: list[str], n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)

