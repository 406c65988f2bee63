"""Ranking features by how much they tell about the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.schema import SERIES, TARGET

BINS = 10
KEPT_FEATURES = 70


def mutual_information(
    df: DataFrame, features: list[str], target: str = TARGET, bins: int = BINS, keys: list[str] = SERIES
) -> DataFrame:
    """Mutual information of each feature with the target, per series.

    Both sides are cut into equally frequent bins by rank, equal values always in
    the same bin. The long rows are counted by value as they are made and all
    groups carry the series key, so rows already spread by series do not move.
    """
    by_target = W.partitionBy(*keys).orderBy(target)
    placed = (
        df.select(
            *keys,
            F.rank().over(by_target).alias("rank"),
            F.array(*[F.col(f).cast("double") for f in features]).alias("values"),
        )
        .select("*", F.count("*").over(W.partitionBy(*keys)).alias("rows"))
        .withColumn("ybin", F.floor(bins * (F.col("rank") - 1) / F.col("rows")).cast("int"))
    )
    # Exploding an array keeps rows where their series is; an unpivot would not.
    counted = (
        placed.select(*keys, "rows", "ybin", F.posexplode("values").alias("at", "x"))
        .groupBy(*keys, "at", "x", "ybin", "rows")
        .agg(F.count("*").alias("n"))
    )
    same = W.partitionBy(*keys, "at")
    up_to = same.orderBy("x").rangeBetween(W.unboundedPreceding, W.currentRow)
    smaller = F.sum("n").over(up_to) - F.sum("n").over(W.partitionBy(*keys, "at", "x"))
    cells = (
        counted.withColumn("xbin", F.floor(bins * smaller / F.col("rows")).cast("int"))
        .groupBy(*keys, "at", "rows", "xbin", "ybin")
        .agg(F.sum("n").alias("n"))
    )
    n_x = F.sum("n").over(W.partitionBy(*keys, "at", "xbin"))
    n_y = F.sum("n").over(W.partitionBy(*keys, "at", "ybin"))
    terms = cells.select(*keys, "at", "rows", "n", n_x.alias("n_x"), n_y.alias("n_y"))
    share = F.col("n") / F.col("rows")
    scores = terms.groupBy(*keys, "at").agg(
        F.sum(share * F.ln(F.col("n") * F.col("rows") / (F.col("n_x") * F.col("n_y")))).alias(
            "mutual_information"
        )
    )
    names = F.array(*[F.lit(f) for f in features])
    return scores.select(*keys, F.get(names, F.col("at")).alias("feature"), "mutual_information")


def one_hot_information(
    df: DataFrame, state: DataFrame, target: str = TARGET, bins: int = BINS, keys: list[str] = SERIES
) -> DataFrame:
    """`mutual_information` of each category with the target, from rows that hold the positions
    of their ones (`one_hot`), whatever the width of the block.

    Only the ones are counted; the zeros are what is left of a key's counts by bin of the
    target. A category that a key never has tells it nothing and has no row.
    """
    of_key = W.partitionBy(*keys)
    rank = F.rank().over(of_key.orderBy(target))
    placed = df.select(*keys, "one_hot", rank.alias("rank"), F.count("*").over(of_key).alias("rows")).select(
        *keys, "one_hot", "rows", F.floor(bins * (F.col("rank") - 1) / F.col("rows")).cast("int").alias("ybin")
    )
    in_bin = F.collect_list(F.struct("ybin", "n"))
    totals = placed.groupBy(*keys, "rows", "ybin").agg(F.count("*").alias("n")).groupBy(*keys, "rows").agg(in_bin.alias("all"))
    ones = (
        placed.select(*keys, "ybin", F.explode("one_hot").alias("position"))
        .groupBy(*keys, "position", "ybin")
        .agg(F.count("*").alias("n"))
        .groupBy(*keys, "position")
        .agg(F.map_from_entries(in_bin).alias("ones"), F.sum("n").alias("n_ones"))
    )
    rows, n_ones = F.col("rows"), F.col("n_ones")

    def term(n: Column, n_x: Column, n_y: Column) -> Column:
        return F.when(n > 0, n / rows * F.ln(n * rows / (n_x * n_y))).otherwise(0.0)

    def of_bin(cell: Column) -> Column:
        n = F.coalesce(F.try_element_at("ones", cell["ybin"]), F.lit(0))
        return term(n, n_ones, cell["n"]) + term(cell["n"] - n, rows - n_ones, cell["n"])

    # Few zeros share a bin of the feature with the ones after them.
    apart = F.floor(bins * (rows - n_ones) / rows) > 0
    score = F.when(apart, F.aggregate("all", F.lit(0.0), lambda s, cell: s + of_bin(cell))).otherwise(0.0)
    names = state.select("position", F.concat_ws("_", "variable", "category").alias("feature")).distinct()
    scored = ones.join(totals, keys).select(*keys, "position", score.alias("mutual_information"))
    return scored.join(names, "position").select(*keys, "feature", "mutual_information", "position")


def rank_features(scores: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Position from 0 by falling score; equal scores go by name."""
    best = W.partitionBy(*keys).orderBy(F.round("mutual_information", 9).desc(), "feature")
    return scores.withColumn("rank", F.row_number().over(best) - 1)


def preselect(scores: DataFrame, kept: int = KEPT_FEATURES, keys: list[str] = SERIES) -> DataFrame:
    return rank_features(scores, keys).where(F.col("rank") < kept)
