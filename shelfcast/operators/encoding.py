"""One-hot and smoothed target encoding with their state in tables.

The state is kept per series unless other keys are given; no keys at all means
one state for the whole table. The long table (keys, variable, category, ...) is what
is stored. To apply it, each key's categories are folded into one row, so a table
is encoded with a single join on its own series key. A state without keys is joined on the
category, so no task ever holds all of a column's categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.operators.folds import FOLDS, TEST_ROWS, with_recency
from shelfcast.operators.quality import stacked
from shelfcast.schema import SERIES, TARGET
from shelfcast.session import stage


def fit_one_hot(df: DataFrame, columns: list[str], keys: list[str] = SERIES) -> DataFrame:
    """The categories each key has seen, one row each."""
    seen = stacked(df, columns, "string", keep=keys).where(F.col("value").isNotNull())
    return seen.select(*keys, "variable", F.col("value").alias("category")).distinct()


def one_hot_categories(state: DataFrame) -> dict[str, list[str]]:
    """The categories a caller wants as named columns, in order.

    Named columns are a view for models that ask for them; `encode_positions` keeps the
    width of the block in the data, for categories of any number.
    """
    pairs = state.select("variable", "category").distinct().collect()
    found: dict[str, list[str]] = {}
    for column, category in sorted((p["variable"], p["category"]) for p in pairs):
        found.setdefault(column, []).append(category)
    return found


def category_positions(state: DataFrame) -> DataFrame:
    """A position for each (variable, category): its place in the one-hot block.

    Positions count on from one variable to the next. The order inside a variable is
    settled over ranges of categories, so no task holds them all.
    """
    pairs = state.select("variable", "category").distinct()
    ordered = pairs.repartitionByRange("variable", "category").sortWithinPartitions("variable", "category")
    placed = stage(ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")), "categories")
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # One row per partition.
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_part", "_first", before.alias("_before"))
    at = F.col("_before") + F.col("_id") - F.col("_first")
    return placed.join(starts, "_part").select("variable", "category", at.alias("position"))


def with_positions(state: DataFrame) -> DataFrame:
    """The state with the position of each category, if it has none yet."""
    if "position" in state.columns:
        return state
    return state.join(category_positions(state), ["variable", "category"])


def folded_positions(state: DataFrame, columns: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per key: a map from each category it has seen to its position, `_at_<column>`."""
    pair = F.struct("category", "position")
    return state.groupBy(*keys).agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("variable") == c, pair))).alias(f"_at_{c}")
            for c in columns
        ]
    )


def positions_in(values: dict[str, Column]) -> Column:
    """The block of one row joined to its folded positions; a category its key has not seen
    gives none."""
    found = [F.try_element_at(F.col(f"_at_{c}"), v.cast("string")) for c, v in values.items()]
    return F.array_sort(F.array_compact(F.array(*found)))


def encode_positions(df: DataFrame, state: DataFrame, columns: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One column `one_hot`, the positions of the ones in a row's block, in order.

    A category its key has not seen gives none. With keys the rows stay where their key is;
    without, they meet the positions by category.
    """
    state = with_positions(state)
    if keys:
        rows = df.join(folded_positions(state, columns, keys), keys, "left")
        return rows.select(*df.columns, positions_in({c: F.col(c) for c in columns}).alias("one_hot"))
    rows, found = df, []
    for column in columns:
        part = state.where(F.col("variable") == column)
        rows = _join_category(rows, part, column, [], {"position": f"_at_{column}"})
        found.append(F.col(f"_at_{column}"))
    return rows.select(*df.columns, F.array_sort(F.array_compact(F.array(*found))).alias("one_hot"))


def one_hot_names(categories: dict[str, list[str]]) -> list[str]:
    return [f"{column}_{v}" for column, values in categories.items() for v in values]


def _join_category(
    df: DataFrame, state: DataFrame, column: str, keys: list[str], values: dict[str, str]
) -> DataFrame:
    """`df` with the state's values of a row's own category, under the given names."""
    part = state.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("category").alias("_category"),
        *[F.col(c).alias(name) for c, name in values.items()],
    )
    same = F.col("_category") == F.col(column).cast("string")
    for k in keys:
        same = same & (F.col(f"_key_{k}") == F.col(k))
    return df.join(part, same, "left").drop("_category", *[f"_key_{k}" for k in keys])


def folded_one_hot(state: DataFrame, columns: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per key: the categories it has seen, a `_seen_<column>` array each."""
    return state.groupBy(*keys).agg(
        *[
            F.collect_set(F.when(F.col("variable") == c, F.col("category"))).alias(f"_seen_{c}")
            for c in columns
        ]
    )


def apply_one_hot(
    df: DataFrame, state: DataFrame, categories: dict[str, list[str]], keys: list[str] = SERIES
) -> DataFrame:
    """0/1 columns; a category its key has not seen gives zeros everywhere."""
    if not keys:
        rows = df
        for column in categories:
            seen = state.where(F.col("variable") == column).select("category").distinct().withColumn("_one", F.lit(True))
            rows = _join_category(rows, seen, column, [], {"_one": f"_seen_{column}"})
        known = {c: F.col(f"_seen_{c}") for c in categories}
        seen_by = {(c, v): known[c] for c, values in categories.items() for v in values}
    else:
        rows = df.join(folded_one_hot(state, list(categories), keys), keys, "left")
        seen_by = {(c, v): F.array_contains(f"_seen_{c}", v) for c, values in categories.items() for v in values}
    flags = [
        F.coalesce((F.col(column).cast("string") == v) & seen, F.lit(False)).cast("double").alias(f"{column}_{v}")
        for (column, v), seen in seen_by.items()
    ]
    return rows.select(*df.columns, *flags)


def fit_target_encoding(
    df: DataFrame,
    columns: list[str],
    keys: list[str] = SERIES,
    target: str = TARGET,
    min_samples: float = 100,
    smoothing: float = 1.0,
) -> DataFrame:
    """Category means drawn towards the key's own mean where rows are few.

    weight = 1 / (1 + exp(-(n - min_samples) / smoothing)); one row gets the prior.
    """
    stats = (
        stacked(df, columns, "string", keep=[*keys, target])
        .groupBy(*keys, "variable", "value")
        .agg(F.count("*").alias("n"), F.sum(F.col(target).cast("double")).alias("total"))
    )
    # Every row is in exactly one category of a column, so the first column's
    # categories add up to the key's own count and total.
    one = stats.where(F.col("variable") == columns[0])
    prior = one.groupBy(*keys).agg((F.sum("total") / F.sum("n")).alias("prior"))
    weight = 1 / (1 + F.exp(-(F.col("n") - min_samples) / smoothing))
    mean = F.col("total") / F.col("n")
    blended = F.col("prior") * (1 - weight) + mean * weight
    # Without keys the prior is one number.
    with_prior = stats.join(prior, keys, "left") if keys else stats.withColumn("prior", prior.scalar())
    return with_prior.select(
        *keys,
        "variable",
        F.col("value").alias("category"),
        "n",
        mean.alias("mean"),
        "prior",
        F.when(F.col("n") == 1, F.col("prior")).otherwise(blended).alias("encoding"),
    )


def _blend(n: Column, total: Column, prior: Column, min_samples: float, smoothing: float) -> Column:
    """The mean of a category drawn towards the prior, which is all that one row or none gives."""
    weight = 1 / (1 + F.exp(-(n - min_samples) / smoothing))
    return F.when(n <= 1, prior).otherwise(prior * (1 - weight) + total / n * weight)


def fit_target_encoding_by_fold(
    df: DataFrame,
    columns: list[str],
    folds: int = FOLDS,
    test_rows: int = TEST_ROWS,
    keys: list[str] = SERIES,
    target: str = TARGET,
    min_samples: float = 100,
    smoothing: float = 1.0,
) -> DataFrame:
    """The state of `fit_target_encoding` for each fold, from the rows it learns from alone.

    Rows are counted once, by the test block they are in; a fold adds up the blocks before
    its own, so the repetition over folds is of counts, not of rows.
    """
    block = F.least(F.floor((F.col("recency") - 1) / test_rows), F.lit(folds)).cast("int").alias("block")
    blocks = with_recency(df.select(*keys, "date", target, *columns), keys).select(*keys, target, *columns, block)
    stats = (
        stacked(blocks, columns, "string", keep=[*keys, target, "block"])
        .groupBy(*keys, "variable", "value", "block")
        .agg(F.count("*").alias("n"), F.sum(F.col(target).cast("double")).alias("total"))
        .where("block > 0")
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.col("block") - 1)))
        .groupBy(*keys, "fold", "variable", "value")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    one = stats.where(F.col("variable") == columns[0])
    prior = one.groupBy(*keys, "fold").agg((F.sum("total") / F.sum("n")).alias("prior"))
    code = _blend(F.col("n"), F.col("total"), F.col("prior"), min_samples, smoothing)
    return stats.join(prior, [*keys, "fold"]).select(
        *keys, "fold", "variable", F.col("value").alias("category"), "n",
        (F.col("total") / F.col("n")).alias("mean"), "prior", code.alias("encoding"),
    )


def encode_from_past(
    df: DataFrame,
    columns: list[str],
    keys: list[str] = SERIES,
    target: str = TARGET,
    min_samples: float = 100,
    smoothing: float = 1.0,
) -> DataFrame:
    """One `<column>_te` column each, from the rows before a row's date alone; null on the first.

    Running sums per series and per category of a series: no row sees itself or a later one,
    so any fold may learn from these codes.
    """
    before = lambda *by: W.partitionBy(*keys, *by).orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    amount = F.col(target).cast("double")
    prior = F.sum(amount).over(before()) / F.count(target).over(before())
    rows = df.withColumn("_prior", prior)
    codes = []
    for c in columns:
        n, total = F.count(target).over(before(c)), F.sum(amount).over(before(c))
        codes.append(_blend(n, total, F.col("_prior"), min_samples, smoothing).alias(f"{c}_te"))
    return rows.select(*df.columns, *codes)


def folded_target_encoding(state: DataFrame, columns: list[str], keys: list[str] = SERIES) -> DataFrame:
    """One row per key: its prior and a category-to-value map per column."""
    known = state.where(F.col("category").isNotNull())
    maps = [
        F.map_from_entries(
            F.collect_list(F.when(F.col("variable") == c, F.struct("category", "encoding")))
        ).alias(f"_map_{c}")
        for c in columns
    ]
    return known.groupBy(*keys).agg(F.first("prior").alias("_prior"), *maps)


def apply_target_encoding(
    df: DataFrame, state: DataFrame, columns: list[str], keys: list[str] = SERIES
) -> DataFrame:
    """One `<column>_te` column each; an unseen category gets the prior."""
    if keys:
        codes = {c: F.col(f"_map_{c}")[F.col(c).cast("string")] for c in columns}
        rows, prior = df.join(folded_target_encoding(state, columns, keys), keys, "left"), F.col("_prior")
    else:
        rows, codes = df, {c: F.col(f"_code_{c}") for c in columns}
        for c in columns:
            known = state.where((F.col("variable") == c) & F.col("category").isNotNull())
            rows = _join_category(rows, known, c, [], {"encoding": f"_code_{c}"})
        prior = state.agg(F.max("prior")).scalar()
    encoded = [F.coalesce(code, prior).alias(f"{c}_te") for c, code in codes.items()]
    return rows.select(*df.columns, *encoded)
