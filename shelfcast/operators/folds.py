"""Time-ordered folds: the newest rows of a series as consecutive test blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.schema import SERIES

FOLDS = 5
TEST_ROWS = 8


def fold_bounds(rows: int, folds: int = FOLDS, test_rows: int = TEST_ROWS) -> list[tuple[int, int]]:
    """Where the test block of each fold starts and ends, in rows by date; fold 0 is the
    newest, and a fold without rows to learn from is left out. `time_folds` deals the same
    folds out as rows."""
    ends = [rows - fold * test_rows for fold in range(folds)]
    return [(end - test_rows, end) for end in ends if end - test_rows >= 1]


def with_recency(df: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Number the rows of a series from the newest, starting at 1."""
    newest = W.partitionBy(*keys).orderBy(F.col("date").desc())
    return df.withColumn("recency", F.row_number().over(newest))


def time_folds(
    df: DataFrame, folds: int = FOLDS, test_rows: int = TEST_ROWS, keys: list[str] = SERIES
) -> DataFrame:
    """Each row once per fold it plays a role in; fold 0 tests the newest block."""
    numbered = with_recency(df, keys).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    start = F.col("fold") * test_rows
    role = F.when(F.col("recency") > start + test_rows, "train").when(F.col("recency") > start, "test")
    return numbered.withColumn("role", role).where(F.col("role").isNotNull())
