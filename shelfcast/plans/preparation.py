"""Stages from the analytic table to model-ready rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.encoding import (
    apply_one_hot,
    apply_target_encoding,
    encode_positions,
    fit_one_hot,
    fit_target_encoding,
    one_hot_categories,
    one_hot_names,
    with_positions,
)
from shelfcast.operators.features import build_features, feature_names
from shelfcast.operators.quality import clean
from shelfcast.schema import (
    MODEL_COLUMNS,
    ONE_HOT_COLUMNS,
    SERIES,
    TARGET,
    TARGET_ENCODED_COLUMNS,
)
from shelfcast.session import stage
from shelfcast.sources.tables import read_stage, write_stage


@dataclass
class Encoders:
    """Fitted state of both encoders, as tables."""

    one_hot: DataFrame
    target: DataFrame

    def categories(self) -> dict[str, list[str]]:
        return one_hot_categories(self.one_hot)

    def save(self, path: str) -> None:
        write_stage(self.one_hot, f"{path}/one_hot")
        write_stage(self.target, f"{path}/target_encoding")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoders:
        return Encoders(read_stage(spark, f"{path}/one_hot"), read_stage(spark, f"{path}/target_encoding"))


def model_rows(panel: DataFrame) -> DataFrame:
    """Only the columns training and forecasting use."""
    return panel.select(*MODEL_COLUMNS)


def prepare(rows: DataFrame) -> DataFrame:
    """Cleaned rows with all history features."""
    return build_features(clean(rows))


def fit_encoders(features: DataFrame) -> Encoders:
    """Fit both encoders on the rows the models will see.

    The few columns they need are staged first: both fits then read a narrow table,
    and the windows that decide which rows are complete run once.
    """
    coded = features.select(*SERIES, TARGET, *ONE_HOT_COLUMNS, *TARGET_ENCODED_COLUMNS)
    coded = stage(coded, "coded")
    return Encoders(
        stage(fit_one_hot(coded, ONE_HOT_COLUMNS), "one-hot"),
        stage(fit_target_encoding(coded, TARGET_ENCODED_COLUMNS), "target-encoding"),
    )


def encode(
    features: DataFrame, encoders: Encoders, categories: dict[str, list[str]] | None = None
) -> DataFrame:
    """Replace the categorical columns by their encodings."""
    encoded = apply_one_hot(features, encoders.one_hot, categories or encoders.categories())
    encoded = apply_target_encoding(encoded, encoders.target, TARGET_ENCODED_COLUMNS)
    return encoded.drop(*ONE_HOT_COLUMNS, *TARGET_ENCODED_COLUMNS)


def with_block_positions(encoders: Encoders) -> Encoders:
    """Encoders whose one-hot state has positions, for blocks of any width."""
    return Encoders(stage(with_positions(encoders.one_hot), "one-hot"), encoders.target)


def encode_block(features: DataFrame, encoders: Encoders) -> DataFrame:
    """Like `encode`, with the one-hot block as one array of positions."""
    encoded = encode_positions(features, encoders.one_hot, ONE_HOT_COLUMNS)
    encoded = apply_target_encoding(encoded, encoders.target, TARGET_ENCODED_COLUMNS)
    return encoded.drop(*ONE_HOT_COLUMNS, *TARGET_ENCODED_COLUMNS)


def encoded_feature_names(categories: dict[str, list[str]]) -> list[str]:
    """Every model input in its fixed order."""
    return [
        *feature_names(),
        *one_hot_names(categories),
        *[f"{c}_te" for c in TARGET_ENCODED_COLUMNS],
    ]
