"""Training every series and keeping the result in tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.boosting import Boost, train_boosted
from shelfcast.operators.selection import KEPT_FEATURES, mutual_information, one_hot_information, preselect
from shelfcast.operators.training import train
from shelfcast.plans.preparation import (
    Encoders,
    encode,
    encode_block,
    encoded_feature_names,
    fit_encoders,
    prepare,
    with_block_positions,
)
from shelfcast.schema import SERIES
from shelfcast.session import stage, stage_by_series
from shelfcast.sources.tables import read_stage, write_stage
from shelfcast.sources.versions import folder_of, new_version, publish


@dataclass
class Registry:
    """Everything a forecast needs: encoders and one model per series."""

    encoders: Encoders
    models: DataFrame

    def save(self, path: str) -> int:
        """Publish as the newest version, whose number is returned; older ones stay."""
        folder = new_version(path)
        self.encoders.save(f"{folder}/encoders")
        write_stage(self.models, f"{folder}/models")
        return publish(self.models.sparkSession, path, folder)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> Registry:
        """The newest version, or a given one."""
        folder = folder_of(spark, path, version)
        return Registry(Encoders.load(spark, f"{folder}/encoders"), read_stage(spark, f"{folder}/models"))


@dataclass
class TrainingSet:
    """Encoded rows, the features in them and the ones selected per series."""

    encoders: Encoders
    encoded: DataFrame
    features: list[str]
    selected: DataFrame | None = None


def encoded_rows(rows: DataFrame) -> TrainingSet:
    """The encoded rows are read by selection, search and fit, so they are staged once, each
    series in one place: none of the three shuffles them again.

    Fitting the encoders needs none of the wide features: its plan is pruned to the
    lags that decide which rows are complete.
    """
    features = prepare(rows)
    encoders = fit_encoders(features)
    categories = encoders.categories()
    names = encoded_feature_names(categories)
    encoded = stage_by_series(encode(features, encoders, categories), "encoded", SERIES)
    return TrainingSet(encoders, encoded, names)


Scores = Callable[[DataFrame, list[str]], DataFrame]
"""How features are scored: `mutual_information` or `neighbour_information`."""


def training_set(rows: DataFrame, kept: int = KEPT_FEATURES, scores: Scores = mutual_information) -> TrainingSet:
    return with_selected(encoded_rows(rows), kept, scores)


def with_selected(prepared: TrainingSet, kept: int = KEPT_FEATURES, scores: Scores = mutual_information) -> TrainingSet:
    found = scores(prepared.encoded, prepared.features)
    return replace(prepared, selected=stage(preselect(found, kept), "selected"))


def retrain(rows: DataFrame, kept: int = KEPT_FEATURES, scores: Scores = mutual_information) -> Registry:
    prepared = training_set(rows, kept, scores)
    models = train(prepared.encoded, prepared.selected, prepared.features)
    return Registry(prepared.encoders, stage(models, "models"))


def block_training_set(rows: DataFrame, kept: int = KEPT_FEATURES) -> TrainingSet:
    """The training set with its one-hot block as positions: categories are data from the
    fit to the score, and none is collected."""
    features = prepare(rows)
    encoders = with_block_positions(fit_encoders(features))
    names = encoded_feature_names({})
    encoded = stage_by_series(encode_block(features, encoders), "encoded", SERIES)
    of_names = mutual_information(encoded, names)
    scores = one_hot_information(encoded, encoders.one_hot).unionByName(of_names, allowMissingColumns=True)
    return TrainingSet(encoders, encoded, names, stage(preselect(scores, kept), "selected"))


def retrain_block(rows: DataFrame, kept: int = KEPT_FEATURES) -> Registry:
    """The models of `retrain`, whose one-hot weights are kept by position."""
    prepared = block_training_set(rows, kept)
    models = train(prepared.encoded, prepared.selected, prepared.features)
    return Registry(prepared.encoders, stage(models, "models"))


def retrain_boosted(rows: DataFrame, boost: Boost = Boost()) -> Registry:
    """A registry of boosted trees, which choose among all features themselves."""
    prepared = encoded_rows(rows)
    _, models = train_boosted(prepared.encoded, prepared.features, boost)
    return Registry(prepared.encoders, stage(models, "models"))
