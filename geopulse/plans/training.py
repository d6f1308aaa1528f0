"""Fit, evaluate and apply the unsupervised model."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.operators import evaluate as ev
from geopulse.operators import features as ft
from geopulse.operators import forest as fr
from geopulse.workspace import materialise


@dataclass(frozen=True)
class Training:
    forest: fr.Forest
    scored: DataFrame
    report: DataFrame


def train(
    features: DataFrame, *, trees: int = fr.TREES, contamination: float = fr.CONTAMINATION, seed: int = fr.SEED,
    columns: tuple[str, ...] = ft.FEATURES, sample_size: int = fr.SAMPLE_SIZE,
) -> Training:
    """Fit on complete rows, score them, and compare with the rule's own flag.

    ``sample_size`` bounds the rows that fit one tree; all rows are scored.

    The rule's flag is captured under its own name before the model flags anything.
    """
    if "is_anomaly" not in features.columns:
        raise KeyError("is_anomaly is missing: the model would be compared with itself")
    reference = F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("reference_is_anomaly")
    complete = features.dropna(subset=list(columns)).select(
        *ft.KEYS, reference, *[F.col(c).cast("double").alias(c) for c in columns]
    )
    complete = materialise(complete, "features")
    forest = fr.fit_isolation_forest(
        complete, columns, ft.KEYS, trees=trees, contamination=contamination, seed=seed, sample_size=sample_size
    )
    forest = replace(forest, nodes=materialise(forest.nodes, "forest"))
    scored = materialise(fr.score(complete, forest), "scores")
    flagged = fr.flag_top(scored, contamination=contamination)
    threshold = flagged.select("threshold").limit(1).collect()[0][0]
    report = ev.evaluate(flagged, "anomaly_score", "reference_is_anomaly", "detection_count", contamination)
    return Training(replace(forest, threshold=threshold), flagged, report)


def batch_score(
    features: DataFrame, training: Training, revision: str, scored_at: Column, columns: tuple[str, ...] = ft.FEATURES
) -> DataFrame:
    """Predictions for a feature table; incomplete rows are scored with zeros, as in serving."""
    matrix = ft.feature_matrix(features, columns, missing="zero")
    ranked = fr.score_against_training(matrix, training.forest, training.scored)
    return fr.predictions(ranked, training.forest, revision, scored_at)
