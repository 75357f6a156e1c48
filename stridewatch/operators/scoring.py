"""Batch scoring with lineage, and the join of predictions back to features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_KEYS = ["subject_id", "win", "phase"]


def model_inputs(model: PipelineModel) -> list[str]:
    """Input columns as the fitted model declares them, from its first stage."""
    return list(model.stages[0].getInputCols())


def require_inputs(df: DataFrame, inputs: list[tuple[str, str]]) -> None:
    """Fail before scoring if an input column is absent or has another type."""
    have = dict(df.dtypes)
    wrong = [
        f"{name}: expected {kind}, found {have.get(name, 'nothing')}"
        for name, kind in inputs
        if have.get(name) != kind
    ]
    if wrong:
        raise ValueError("model inputs do not match the batch: " + "; ".join(wrong))


def stamp_lineage(df: DataFrame, model_name: str, version: int, run_id: str) -> DataFrame:
    return df.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_version": F.lit(version).cast("long"),
            "model_run_id": F.lit(run_id),
        }
    )


def stamp_lineage_from(df: DataFrame, champion: DataFrame) -> DataFrame:
    """The same from a one-row frame (model_name, model_version, model_run_id)."""
    names = ["model_name", "model_version", "model_run_id"]
    held = champion.select(F.struct(*names)).scalar()
    return df.withColumn("__champion", held).select(*df.columns, "__champion.*")


def score(
    model: PipelineModel,
    batch: DataFrame,
    keep: list[str],
    output_col: str,
    output_type: str = "bigint",
) -> DataFrame:
    """Keys and prediction in the contract's type; only the model's inputs are read besides the keys."""
    needed = list(dict.fromkeys([*keep, *model_inputs(model)]))
    scored = model.transform(batch.select(*needed))
    # The model names its classes as text; a class that was a double reads like "5.0".
    label = F.col("predicted_label")
    if output_type != "string":
        label = label.cast("double").cast(output_type)
    return scored.select(*keep, label.alias(output_col))


def latest_predictions(
    predictions: DataFrame,
    *,
    keys: list[str] = WINDOW_KEYS,
    prediction_col: str = "predicted_activity_id",
    time_col: str = "scored_at",
) -> DataFrame:
    """One prediction per window: the newest. A batch scored twice must not fan out the join.

    Equal times are settled by the larger prediction, so that reruns agree.
    """
    newest = F.max_by(prediction_col, F.struct(time_col, prediction_col))
    return predictions.groupBy(*keys).agg(newest.alias(prediction_col))


def join_predictions(
    features: DataFrame,
    predictions: DataFrame,
    *,
    keys: list[str] = WINDOW_KEYS,
    prediction_col: str = "predicted_activity_id",
    time_col: str = "scored_at",
) -> DataFrame:
    newest = latest_predictions(
        predictions, keys=keys, prediction_col=prediction_col, time_col=time_col
    )
    return features.join(newest, keys, "inner")
