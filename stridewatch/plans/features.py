"""The feature plan: readings to one row per complete window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..operators.features import assign_split, drop_partial_windows, window_features
from ..operators.filling import SPAN_SECONDS, forward_fill
from ..operators.windows import assign_overlapping_windows


def feature_plan(
    readings: DataFrame,
    *,
    sensor_cols: list[str],
    slow_col: str,
    slow_name: str | None = None,
    subject_col: str = "subject_id",
    activity_col: str = "activity_id",
    time_col: str = "timestamp_s",
    tie_col: str | None = None,
    window_seconds: float,
    overlap: float = 0.5,
    expected: int,
    completeness: float = 0.9,
    train_subjects: Iterable = (),
    holdout_subjects: Iterable = (),
    split_by: str | None = None,
    span_seconds: float = SPAN_SECONDS,
) -> DataFrame:
    """Fill the slow signal, window the rows, aggregate, drop partial windows, label the split.

    The slow column travels to its time chunks by itself; whole readings are shuffled once, to meet
    the filled values. The window aggregation shuffles partial results, one row per window and task.
    """
    groups = [subject_col, activity_col]
    filled = forward_fill(
        readings,
        slow_col,
        partition_cols=groups,
        order_col=time_col,
        tie_col=tie_col,
        output_col="__filled",
        span_seconds=span_seconds,
    )
    narrow = [*groups, *([split_by] if split_by else []), time_col, "__filled", *sensor_cols]
    windowed = assign_overlapping_windows(
        filled.select(*dict.fromkeys(narrow)), time_col, window_seconds, overlap
    )
    keys = [*groups, *([split_by] if split_by else []), "win", "phase"]
    features = window_features(
        windowed, list(dict.fromkeys(keys)), sensor_cols, {"__filled": slow_name or slow_col}
    )
    complete = drop_partial_windows(features, expected=expected, completeness=completeness)
    return assign_split(
        complete,
        subject_col=split_by or subject_col,
        train_subjects=train_subjects,
        holdout_subjects=holdout_subjects,
    )
