"""Per-window features, the completeness filter and the subject split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reading

# Sampling rate, window length and the share of samples a window needs.
SAMPLE_HZ = 100
WINDOW_SECONDS = 5.12
COMPLETENESS = 0.9


def signal_statistics(column: str) -> list[Column]:
    """Mean, sample deviation, extremes and energy (mean square) of a sensor channel's readings."""
    value = reading(F.col(column))
    return [
        F.avg(value).alias(f"{column}_mean"),
        F.stddev(value).alias(f"{column}_std"),
        F.min(value).alias(f"{column}_min"),
        F.max(value).alias(f"{column}_max"),
        F.avg(value * value).alias(f"{column}_energy"),
    ]


def filled_statistics(column: str, name: str) -> list[Column]:
    """A filled signal repeats its readings, so it has no energy and no minimum here."""
    value = reading(F.col(column))
    return [
        F.avg(value).alias(f"{name}_mean"),
        F.stddev(value).alias(f"{name}_std"),
        F.max(value).alias(f"{name}_max"),
    ]


def window_features(
    df: DataFrame,
    keys: list[str],
    sensor_cols: list[str],
    filled_cols: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per window. ``filled_cols`` maps a filled column to its feature prefix.

    Every aggregate combines on the map side, so a hot window costs no more than any other.
    """
    per_sensor = [stat for c in sensor_cols for stat in signal_statistics(c)]
    per_filled = [
        stat for c, name in (filled_cols or {}).items() for stat in filled_statistics(c, name)
    ]
    return df.groupBy(*keys).agg(
        *per_sensor, *per_filled, F.count(F.lit(1)).alias("sample_count")
    )


def required_samples(expected: int, completeness: float = COMPLETENESS) -> float:
    """The fewest samples a window may have."""
    return expected * completeness


def drop_partial_windows(
    df: DataFrame,
    *,
    count_col: str = "sample_count",
    window_seconds: float = WINDOW_SECONDS,
    sample_hz: int = SAMPLE_HZ,
    completeness: float = COMPLETENESS,
    expected: int | None = None,
) -> DataFrame:
    """Keep windows with enough samples; ``expected`` overrides rate times length."""
    if expected is None:
        expected = int(sample_hz * window_seconds)
    return df.filter(F.col(count_col) >= required_samples(expected, completeness))


def split_label(subject: Column, members: Mapping[str, Iterable]) -> Column:
    """Name of the split that lists the subject, else ``unassigned``."""
    named = [F.when(subject.isin(list(ids)), F.lit(name)) for name, ids in members.items()]
    return F.coalesce(*named, F.lit("unassigned"))


def assign_split(
    df: DataFrame,
    *,
    subject_col: str = "subject_id",
    train_subjects: Iterable = (),
    holdout_subjects: Iterable = (),
) -> DataFrame:
    """Label rows by subject, never by row, so no subject is on both sides."""
    members = {"train": train_subjects, "holdout": holdout_subjects}
    return df.withColumn("split", split_label(F.col(subject_col), members))


def assign_split_from_table(
    df: DataFrame, assignment: DataFrame, *, subject_col: str = "subject_id"
) -> DataFrame:
    """The same for lists too long for a literal: ``assignment`` is (subject, split).

    The join strategy is left to Spark, which knows the size of the assignment table.
    """
    one_each = assignment.groupBy(subject_col).agg(F.min("split").alias("split"))
    return df.join(one_each, subject_col, "left").withColumn(
        "split", F.coalesce("split", F.lit("unassigned"))
    )


def feature_columns(df: DataFrame, id_cols: Iterable[str]) -> list[str]:
    ids = set(id_cols)
    return [c for c in df.columns if c not in ids]
