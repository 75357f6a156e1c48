"""Summaries of readings, splits and scored batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing, missing_rate


def ingest_profile(
    df: DataFrame,
    *,
    subject_col: str = "subject_id",
    activity_col: str = "activity_id",
    signal_col: str = "heart_rate",
) -> DataFrame:
    """Per subject: rows, distinct activities, share of rows without a reading of the slow signal.

    Two levels, so that a subject with most of the rows arrives as a few partial sums.
    """
    per_activity = df.groupBy(subject_col, activity_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_missing(df, signal_col)).alias("nulls")
    )
    return (
        per_activity.groupBy(subject_col)
        .agg(
            F.sum("rows").alias("rows"),
            F.count(activity_col).alias("activities"),
            F.round(F.sum("nulls") / F.sum("rows"), 3).alias("null_rate"),
        )
        .orderBy(subject_col)
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[missing_rate(df, c).alias(c) for c in columns])


def distinct_count(df: DataFrame, column: str, name: str = "distinct_values") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def class_balance(
    df: DataFrame, *, activity_col: str = "activity_id", split_col: str = "split"
) -> DataFrame:
    return (
        df.groupBy(activity_col, split_col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(activity_col, split_col)
    )


def split_profile(
    df: DataFrame,
    *,
    subject_col: str = "subject_id",
    activity_col: str = "activity_id",
    split_col: str = "split",
) -> DataFrame:
    """Windows, subjects and activities per split.

    One pass over the rows; the distinct counts run on the (split, subject, activity) groups.
    """
    groups = df.groupBy(split_col, subject_col, activity_col).agg(
        F.count(F.lit(1)).alias("windows")
    )
    return groups.groupBy(split_col).agg(
        F.sum("windows").alias("windows"),
        F.count_distinct(subject_col).alias("subjects"),
        F.count_distinct(activity_col).alias("activities"),
    )


def scored_summary(
    scored: DataFrame,
    *,
    label_col: str = "activity_id",
    prediction_col: str = "predicted_activity_id",
    time_col: str = "scored_at",
) -> DataFrame:
    """Rows, accuracy and newest time. As in :mod:`.metrics`, accuracy is over rows with a label, and
    an absent prediction is a miss."""
    right = F.coalesce((F.col(prediction_col) == F.col(label_col)).cast("int"), F.lit(0))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.when(~is_missing(scored, label_col), right)).alias("accuracy"),
        F.max(time_col).alias("latest_run"),
    )


def provenance_list(
    df: DataFrame, column: str, by: list[str] | None = None, name: str = "members"
) -> DataFrame:
    """Distinct values of a column in numeric order, as one comma-separated string per group.

    Values are made distinct before they are gathered; the string itself is the result, so use it
    for columns whose values one string can hold, such as the subjects of a split.
    """
    by = by or []
    distinct = df.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    listed = F.array_sort(F.collect_list(column)).cast("array<string>")
    return distinct.groupBy(*by).agg(F.array_join(listed, ",").alias(name))


def sample_sizes(reference: DataFrame, current: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return reference.agg(rows.alias("reference_rows")).withColumn(
        "current_rows", current.agg(rows).scalar()
    )
