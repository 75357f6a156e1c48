"""Row and column clean-up between raw text and the readings table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null


def extract_subject(
    df: DataFrame,
    file_col: str = "source_file",
    pattern: str = r"subject(\d+)",
    output_col: str = "subject_id",
) -> DataFrame:
    """Integer key from a file name; null where the name does not match."""
    digits = F.regexp_extract(F.col(file_col), pattern, 1)
    return df.withColumn(output_col, digits.try_cast("int"))


def normalize_nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN becomes null in the named columns. Other columns and the column order stay."""
    return df.withColumns({c: nan_to_null(F.col(c)) for c in columns if c in df.columns})


def drop_columns_like(df: DataFrame, fragment: str) -> DataFrame:
    return df.drop(*(c for c in df.columns if fragment in c))


def columns_with_prefix(df: DataFrame, prefixes: list[str] | tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def drop_transient(df: DataFrame, activity_col: str = "activity_id", transient=0) -> DataFrame:
    """Remove the transient class. A null activity goes too: the predicate is not true for it."""
    return df.filter(F.col(activity_col) != F.lit(transient))


def require_key(df: DataFrame, key_col: str) -> DataFrame:
    return df.filter(F.col(key_col).isNotNull())


def clean_readings(
    raw: DataFrame,
    *,
    sensor_cols: list[str],
    activity_col: str = "activity_id",
    file_col: str = "source_file",
    drop_like: str = "orient_",
) -> DataFrame:
    """Raw rows to readings, in one narrow stage: no shuffle between the scan and the write."""
    kept = [c for c in sensor_cols if drop_like not in c]
    rows = drop_columns_like(extract_subject(raw, file_col), drop_like)
    rows = normalize_nan_to_null(rows, kept)
    rows = require_key(drop_transient(rows, activity_col), "subject_id")
    return rows.withColumns(
        {activity_col: F.col(activity_col).cast("int"), "ingested_at": F.current_timestamp()}
    )
