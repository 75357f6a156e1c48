"""Column expressions that treat NaN and null alike.

Spark orders NaN above every number, so a bare ``score >= 0.75`` accepts a NaN score. Every
threshold in this package goes through :func:`at_least` or :func:`under`, which are false for NaN
and for null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def observed(value: Column) -> Column:
    """True where the value is a real reading: neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def reading(value: Column) -> Column:
    """The value of a number column where it is a reading, else null."""
    return F.when(observed(value), value)


def at_least(value: Column, limit) -> Column:
    return F.coalesce(observed(value) & (value >= limit), F.lit(False))


def under(value: Column, limit) -> Column:
    return F.coalesce(observed(value) & (value < limit), F.lit(False))


def is_missing(df: DataFrame, column: str) -> Column:
    """True where a column has no reading: null, or NaN where the type knows NaN."""
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return ~observed(F.col(column))
    return F.col(column).isNull()


def missing_rate(df: DataFrame, column: str) -> Column:
    """Aggregate: share of rows without a reading."""
    return F.avg(is_missing(df, column).cast("int"))
