"""Event time as integer microseconds.

``floor(t / 5.12)`` on doubles misplaces readings that sit exactly on a window edge; integers do
not.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
_MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def micros(df: DataFrame, time_col: str) -> Column:
    """Microseconds since the epoch (timestamps) or since zero (numbers, read as seconds)."""
    kind = df.schema[time_col].dataType
    at = F.col(time_col)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(at)
    if isinstance(kind, T.TimestampNTZType):
        # From the wall-clock fields, so that the session time zone plays no part.
        of_day = (
            F.hour(at) * 3600 + F.minute(at) * 60
        ) * F.lit(MICROS_PER_SECOND).cast("long") + (
            F.extract(F.lit("SECOND"), at) * MICROS_PER_SECOND
        ).cast("long")
        return F.unix_date(at.cast("date")) * F.lit(_MICROS_PER_DAY) + of_day
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        return at.cast("long") * MICROS_PER_SECOND
    if isinstance(kind, T.NumericType):
        return F.round(at * MICROS_PER_SECOND).cast("long")
    raise TypeError(f"{time_col} is {kind.simpleString()}, expected a timestamp or a number")
