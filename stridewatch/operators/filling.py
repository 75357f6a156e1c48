"""Forward fill: the last observed value so far, within a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import join_null_safe, micros, observed
from ..functions.timeline import MICROS_PER_SECOND

SPAN_SECONDS = 3600.0


def forward_fill(
    df: DataFrame,
    column: str,
    *,
    partition_cols: list[str],
    order_col: str,
    tie_col: str | None = None,
    output_col: str | None = None,
    span_seconds: float = SPAN_SECONDS,
) -> DataFrame:
    """Carry the last reading forward; it never crosses a partition boundary.

    NaN and null are no readings. Rows before the first reading stay null. A row keeps its own
    reading; else it takes the largest reading at its own place (``order_col``, then
    ``tie_col``), else the last one before. The result depends on the rows' contents only.

    Time is cut into chunks of ``span_seconds``, the same for every amount of data. Only keys, place and
    the slow column travel to the chunks, merged to one row a place before they do, so copies of a
    place are no burden. A chunk is filled by itself and begins with the last reading of the chunks
    before it. Choose the span so that a chunk of one key fits a task.
    """
    output_col = output_col or f"{column}_filled"
    place = [order_col] + ([tie_col] if tie_col else [])
    keys = list(partition_cols)
    value = F.when(_is_reading(df, column), F.col(column))
    places = (
        df.select(*dict.fromkeys([*keys, *place]), value.alias("__reading"), _chunk(df, order_col, span_seconds))
        .groupBy(*keys, "__chunk", *[c for c in place if c not in keys])
        .agg(F.max("__reading").alias("__here"))
    )
    so_far = (
        Window.partitionBy(*keys, "__chunk")
        .orderBy(*place)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = places.withColumn("__local", F.last("__here", ignorenulls=True).over(so_far))
    # one row per key and chunk
    newest = places.groupBy(*keys, "__chunk").agg(
        F.max_by("__here", F.when(F.col("__here").isNotNull(), F.struct(*place))).alias("__newest")
    )
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(
        *keys, "__chunk", F.last("__newest", ignorenulls=True).over(earlier).alias("__carried")
    )
    filled = join_null_safe(local, carried, [*keys, "__chunk"], "left").select(
        *dict.fromkeys([*keys, *place]), F.coalesce("__local", "__carried").alias("__value")
    )
    joined = join_null_safe(df, filled, list(dict.fromkeys([*keys, *place])), "left")
    return joined.withColumn(output_col, F.coalesce(value, "__value")).drop("__value")


def _is_reading(df: DataFrame, column: str):
    numeric = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return observed(F.col(column)) if numeric else F.col(column).isNotNull()


def _chunk(df: DataFrame, order_col: str, span_seconds: float):
    """The number of the chunk of time; null for a null time, which comes first."""
    span = max(1, round(span_seconds * MICROS_PER_SECOND))
    return F.floor(micros(df, order_col) / F.lit(span)).alias("__chunk")
