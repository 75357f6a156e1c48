"""Assignment of readings to overlapping time windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import micros
from ..functions.timeline import MICROS_PER_SECOND


def _layout(size_seconds: float, overlap: float) -> tuple[int, int]:
    size = round(size_seconds * MICROS_PER_SECOND)
    slide = round(size * (1 - overlap))
    if slide <= 0 or size % slide:
        raise ValueError(f"window of {size} us must be a whole number of {slide} us slides")
    return size, slide


def _index(at: Column, size: int, offset: int) -> Column:
    # pmod, not %, so that times before the offset floor downwards.
    shifted = at - F.lit(offset).cast("long")
    width = F.lit(size).cast("long")
    return F.call_function("div", shifted - F.pmod(shifted, width), width)


def assign_overlapping_windows(
    df: DataFrame, time_col: str, size_seconds: float, overlap: float = 0.5
) -> DataFrame:
    """Put each row into every window that covers it, as ``(win bigint, phase int)``.

    Window (win, phase) starts at ``win * size + phase * slide``. One narrow explode: no self-join
    and no second pass over the input.
    """
    size, slide = _layout(size_seconds, overlap)
    at = micros(df, time_col)
    slots = F.array(
        *[
            F.struct(
                _index(at, size, phase * slide).alias("win"), F.lit(phase).alias("phase")
            )
            for phase in range(size // slide)
        ]
    )
    return df.select("*", F.inline(slots))


def assign_windows_by_union(
    df: DataFrame, time_col: str, size_seconds: float, overlap: float = 0.5
) -> DataFrame:
    """The same rows as :func:`assign_overlapping_windows`, as one pass per phase and a union."""
    size, slide = _layout(size_seconds, overlap)
    at = micros(df, time_col)
    passes = [
        df.withColumns({"win": _index(at, size, phase * slide), "phase": F.lit(phase)})
        for phase in range(size // slide)
    ]
    return reduce(DataFrame.unionByName, passes)


def window_start(size_seconds: float, overlap: float = 0.5) -> Column:
    """Start of window (win, phase) in microseconds."""
    size, slide = _layout(size_seconds, overlap)
    return F.col("win") * F.lit(size).cast("long") + F.col("phase") * F.lit(slide).cast("long")


def assign_sliding_windows(
    df: DataFrame, time_col: str, size_seconds: float, overlap: float = 0.5
) -> DataFrame:
    """The same windows from the built-in ``window`` function, as ``(window_start, window_end)``.

    Needs a timestamp column. Works on unbounded input as well.
    """
    size, slide = _layout(size_seconds, overlap)
    span = F.window(time_col, f"{size} microseconds", f"{slide} microseconds")
    return df.withColumn("__span", span).select(
        *df.columns, F.col("__span.start").alias("window_start"), F.col("__span.end").alias("window_end")
    )
