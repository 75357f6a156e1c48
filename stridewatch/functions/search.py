"""Binary search in a sorted array column, in generated code."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_count_at_or_below(
    df: DataFrame, bounds: str, position: str, output: str, longest: int
) -> DataFrame:
    """Add how many entries of the ascending array ``bounds`` are <= ``position``.

    ``longest`` is an upper limit on the array length. The answer grows by falling powers of two,
    so a row costs log2(longest) comparisons. Each step is its own projection: a lambda would
    leave generated code, and one nested expression would double at every step. A null array or
    position counts as zero, and get() is null beyond the end.
    """
    found = df.withColumn(output, F.lit(0))
    for bit in reversed(range(longest.bit_length())):
        step = 1 << bit
        found = found.withColumn(
            output,
            F.expr(
                f"`{output}` + if(get(`{bounds}`, `{output}` + {step - 1}) <= `{position}`, {step}, 0)"
            ),
        )
    return found
