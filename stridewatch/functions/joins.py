"""Joins in which null keys match."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys match, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"__right_{k}" for k in keys])
