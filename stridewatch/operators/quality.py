"""Data contracts: expectations over a DataFrame, checked in one pass and enforced together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import at_least, missing_rate, observed

_RESULT = "expectation string, observed double, passed boolean"


class ContractViolation(AssertionError):
    """At least one expectation does not hold; the message lists them all."""


@dataclass(frozen=True)
class Expectation:
    name: str
    measure: Callable[[DataFrame], Column]  # an aggregate over the checked table
    holds: Callable[[Column], Column]
    distinct: bool = False  # a distinct aggregate cannot be measured during a write


def null_rate_between(column: str, low: float, high: float) -> Expectation:
    return Expectation(
        f"{column} null rate in [{low}, {high}]",
        lambda df: missing_rate(df, column),
        lambda rate: at_least(rate, low) & (rate <= high),
    )


def null_rate_below(column: str, limit: float) -> Expectation:
    return Expectation(
        f"{column} null rate below {limit}",
        lambda df: missing_rate(df, column),
        lambda rate: observed(rate) & (rate < limit),
    )


def not_empty() -> Expectation:
    return Expectation("has rows", lambda _: F.count(F.lit(1)), lambda n: n > 0)


def some_row(name: str, predicate: Column) -> Expectation:
    return Expectation(name, lambda _: F.count_if(predicate), lambda n: n > 0)


def no_row(name: str, predicate: Column) -> Expectation:
    return Expectation(name, lambda _: F.count_if(predicate), lambda n: n == 0)


def rate_at_most(name: str, predicate: Column, limit: float) -> Expectation:
    """The share of rows with the predicate; no rows have none."""
    return Expectation(
        f"{name} at most {limit}",
        lambda _: F.coalesce(F.avg(predicate.cast("int")), F.lit(0.0)),
        lambda rate: rate <= limit,
    )


def no_null(column: str) -> Expectation:
    return no_row(f"no null {column}", F.col(column).isNull())


def distinct_exactly(column: str, count: int) -> Expectation:
    return Expectation(
        f"{count} distinct {column}",
        lambda _: F.count_distinct(column),
        lambda n: n == count,
        distinct=True,
    )


def _measures(df: DataFrame, expectations: list[Expectation]) -> list[Column]:
    return [e.measure(df).cast("double").alias(f"m{i}") for i, e in enumerate(expectations)]


def _judged(measured: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(expectation, observed, passed) from one row of measures m0, m1, ..."""
    rows = [
        F.struct(
            F.lit(e.name).alias("expectation"),
            F.col(f"m{i}").alias("observed"),
            F.coalesce(e.holds(F.col(f"m{i}")), F.lit(False)).alias("passed"),
        )
        for i, e in enumerate(expectations)
    ]
    return measured.select(F.inline(F.array(*rows)))


def check(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(expectation, observed, passed), from a single aggregation over the table."""
    return _judged(df.agg(*_measures(df, expectations)), expectations)


class WrittenContract:
    """Expectations that are measured while a table is written, so that it need not be read again for them.

    ``observed`` is the table with the measures attached; write that, then take ``result``. ``df`` should come from
    an ``observing_session``. Expectations on distinct
    values cannot be measured on the way and are left to ``check`` on the written table.
    """

    def __init__(self, df: DataFrame, expectations: list[Expectation]):
        self.expectations = [e for e in expectations if not e.distinct]
        self.left_over = [e for e in expectations if e.distinct]
        self._observation = Observation()
        self.observed = df.observe(self._observation, *_measures(df, self.expectations))

    def result(self, spark: SparkSession) -> DataFrame:
        """(expectation, observed, passed), once ``observed`` was written. One row of numbers comes to the driver."""
        found = self._observation.get
        names = [f"m{i}" for i in range(len(self.expectations))]
        measured = spark.createDataFrame(
            [tuple(found[name] for name in names)], ", ".join(f"{name} double" for name in names)
        )
        return _judged(measured, self.expectations)


def require_columns(
    df: DataFrame, required: list[str] | tuple[str, ...] = (), forbidden_like: str | None = None
) -> DataFrame:
    """The same result shape for the schema; runs no job over the data."""
    missing = [c for c in required if c not in df.columns]
    unwanted = [c for c in df.columns if forbidden_like and forbidden_like in c]
    rows = [
        (f"required columns, missing: {','.join(missing) or 'none'}", float(len(missing)), not missing)
    ]
    if forbidden_like is not None:
        rows.append(
            (f"no column like {forbidden_like}", float(len(unwanted)), not unwanted)
        )
    return df.sparkSession.createDataFrame(rows, _RESULT)


def expect_empty(name: str, offending: DataFrame) -> DataFrame:
    """The same result shape for set checks: no offending row may exist."""
    return check(offending, [no_row(name, F.lit(True))])


def expect_any(name: str, df: DataFrame) -> DataFrame:
    return check(df, [some_row(name, F.lit(True))])


def all_checks(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(result: DataFrame) -> None:
    """Raise with every failed expectation. Only failures reach the driver."""
    failed = result.filter(~F.col("passed")).collect()
    if failed:
        raise ContractViolation(
            "; ".join(f"{row['expectation']} (observed {row['observed']})" for row in failed)
        )


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on both sides: leakage if the sides are train and holdout."""
    # Distinct before the set operation, so a frequent key is shuffled once per task.
    return left.select(key).distinct().intersect(right.select(key).distinct())


def split_leakage(df: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    """Keys that occur in train and in holdout, in one pass over the table."""
    return (
        df.groupBy(key)
        .agg(
            F.bool_or(F.col(split_col) == "train").alias("in_train"),
            F.bool_or(F.col(split_col) == "holdout").alias("in_holdout"),
        )
        .filter("in_train AND in_holdout")
        .select(key)
    )


def class_coverage(left: DataFrame, right: DataFrame, class_col: str) -> DataFrame:
    """Classes on one side only, tagged with the side; empty if both have the same set."""
    sides = left.select(class_col, F.lit(True).alias("on_left")).unionByName(
        right.select(class_col, F.lit(False).alias("on_left"))
    )
    return (
        sides.groupBy(class_col)
        .agg(F.bool_or("on_left").alias("a"), F.bool_or(~F.col("on_left")).alias("b"))
        .filter("NOT (a AND b)")
        .select(class_col, F.when(F.col("a"), "left").otherwise("right").alias("only_in"))
    )


def unknown_values(
    df: DataFrame, column: str, known: DataFrame, known_col: str | None = None
) -> DataFrame:
    """Distinct values of the column that the known set lacks."""
    names = known.select(F.col(known_col or column).alias(column)).distinct()
    return df.select(column).distinct().join(names, column, "left_anti")
