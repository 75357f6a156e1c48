"""Exact linear-interpolated quantiles of many columns, without collecting a column anywhere.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a sketch of each column
gives cuts close to the wanted ranks, one pass counts the values between cuts, and only the values of
buckets that hold a wanted rank, about two in ten thousand a rank, go on, equal values as one row with
their number: they are cut and counted once more, and what remains is sorted. The same steps are
taken for every amount of data. Counts decide which bucket holds a rank, so a sketch that is off
makes a bucket larger and never a quantile wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_count_at_or_below

#: Accuracy of the sketch: a bucket around a rank holds about two in so many of the rows.
ACCURACY = 10_000
#: Cuts within such a bucket; the buckets that are sorted hold that part of it.
INNER_CUTS = 63


def evenly_spaced(bins: int) -> list[float]:
    """Probabilities i/bins as multiples of one step, so 0.3 is 3 * 0.1 and not the literal."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (feature, value) for every observed value; ``feature`` is the place in ``columns``.

    An array and its positions, not ``unpivot``: for hundreds of columns the generated code of an
    expand is too long for the JVM to compile, and a number is a cheaper key than a name.
    """
    values = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.selectExpr(f"posexplode(array({values})) AS (feature, value)")
    return long.filter("value IS NOT NULL AND NOT isnan(value)")


def _names(columns: list[str]) -> str:
    quoted = [c.replace("\\", "\\\\").replace("'", "\\'") for c in columns]
    return "array({})".format(", ".join(f"'{c}'" for c in quoted))


def name_of_feature(columns: list[str]) -> str:
    return f"element_at({_names(columns)}, feature + 1) AS feature"


def place_of_feature(columns: list[str]) -> str:
    return f"CAST(array_position({_names(columns)}, feature) - 1 AS INT) AS feature"


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    *,
    accuracy: int = ACCURACY,
    inner_cuts: int = INNER_CUTS,
) -> DataFrame:
    """(feature, n, quantiles) per column with at least one observed value. Runs no job by itself."""
    long = long_form(df, columns)
    near = sorted({min(max(p + d / accuracy, 0.0), 1.0) for p in probabilities for d in (-1, 1)})
    even = [(i + 1) / (inner_cuts + 1) for i in range(inner_cuts)]
    cuts = long.groupBy("feature").agg(_sketch(near, accuracy).alias("cuts"))
    outer = _placed(long, cuts, ["feature"], "outer", len(near)).select("feature", "outer", "value")
    cells = outer.groupBy("feature", "outer").agg(F.expr("count(*) AS held"))
    ranks = _wanted(cells, probabilities)
    wanted = ranks.select("feature", "outer").dropDuplicates(["feature", "outer"])
    # only cells with a wanted rank go on; there are as many as ranks at most
    values = (
        outer.join(F.broadcast(wanted), ["feature", "outer"])
        .groupBy("feature", "outer", "value")
        .agg(F.expr("count(*) AS copies"))
    )
    within = values.groupBy("feature", "outer").agg(_sketch(even, accuracy).alias("cuts"))
    inner = _placed(values, within, ["feature", "outer"], "inner", inner_cuts)
    found = _interpolated(_values_at_ranks(inner, ranks), probabilities, "at[{rank}]")
    return found.selectExpr(name_of_feature(columns), "n", "quantiles")


def _sketch(cuts_at: list[float], accuracy: int):
    """Aggregate: ascending distinct cuts near these quantiles."""
    return F.array_sort(F.array_distinct(F.percentile_approx("value", cuts_at, accuracy)))


def _placed(long: DataFrame, cuts: DataFrame, keys: list[str], name: str, longest: int) -> DataFrame:
    """The rows of groups with cuts, and how many of its group's cuts are at most the value. There are
    as many rows of cuts as groups, which the columns and probabilities bound."""
    return with_count_at_or_below(long.join(F.broadcast(cuts), keys), "cuts", "value", name, longest)


def _literal(probabilities: list[float]) -> str:
    return f"array({', '.join(f'{p!r}D' for p in probabilities)})"


def _wanted(held: DataFrame, probabilities: list[float]) -> DataFrame:
    """(feature, outer, before, n, rank): where the two ranks around each quantile lie.

    ``held`` has the number of values of each bucket; a column has a few dozen.
    """
    pairs = (
        f"transform({_literal(probabilities)}, p -> array(floor((n - 1) * p), "
        "least(floor((n - 1) * p) + 1, n - 1)))"
    )
    return (
        held.selectExpr(
            "feature",
            "outer",
            "held",
            "sum(held) OVER (PARTITION BY feature ORDER BY outer) - held AS before",
            "sum(held) OVER (PARTITION BY feature) AS n",
        )
        .selectExpr("*", f"explode(array_distinct(flatten({pairs}))) AS rank")
        .filter("rank >= before AND rank < before + held")
        .drop("held")
    )


def _values_at_ranks(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(feature, n, at): ``at`` maps every wanted rank to its value. ``values`` has distinct values."""
    bucket = ["feature", "outer", "inner"]
    starts = values.groupBy(*bucket).agg(F.expr("sum(copies) AS held")).selectExpr(
        *bucket, "held", "sum(held) OVER (PARTITION BY feature, outer ORDER BY inner) - held AS earlier"
    )
    # as few rows as there are ranks
    located = (
        starts.join(F.broadcast(ranks), ["feature", "outer"])
        .selectExpr(*bucket, "before + earlier AS start", "held", "n", "rank")
        .filter("rank >= start AND rank < start + held")
    )
    running = values.selectExpr(
        "*", "sum(copies) OVER (PARTITION BY feature, outer, inner ORDER BY value) AS upto"
    )
    return (
        running.join(F.broadcast(located), bucket)
        .filter("rank < start + upto AND rank >= start + upto - copies")
        .groupBy("feature", "n")
        # Two ranks per probability.
        .agg(F.expr("map_from_entries(collect_list(struct(rank, value))) AS at"))
    )


def _interpolated(at_rank: DataFrame, probabilities: list[float], lookup: str) -> DataFrame:
    """Between the two ranks, from the nearer one, which is exact at both ends."""
    low = lookup.format(rank="floor((n - 1) * p)")
    high = lookup.format(rank="least(floor((n - 1) * p) + 1, n - 1)")
    ends = (
        f"transform({_literal(probabilities)}, p -> struct("
        f"(n - 1) * p - floor((n - 1) * p) AS along, {low} AS low, {high} AS high))"
    )
    between = (
        "if(e.along < 0.5, e.low + (e.high - e.low) * e.along, "
        "e.high - (e.high - e.low) * (1 - e.along))"
    )
    return at_rank.selectExpr("feature", "n", f"transform({ends}, e -> {between}) AS quantiles")


def sketched_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], *, accuracy: int = 10_000
) -> DataFrame:
    """The same shape from ``percentile_approx``: one pass, rank error about 1/accuracy."""
    return (
        long_form(df, columns)
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("value", probabilities, accuracy).alias("quantiles"),
        )
        .selectExpr(name_of_feature(columns), "n", "quantiles")
    )
