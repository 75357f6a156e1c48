"""Drift statistics: population stability index per feature and per category, and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import at_least, observed, under, with_count_at_or_below
from .metrics import labelled, outcomes, per_class
from .quantiles import (
    evenly_spaced,
    exact_quantiles,
    long_form,
    name_of_feature,
    place_of_feature,
    sketched_quantiles,
)

# The limits of the bands and the defaults of the monitor.
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
PROPORTION_FLOOR = 1e-6
PERFORMANCE_TOLERANCE = 0.05
BINS = 10


def quantile_edges(
    reference: DataFrame,
    features: list[str],
    bins: int = BINS,
    *,
    approximate: bool = False,
) -> DataFrame:
    """(feature, n, edges): distinct quantiles of the reference, in ascending order."""
    probabilities = evenly_spaced(bins)
    if approximate:
        found = sketched_quantiles(reference, features, probabilities)
    else:
        found = exact_quantiles(reference, features, probabilities)
    return found.select("feature", "n", F.array_distinct("quantiles").alias("edges"))


def histogram_by_edges(
    reference: DataFrame,
    current: DataFrame,
    features: list[str],
    edges: DataFrame,
    bins: int = BINS,
) -> DataFrame:
    """(feature, bin, n_ref, n_cur). The outer bins are open, so bin = inner edges <= value."""
    counted = _histogram(reference, current, features, edges, bins)
    return counted.selectExpr(name_of_feature(features), "bin", "n_ref", "n_cur")


def _inner_edges(edges: DataFrame, features: list[str]) -> DataFrame:
    """(feature, edge_count, inner), one row a feature: its size is fixed by the schema.

    slice() rejects a negative length, and fewer than three edges have no inner edge.
    """
    return edges.selectExpr(
        place_of_feature(features),
        "size(edges) AS edge_count",
        "if(size(edges) >= 3, slice(edges, 2, size(edges) - 2), array()) AS inner",
    )


def _binned(long: DataFrame, inner: DataFrame, bins: int) -> DataFrame:
    return with_count_at_or_below(
        long.join(F.broadcast(inner), "feature", "left"), "inner", "value", "bin", bins
    )


def _histogram(
    reference: DataFrame, current: DataFrame, features: list[str], edges: DataFrame, bins: int
) -> DataFrame:
    # The feature column is its place in the list here; see long_form.
    sides = (
        long_form(reference, features)
        .selectExpr("*", "1 AS is_ref")
        .unionByName(long_form(current, features).selectExpr("*", "0 AS is_ref"))
    )
    placed = _binned(sides, _inner_edges(edges, features), bins)
    return placed.groupBy("feature", "edge_count", "bin").agg(
        F.expr("sum(is_ref) AS n_ref"), F.expr("sum(1 - is_ref) AS n_cur")
    )


def _stability_term(n_ref: str, n_cur: str, all_ref: str, all_cur: str) -> str:
    """(c - r) ln(c / r) on floored proportions; a bin empty on both sides gives 0."""
    r = f"greatest(try_divide({n_ref}, {all_ref}), {PROPORTION_FLOOR}D)"
    c = f"greatest(try_divide({n_cur}, {all_cur}), {PROPORTION_FLOOR}D)"
    return f"({c} - {r}) * ln({c} / {r})"


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: list[str],
    bins: int = BINS,
    *,
    approximate: bool = False,
) -> DataFrame:
    """(feature, psi) for every named column at once.

    NaN where no comparison is possible: fewer reference values than bins, no current value, or
    fewer than three distinct edges. A zero would look like "no drift".
    """
    edges = quantile_edges(reference, features, bins, approximate=approximate)
    return _psi_of(_histogram(reference, current, features, edges, bins), features, bins)


def _psi_of(histogram: DataFrame, features: list[str], bins: int) -> DataFrame:
    totals = histogram.selectExpr(
        "*",
        "sum(n_ref) OVER (PARTITION BY feature) AS all_ref",
        "sum(n_cur) OVER (PARTITION BY feature) AS all_cur",
    )
    term = _stability_term("n_ref", "n_cur", "all_ref", "all_cur")
    summed = totals.groupBy("feature", "edge_count", "all_ref", "all_cur").agg(
        F.expr(f"sum({term}) AS total")
    )
    # Every requested feature gets a row, also one without a single observed value.
    every = histogram.sparkSession.createDataFrame(
        [(i,) for i in range(len(features))], "feature int"
    )
    return every.join(summed, "feature", "left").selectExpr(
        name_of_feature(features),
        f"if(all_ref >= {bins} AND all_cur > 0 AND edge_count >= 3, total, double('NaN')) AS psi",
    )


def baseline(reference: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """(feature, n, edges, counts): all that PSI needs to know of the reference.

    ``counts`` maps a bin to its number of reference values. A few hundred numbers a feature, whatever the
    reference's size: written at training, they spare every monitoring run a scan of the training rows.
    """
    edges = quantile_edges(reference, features, bins)
    inner = _inner_edges(edges, features)
    counted = _binned(long_form(reference, features), inner, bins).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("held")
    )
    # at most ``bins`` entries a feature
    maps = counted.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "held"))).alias("counts")
    )
    return edges.join(maps.selectExpr(name_of_feature(features), "counts"), "feature")


def psi_from_baseline(
    stored: DataFrame, current: DataFrame, features: list[str], bins: int = BINS
) -> DataFrame:
    """(feature, psi), as ``psi`` gives it, from a stored baseline with this number of bins."""
    inner = _inner_edges(stored, features)
    reference = stored.selectExpr(
        place_of_feature(features), "size(edges) AS edge_count", "explode(counts) AS (bin, n_ref)"
    )
    counted = _binned(long_form(current, features), inner, bins).groupBy(
        "feature", "edge_count", "bin"
    ).agg(F.count(F.lit(1)).alias("n_cur"))
    both = reference.selectExpr("*", "0L AS n_cur").unionByName(counted.selectExpr("*", "0L AS n_ref"))
    summed = both.groupBy("feature", "edge_count", "bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    return _psi_of(summed, features, bins)


def label_counts(reference: DataFrame, label_col: str) -> DataFrame:
    """(category, n): the reference's side of the prediction drift."""
    return reference.groupBy(F.col(label_col).cast("long").alias("category")).agg(
        F.count(F.lit(1)).alias("n")
    )


def category_counts(
    reference: DataFrame, reference_col: str, current: DataFrame, current_col: str
) -> DataFrame:
    """(category, n_ref, n_cur) over the union of categories, missing values dropped."""

    def counts(df: DataFrame, col: str, is_ref: int) -> DataFrame:
        kind = df.schema[col].dataType.typeName()
        value = F.col(col)
        keep = observed(value) if kind in ("double", "float") else value.isNotNull()
        n = F.count(F.lit(1))
        return df.filter(keep).groupBy(value.alias("category")).agg(
            (n * is_ref).alias("n_ref"), (n * (1 - is_ref)).alias("n_cur")
        )

    both = counts(reference, reference_col, 1).unionByName(counts(current, current_col, 0))
    return both.groupBy("category").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )


def categorical_psi_from_counts(counts: DataFrame) -> DataFrame:
    totals = counts.selectExpr("struct(sum(n_ref) AS ref, sum(n_cur) AS cur)")
    term = _stability_term("n_ref", "n_cur", "all.ref", "all.cur")
    return counts.withColumn("all", totals.scalar()).selectExpr(
        f"if(sum(n_ref) > 0 AND sum(n_cur) > 0, sum({term}), double('NaN')) AS psi"
    )


def categorical_psi(
    reference: DataFrame, reference_col: str, current: DataFrame, current_col: str
) -> DataFrame:
    """One row (psi) for a discrete distribution; NaN if either side is empty."""
    return categorical_psi_from_counts(
        category_counts(reference, reference_col, current, current_col)
    )


def band(value: Column) -> Column:
    return (
        F.when(at_least(value, PSI_SIGNIFICANT), "significant")
        .when(at_least(value, PSI_MODERATE), "moderate")
        .when(observed(value), "stable")
        .otherwise("undefined")
    )


def psi_bands(feature_psi: DataFrame) -> DataFrame:
    """One row of counts per band, the largest PSI and the feature that has it.

    Undefined PSI is neither counted as drift nor allowed to be the maximum. Of several features
    with the same PSI the first by name is reported; with none defined, null.
    """
    level = band(F.col("psi"))
    defined = observed(F.col("psi"))
    return feature_psi.agg(
        F.count_if(defined).alias("features_compared"),
        F.count_if(level == "significant").alias("features_significant"),
        F.count_if(level == "moderate").alias("features_moderate"),
        F.max(F.when(defined, F.col("psi"))).alias("max_feature_psi"),
        F.min_by("feature", F.when(defined, F.struct(-F.col("psi"), F.col("feature")))).alias(
            "top_drifted_feature"
        ),
    )


def psi_detail(feature_psi: DataFrame) -> DataFrame:
    """(feature, psi, band) of every feature: which ones a warning is about."""
    return feature_psi.select("feature", "psi", band(F.col("psi")).alias("band"))


def top_drifted(feature_psi: DataFrame, limit: int = 20) -> DataFrame:
    """The most drifted features first; undefined PSI is left out."""
    return (
        feature_psi.filter(observed(F.col("psi")))
        .orderBy(F.col("psi").desc(), "feature")
        .limit(limit)
    )


def drift_status(
    features_significant: Column,
    prediction_psi: Column,
    performance_delta: Column,
    *,
    features_moderate: Column | int = 0,
    performance_tolerance: float = PERFORMANCE_TOLERANCE,
) -> Column:
    """Worst finding first: a measured loss of performance outranks every drift signal.

    Moderate features count only if their number is passed in. A delta of exactly the tolerance is
    still acceptable.
    """
    moderate = features_moderate if isinstance(features_moderate, Column) else F.lit(features_moderate)
    return (
        F.when(under(performance_delta, -performance_tolerance), "performance_degraded")
        .when(
            (features_significant > 0) | at_least(prediction_psi, PSI_SIGNIFICANT),
            "drift_detected",
        )
        .when((moderate > 0) | at_least(prediction_psi, PSI_MODERATE), "drift_moderate")
        .otherwise("ok")
    )


def drift_report(
    reference: DataFrame | None,
    current: DataFrame,
    features: list[str],
    champion: DataFrame,
    *,
    label_col: str = "activity_id",
    prediction_col: str = "predicted_activity_id",
    bins: int = BINS,
    performance_tolerance: float = PERFORMANCE_TOLERANCE,
    feature_psi: DataFrame | None = None,
    reference_labels: DataFrame | None = None,
) -> DataFrame:
    """The monitoring row, without its load time. With ``feature_psi`` and ``reference_labels`` (see
    ``label_counts``) from a stored baseline no reference is needed.

    ``champion`` is one row (model_name, model_version, model_run_id, promoted_macro_f1). Row
    counts, prediction drift and realised F1 come from one label x prediction table.
    """
    if feature_psi is None:
        feature_psi = psi(reference, current, features, bins)
    bands = psi_bands(feature_psi).drop("features_compared")
    outcome = outcomes(current, label_col, prediction_col)
    n = F.col("n")
    labels = label_counts(reference, label_col) if reference_labels is None else reference_labels
    mix = (
        labels.select("category", n.alias("n_ref"), F.lit(0).cast("long").alias("n_cur"))
        .unionByName(
            outcome.groupBy(F.col("prediction").cast("long").alias("category")).agg(
                F.lit(0).cast("long").alias("n_ref"), F.sum("n").alias("n_cur")
            )
        )
        .groupBy("category")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    rows = mix.agg(
        F.struct(F.sum("n_ref").alias("reference_rows"), F.sum("n_cur").alias("current_rows"))
    )
    prediction = categorical_psi_from_counts(mix.filter(F.col("category").isNotNull()))
    realised = per_class(labelled(outcome)).agg(F.avg("f1"))

    # One row each; a scalar subquery fails if that ever stops being true.
    parts = champion.select(
        "*",
        rows.scalar().alias("rows"),
        bands.select(F.struct("*")).scalar().alias("bands"),
        prediction.scalar().alias("prediction_psi"),
        realised.scalar().alias("realised_macro_f1"),
    ).select("*", "rows.*", "bands.*")
    delta = F.col("realised_macro_f1") - F.col("promoted_macro_f1")
    status = drift_status(
        F.col("features_significant"),
        F.col("prediction_psi"),
        F.col("performance_delta"),
        features_moderate=F.col("features_moderate"),
        performance_tolerance=performance_tolerance,
    )
    return (
        parts.withColumn("performance_delta", delta)
        .withColumn("status", status)
        .select(
            "model_name",
            "model_version",
            "model_run_id",
            "reference_rows",
            "current_rows",
            "features_significant",
            "features_moderate",
            "max_feature_psi",
            "top_drifted_feature",
            "prediction_psi",
            "promoted_macro_f1",
            "realised_macro_f1",
            "performance_delta",
            "status",
        )
    )


class PerformanceDegraded(RuntimeError):
    """The champion does measurably worse than when it was promoted."""


def alert(report_row: dict, performance_tolerance: float = PERFORMANCE_TOLERANCE) -> str | None:
    """Raise on degraded performance, return a warning on drift, None if all is well.

    Takes the collected report row; call it after the row has been written.
    """
    status = report_row["status"]
    if status == "performance_degraded":
        raise PerformanceDegraded(
            "version {model_version} of {model_name}: macro F1 {realised_macro_f1:.4f}, promoted "
            "at {promoted_macro_f1:.4f}, tolerance {tolerance}; top drifted feature "
            "{top_drifted_feature}".format(tolerance=performance_tolerance, **report_row)
        )
    if status.startswith("drift"):
        return (
            "{status}: {features_significant} features at or above {limit}, prediction PSI "
            "{prediction_psi:.3f}; performance within tolerance".format(
                limit=PSI_SIGNIFICANT, **report_row
            )
        )
    return None
