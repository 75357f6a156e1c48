"""Mergeable summaries of batches: quantile sketches and sketches of distinct values.

A batch leaves a few kilobytes a column. Quantiles, drift and distinct counts of any range of batches come from merging
those, without reading a row again. All of it is approximate within the errors stated here; nothing in this package
takes a sketch where an exact result was asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .drift import BINS, _psi_of
from .quantiles import evenly_spaced, long_form, name_of_feature, place_of_feature

#: Size of a quantile sketch. Its rank error falls almost as 1 / K.
K = 4096
#: A distinct sketch has 2 ** LG_K registers.
LG_K = 14
#: Evenly spread quantiles that stand for a sketch's values where ranks are asked for.
GRID = 2000


def rank_error(k: int = K) -> float:
    """Error of a rank as a share of all values, one-sided, in 99 of 100 sketches: the published fit for KLL sketches."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def quantile_sketches(batch: DataFrame, features: list[str], k: int = K) -> DataFrame:
    """(feature, n, sketch) of every feature with an observed value. Nulls and NaN are no values."""
    sketched = long_form(batch, features).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    )
    return sketched.selectExpr(name_of_feature(features), "n", "sketch")


def merge_quantile_sketches(sketches: DataFrame, k: int = K) -> DataFrame:
    """One sketch a feature for all batches; merging once more gives a sketch of the same error."""
    return sketches.groupBy("feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, probabilities: list[float], k: int = K) -> DataFrame:
    """(feature, n, quantiles) over all batches: observed values whose rank is off by ``rank_error`` at most."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    return merge_quantile_sketches(sketches, k).select(
        "feature", "n", F.kll_sketch_get_quantile_double("sketch", wanted).alias("quantiles")
    )


def merged_edges(sketches: DataFrame, bins: int = BINS, k: int = K) -> DataFrame:
    """(feature, n, edges), the shape of ``drift.quantile_edges``, from the sketches of all batches."""
    found = merged_quantiles(sketches, evenly_spaced(bins), k)
    return found.select("feature", "n", F.array_sort(F.array_distinct("quantiles")).alias("edges"))


def psi_from_sketches(
    stored: DataFrame, sketches: DataFrame, features: list[str], bins: int = BINS, k: int = K
) -> DataFrame:
    """(feature, psi) of all batches together against a stored baseline; reads neither side's rows.

    The share of values below each edge comes from the merged sketch and is off by ``rank_error`` and half a step of
    ``GRID`` at most. Undefined cases are those of ``drift.psi``.
    """
    merged = merge_quantile_sketches(sketches, k).withColumnRenamed("n", "held")
    joined = stored.select("feature", "edges", "counts").join(merged, "feature", "left")
    inner = joined.selectExpr(
        place_of_feature(features),
        "size(edges) AS edge_count",
        "counts",
        "held",
        "sketch",
        "if(size(edges) >= 3, slice(edges, 2, size(edges) - 2), array()) AS inner",
    )
    # evenly spread values of the sketch stand for all: the share below an edge is theirs, to half a step
    grid = F.kll_sketch_get_quantile_double("sketch", F.lit([(i + 0.5) / GRID for i in range(GRID)]))
    spread = inner.withColumn("grid", F.when(F.col("sketch").isNotNull(), grid)).withColumn(
        "ranks", F.expr(f"transform(inner, e -> size(filter(grid, v -> v < e)) / {GRID}D)")
    )
    shares = spread.withColumn("ranks", F.concat(F.array(F.lit(0.0)), "ranks", F.array(F.lit(1.0))))
    current = shares.where("held IS NOT NULL").selectExpr(
        "feature",
        "edge_count",
        "posexplode(transform(sequence(1, size(ranks) - 1), i -> ranks[i] - ranks[i - 1])) "
        "AS (bin, share)",
        "held",
    )
    reference = shares.selectExpr("feature", "edge_count", "explode(counts) AS (bin, n_ref)")
    both = reference.selectExpr("feature", "edge_count", "bin", "CAST(n_ref AS DOUBLE) AS n_ref", "0D AS n_cur").unionByName(
        current.selectExpr("feature", "edge_count", "bin", "0D AS n_ref", "share * held AS n_cur")
    )
    summed = both.groupBy("feature", "edge_count", "bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    return _psi_of(summed, features, bins)


def distinct_sketches(batch: DataFrame, columns: list[str], lg_k: int = LG_K) -> DataFrame:
    """(column, sketch) of every column, in one wide pass. Nulls are no values; all others count by their text."""
    made = batch.agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"s{i}") for i, c in enumerate(columns)]
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return made.select(F.inline(F.array(*rows)))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(column, distinct_values) over all batches, each value once: about ``distinct_error`` off."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("column").agg(union.alias("distinct_values"))
