import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridewatch.operators import drift, sketches
from stridewatch.operators.quantiles import evenly_spaced

NAMES = ["wide", "few", "half", "never"]


@pytest.fixture(scope="module")
def batches(spark):
    rng = np.random.default_rng(4)
    rows = [
        (i % 4, float(rng.normal()), float(i % 5), float("nan") if i % 2 else float(i), None) for i in range(20_000)
    ]
    df = spark.createDataFrame(rows, "batch int, wide double, few double, half double, never double")
    kept = [sketches.quantile_sketches(df.filter(F.col("batch") == b), NAMES, 400) for b in range(4)]
    merged = kept[0]
    for more in kept[1:]:
        merged = merged.unionByName(more)
    return df, merged.cache()


def test_merged_quantiles_are_within_the_stated_error(batches):
    df, kept = batches
    points = evenly_spaced(10)
    found = {r.feature: r for r in sketches.merged_quantiles(kept, points, 400).collect()}
    assert found.keys() == {"wide", "few", "half"}
    error = sketches.rank_error(400)
    for name, row in found.items():
        values = np.array([r[0] for r in df.select(name).collect()])
        values = np.sort(values[~np.isnan(values)])
        assert row.n == len(values)
        for p, q in zip(points, row.quantiles):
            assert np.searchsorted(values, q, "left") / row.n - error <= p <= np.searchsorted(values, q, "right") / row.n + error


def test_merging_in_two_steps_or_one(batches):
    _, kept = batches
    halves = sketches.merge_quantile_sketches(kept.limit(6), 400).unionByName(sketches.merge_quantile_sketches(kept.limit(0), 400))
    assert halves.count() <= 3
    once = sketches.merge_quantile_sketches(kept, 400).select("feature", "n")
    twice = sketches.merge_quantile_sketches(sketches.merge_quantile_sketches(kept, 400), 400).select("feature", "n")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_edges_have_the_shape_of_exact_ones(batches):
    df, kept = batches
    near = {r.feature: r for r in sketches.merged_edges(kept, 10, 400).collect()}
    exact = {r.feature: r for r in drift.quantile_edges(df, NAMES).collect()}
    assert near.keys() == exact.keys()
    assert near["few"].edges == [0.0, 1.0, 2.0, 3.0, 4.0]
    for name in near:
        assert near[name].n == exact[name].n and near[name].edges == sorted(set(near[name].edges))


def test_drift_from_sketches_is_near_the_exact_one(batches):
    df, kept = batches
    earlier = df.withColumn("wide", F.col("wide") * 1.5 + 0.3).withColumn("half", F.lit(1.0))
    stored = drift.baseline(earlier, NAMES)
    near = {r.feature: r.psi for r in sketches.psi_from_sketches(stored, kept, NAMES, k=400).collect()}
    exact = {r.feature: r.psi for r in drift.psi(earlier, df, NAMES).collect()}
    assert near.keys() == exact.keys() == set(NAMES)
    for name in NAMES:
        assert math.isnan(near[name]) == math.isnan(exact[name])
        assert math.isnan(near[name]) or abs(near[name] - exact[name]) < 0.03
    assert exact["wide"] > 0.1 and near["few"] == pytest.approx(exact["few"], abs=1e-3)


def test_no_rows(batches):
    df, _ = batches
    nothing = df.limit(0)
    assert sketches.quantile_sketches(nothing, NAMES).count() == 0
    stored = drift.baseline(df, NAMES)
    found = sketches.psi_from_sketches(stored, sketches.quantile_sketches(nothing, NAMES), NAMES).collect()
    assert len(found) == 4 and all(math.isnan(r.psi) for r in found)
    counted = sketches.merged_distinct(sketches.distinct_sketches(nothing, ["wide"])).collect()
    assert [(r.column, r.distinct_values) for r in counted] == [("wide", 0)]


def test_distinct_counts_of_batches_that_overlap(spark):
    parts = [spark.range(0, 6000), spark.range(3000, 9000), spark.range(0, 10)]
    kept = sketches.distinct_sketches(parts[0], ["id"])
    for part in parts[1:]:
        kept = kept.unionByName(sketches.distinct_sketches(part, ["id"]))
    found = sketches.merged_distinct(kept).first()
    assert found.column == "id" and abs(found.distinct_values / 9000 - 1) < 3 * sketches.distinct_error()
