import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridewatch.operators import drift
from stridewatch.operators.quantiles import evenly_spaced, exact_quantiles, sketched_quantiles

NAN = float("nan")


def frame(spark, **columns):
    """Columns of unequal length, padded with null."""
    longest = max((len(v) for v in columns.values()), default=0)
    padded = [list(map(float, v)) + [None] * (longest - len(v)) for v in columns.values()]
    schema = ", ".join(f"{name} double" for name in columns)
    return spark.createDataFrame(list(zip(*padded)), schema)


def numpy_psi(reference, current, bins=10):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, bins + 1)))
    inner = edges[1:-1]
    share = [
        np.maximum(np.bincount(np.searchsorted(inner, x, side="right"), minlength=len(inner) + 1) / len(x), 1e-6)
        for x in (reference, current)
    ]
    return float(((share[1] - share[0]) * np.log(share[1] / share[0])).sum())


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    base = rng.normal(0, 1, 5000)
    return {
        "same": (base, rng.normal(0, 1, 5000)),
        "shifted": (base, rng.normal(2, 1, 5000)),
        "widened": (base, rng.normal(0, 3, 5000)),
        "disjoint": (base, rng.normal(100, 1, 5000)),
        "steps": (rng.integers(0, 7, 3001).astype(float), rng.integers(1, 8, 400).astype(float)),
        "tenths": (np.arange(11) / 10, np.arange(11) / 10),
        "heavy": (np.r_[np.zeros(4000), np.arange(1000)], np.r_[np.zeros(100), np.arange(900)]),
    }


def test_psi_matches_numpy(spark, samples):
    reference = frame(spark, **{k: v[0] for k, v in samples.items()}).repartition(3)
    current = frame(spark, **{k: v[1] for k, v in samples.items()})
    out = drift.psi(reference, current, list(samples))
    got = {r.feature: r.psi for r in out.collect()}
    for name, (ref, cur) in samples.items():
        assert got[name] == pytest.approx(numpy_psi(ref, cur), rel=1e-9, abs=1e-12), name
    assert got["same"] < 0.05 and got["shifted"] > 0.25 and got["widened"] > 0.25
    assert math.isfinite(got["disjoint"]) and min(got.values()) >= 0


@pytest.mark.parametrize("cuts", [{}, {"accuracy": 5, "inner_cuts": 2}, {"accuracy": 50, "inner_cuts": 1}])
def test_exact_quantiles_match_numpy(spark, samples, cuts):
    df = frame(spark, **{k: v[0] for k, v in samples.items()}).repartition(4)
    probabilities = evenly_spaced(10)
    assert probabilities == list(np.linspace(0, 1, 11))
    out = exact_quantiles(df, list(samples), probabilities, **cuts)
    got = {r.feature: (r.n, r.quantiles) for r in out.collect()}
    for name, (ref, _) in samples.items():
        assert got[name][0] == len(ref)
        assert got[name][1] == list(np.quantile(ref, np.linspace(0, 1, 11))), name


def test_sketch_is_close(spark, samples):
    df = frame(spark, x=samples["same"][0])
    found = sketched_quantiles(df, ["x"], evenly_spaced(10)).first().quantiles
    assert np.allclose(found, np.quantile(samples["same"][0], np.linspace(0, 1, 11)), atol=0.02)


def test_quantiles_drop_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (3.0,)], "x double")
    row = exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]).first()
    assert (row.n, row.quantiles) == (2, [1.0, 2.0, 3.0])


def test_undefined_psi_is_nan(spark):
    many = list(range(100))
    reference = frame(spark, constant=[5] * 100, few=[1, 2, 3], no_current=many, nothing=[], nine=many[:9], ten=many[:10])
    current = frame(spark, constant=many, few=many, no_current=[], nothing=[], nine=many, ten=many)
    names = reference.columns
    got = {r.feature: r.psi for r in drift.psi(reference, current, names).collect()}
    assert set(got) == set(names)
    assert all(math.isnan(got[k]) for k in ("constant", "few", "no_current", "nothing", "nine"))
    assert got["ten"] > 0


def test_nulls_do_not_change_psi(spark):
    values = list(range(200))
    clean = frame(spark, x=values)
    dirty = clean.unionByName(spark.createDataFrame([(NAN,), (None,)] * 50, "x double"))
    a = drift.psi(clean, clean.filter("x < 90"), ["x"]).first().psi
    b = drift.psi(dirty, dirty.filter("x < 90 OR x IS NULL"), ["x"]).first().psi
    assert a == pytest.approx(b)


def category(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c bigint")


@pytest.mark.parametrize(
    "reference, current, low, high",
    [
        ([1, 2, 3] * 100, [1, 2, 3] * 50, -1e-12, 0.01),
        ([1, 2] * 100, [1, 99] * 100, 1e-3, 100),
        ([1, 2, None] * 100, [2, 1, None, None] * 100, -1e-12, 1e-9),
    ],
)
def test_categorical_psi(spark, reference, current, low, high):
    got = drift.categorical_psi(category(spark, reference), "c", category(spark, current), "c")
    assert low <= got.first().psi <= high


def test_categorical_psi_of_an_empty_side_is_nan(spark):
    some, none = category(spark, [1, 2]), category(spark, [None])
    for a, b in ((some, none), (none, some), (none, none)):
        assert math.isnan(drift.categorical_psi(a, "c", b, "c").first().psi)


@pytest.mark.parametrize(
    "significant, moderate, prediction, delta, expected",
    [
        (12, 0, 0.9, -0.20, "performance_degraded"),
        (8, 0, 0.05, -0.01, "drift_detected"),
        (0, 0, 0.25, 0.0, "drift_detected"),
        (0, 0, 0.10, 0.0, "drift_moderate"),
        (0, 3, 0.02, 0.0, "drift_moderate"),
        (0, 0, 0.02, 0.004, "ok"),
        (0, 0, 0.01, 0.08, "ok"),
        (0, 0, 0.01, -0.05, "ok"),
        (0, 0, NAN, 0.0, "ok"),
        (0, 0, None, NAN, "ok"),
    ],
)
def test_status(spark, significant, moderate, prediction, delta, expected):
    df = spark.createDataFrame(
        [(significant, moderate, prediction, delta)], "s int, m int, p double, d double"
    )
    status = drift.drift_status(
        F.col("s"), F.col("p"), F.col("d"), features_moderate=F.col("m")
    )
    assert df.select(status.alias("x")).first().x == expected


def test_status_ignores_moderate_features_by_default(spark):
    status = drift.drift_status(F.lit(0), F.lit(0.0), F.lit(0.0))
    assert spark.range(1).select(status.alias("x")).first().x == "ok"


def test_bands_skip_undefined(spark):
    rows = [("a", NAN), ("b", 0.3), ("c", 0.3), ("d", 0.1), ("e", 0.0)]
    df = spark.createDataFrame(rows, "feature string, psi double")
    got = drift.psi_bands(df).first().asDict()
    assert got == {
        "features_compared": 4,
        "features_significant": 2,
        "features_moderate": 1,
        "max_feature_psi": 0.3,
        "top_drifted_feature": "b",
    }
    assert [r.feature for r in drift.top_drifted(df, 3).collect()] == ["b", "c", "d"]
    none = drift.psi_bands(df.filter("isnan(psi)")).first()
    assert none.top_drifted_feature is None and none.max_feature_psi is None


def test_report_with_undefined_psi_only(spark):
    rows = [(1, 1, 5.0)] * 20
    df = spark.createDataFrame(rows, "activity_id int, predicted_activity_id int, x double")
    champion = spark.createDataFrame(
        [("m", 3, "r", 0.9)],
        "model_name string, model_version bigint, model_run_id string, promoted_macro_f1 double",
    )
    row = drift.drift_report(df, df, ["x"], champion).first()
    assert (row.top_drifted_feature, row.max_feature_psi) == (None, None)
    assert (row.reference_rows, row.current_rows, row.status) == (20, 20, "ok")


def test_alert():
    row = {
        "model_name": "m",
        "model_version": 1,
        "features_significant": 2,
        "prediction_psi": 0.3,
        "realised_macro_f1": 0.7,
        "promoted_macro_f1": 0.8,
        "top_drifted_feature": "x",
    }
    assert drift.alert({**row, "status": "ok"}) is None
    assert "2 features" in drift.alert({**row, "status": "drift_detected"})
    with pytest.raises(drift.PerformanceDegraded, match="0.7000"):
        drift.alert({**row, "status": "performance_degraded"})


def test_baseline_gives_the_same_psi_without_the_reference(spark, tmp_path):
    rows = [
        (i % 3 > 0, float(i * 7919 % 301), 1.0, float("nan") if i % 2 else 5.0, None if i % 3 else 2.0, float(i % 4))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "ref boolean, wide double, same double, half double, late double, few double")
    names = ["wide", "same", "half", "late", "few"]
    before, after = df.filter("ref"), df.filter("NOT ref").withColumn("wide", F.col("wide") + 20)
    path = str(tmp_path / "baseline")
    drift.baseline(before, names).write.parquet(path)
    found = drift.psi_from_baseline(spark.read.parquet(path), after, names)
    got, want = ({r.feature: r.psi for r in d.collect()} for d in (found, drift.psi(before, after, names)))
    assert got.keys() == want.keys() == set(names)
    for name in names:
        assert got[name] == pytest.approx(want[name], nan_ok=True, abs=1e-12)
    assert not math.isnan(got["wide"]) and math.isnan(got["late"])
