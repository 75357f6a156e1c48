import random

import pytest
from pyspark.sql import functions as F

from stridewatch.functions import micros
from stridewatch.operators import features, windows
from stridewatch.operators.filling import forward_fill
from stridewatch.plans.features import feature_plan

KEYS = ["subject_id", "activity_id"]
READING = "subject_id bigint, activity_id bigint, timestamp_s double, heart_rate double"


def filled(spark, rows, **options):
    df = spark.createDataFrame(rows, READING)
    out = forward_fill(
        df, "heart_rate", partition_cols=KEYS, order_col="timestamp_s", **options
    )
    return [r.heart_rate_filled for r in out.orderBy(*KEYS, "timestamp_s").collect()]


def test_fill_carries_forward(spark):
    rows = [(1, 1, 0.0, 70.0), (1, 1, 1.0, None), (1, 1, 2.0, 75.0), (1, 1, 3.0, None)]
    assert filled(spark, rows) == [70.0, 70.0, 75.0, 75.0]


def test_fill_stops_at_activity_and_subject(spark):
    rows = [(1, 1, 0.0, 70.0), (1, 2, 1.0, None), (2, 1, 2.0, None), (2, 1, 3.0, 60.0)]
    assert filled(spark, rows) == [70.0, None, None, 60.0]


def test_fill_names_the_output(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 70.0)], READING)
    out = forward_fill(
        df, "heart_rate", partition_cols=KEYS, order_col="timestamp_s", output_col="hr"
    )
    assert out.columns == [*df.columns, "hr"]


def brute_force(rows, tie=True):
    """Row number -> own reading, else the largest at its place, else the last one before."""
    places = {}
    for key, time, i, value in rows:
        place = (time is not None, time or 0, i if tie else 0)
        best = places.setdefault(repr(key), {}).get(place)
        seen = [v for v in (best, value) if v is not None and v == v]
        places[repr(key)][place] = max(seen, default=None)
    carried = {}
    for key, at in places.items():
        last = None
        for place in sorted(at):
            last = at[place] if at[place] is not None else last
            carried[key, place] = last
    out = {}
    for key, time, i, value in rows:
        own = value is not None and value == value
        place = (time is not None, time or 0, i if tie else 0)
        out[i] = value if own else carried[repr(key), place]
    return out


def skewed_rows(seed, rows=6000):
    """One key holds a third of the rows, one instant a tenth of that; a null key is hot too."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        key = 1 if i % 3 == 0 else (None if i % 7 == 0 else rng.randint(2, 400))
        time = 500 if key == 1 and rng.random() < 0.1 else rng.randint(-1000, 100_000)
        if rng.random() < 0.01:
            time = None
        value = round(rng.random(), 6) if rng.random() < 0.1 else None
        if value is not None and rng.random() < 0.1:
            value = float("nan")
        out.append((key, time, i, value))
    return out


@pytest.mark.parametrize("tie", [True, False])
@pytest.mark.parametrize("span", [1, 777.5, 10**9])
def test_fill_equals_brute_force_for_any_span(spark, tie, span):
    rows = skewed_rows(1)
    df = spark.createDataFrame(rows, "k int, t bigint, i bigint, v double").repartition(5)
    out = forward_fill(
        df, "v", partition_cols=["k"], order_col="t", tie_col="i" if tie else None, span_seconds=span
    )
    assert out.columns == ["k", "t", "i", "v", "v_filled"]
    assert {r.i: r.v_filled for r in out.collect()} == brute_force(rows, tie)


def test_fill_with_timestamps(spark):
    rows = skewed_rows(3, 2000)
    df = spark.createDataFrame(rows, "k int, t bigint, i bigint, v double")
    timed = df.withColumn("t", F.timestamp_seconds("t"))
    out = forward_fill(
        timed, "v", partition_cols=["k"], order_col="t", tie_col="i", span_seconds=600
    )
    assert {r.i: r.v_filled for r in out.collect()} == brute_force(rows)


def test_fill_does_not_depend_on_row_order(spark):
    """Four rows an instant, a third of all rows at one: reversed and dealt anew, the same values."""
    rng = random.Random(8)
    rows = [
        (1 + i % 2, 7 if i % 3 == 0 else i // 4, i, float(rng.randint(0, 9)) if rng.random() < 0.3 else None)
        for i in range(400)
    ]
    schema = "k int, t bigint, i bigint, v double"
    found = []
    for given, parts, span in ((rows, 1, 3600), (rows[::-1], 4, 3600), (rows[::-1], 3, 5)):
        df = spark.createDataFrame(given, schema).repartition(parts)
        out = forward_fill(df, "v", partition_cols=["k"], order_col="t", span_seconds=span)
        found.append({r.i: r.v_filled for r in out.collect()})
    assert found[0] == found[1] == found[2] == brute_force(rows, tie=False)


def test_building_the_fill_runs_no_job(spark):
    df = spark.createDataFrame(skewed_rows(4, 50), "k int, t bigint, i bigint, v double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    forward_fill(df, "v", partition_cols=["k"], order_col="t")
    assert list(tracker.getJobIdsForGroup("build-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_windows_cover_each_row_twice(spark):
    df = spark.createDataFrame([(0.0,), (2.56,), (5.12,), (7.0,)], "t double")
    got = {
        (r.t, r.win, r.phase)
        for r in windows.assign_overlapping_windows(df, "t", 5.12).collect()
    }
    assert got == {
        (0.0, 0, 0),
        (0.0, -1, 1),
        (2.56, 0, 0),
        (2.56, 0, 1),
        (5.12, 1, 0),
        (5.12, 0, 1),
        (7.0, 1, 0),
        (7.0, 0, 1),
    }


def test_exact_multiples_of_the_window_start_a_window(spark):
    df = spark.range(2000).select((F.col("id") * 5.12).alias("t"), "id")
    out = windows.assign_overlapping_windows(df, "t", 5.12).filter("phase = 0")
    assert out.filter(F.col("win") != F.col("id")).count() == 0


@pytest.mark.parametrize("overlap", [0.0, 0.5, 0.75])
def test_window_forms_agree(spark, overlap):
    df = spark.range(500).select("id", F.timestamp_micros(F.col("id") * 777_777).alias("ts"))
    exploded = windows.assign_overlapping_windows(df, "ts", 60, overlap)
    union = windows.assign_windows_by_union(df, "ts", 60, overlap)
    assert exploded.exceptAll(union).count() == union.exceptAll(exploded).count() == 0
    builtin = windows.assign_sliding_windows(df, "ts", 60, overlap)
    ours = exploded.select("id", windows.window_start(60, overlap).alias("start"))
    theirs = builtin.select("id", micros(builtin, "window_start").alias("start"))
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_uneven_overlap_is_rejected(spark):
    with pytest.raises(ValueError):
        windows.assign_overlapping_windows(spark.createDataFrame([(0.0,)], "t double"), "t", 10, 0.3)


def test_micros_of_wall_clock_ignores_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00.123456' AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert df.select(micros(df, "t").alias("u")).first().u == 1_711_852_200_123_456
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_signal_statistics(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "k int, x double")
    got = {r.k: r for r in features.window_features(df, ["k"], ["x"]).collect()}
    assert (got[1].x_mean, got[1].x_min, got[1].x_max, got[1].x_energy) == (2.0, 1.0, 3.0, 5.0)
    assert got[1].x_std == pytest.approx(2**0.5)
    assert got[2].x_std is None and got[2].sample_count == 1


def test_split_by_subject(spark):
    df = spark.createDataFrame([(s,) for s in (101, 107, 999)], "subject_id bigint")
    out = features.assign_split(
        df, train_subjects=range(101, 107), holdout_subjects=range(107, 110)
    )
    assert [r.split for r in out.orderBy("subject_id").collect()] == [
        "train",
        "holdout",
        "unassigned",
    ]


def test_empty_split_list_means_empty(spark):
    df = spark.createDataFrame([(101,)], "subject_id bigint")
    assert features.assign_split(df, train_subjects=[]).first().split == "unassigned"


def test_split_from_table_keeps_rows_with_duplicate_assignments(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "subject_id bigint")
    lists = spark.createDataFrame([(1, "train"), (1, "train"), (2, "holdout")], "subject_id bigint, split string")
    out = features.assign_split_from_table(df, lists)
    assert sorted((r.subject_id, r.split) for r in out.collect()) == [
        (1, "train"),
        (2, "holdout"),
        (3, "unassigned"),
    ]


def test_partial_windows(spark):
    counts = [(i, n) for i, n in enumerate([512, 500, 461, 460, 40])]
    df = spark.createDataFrame(counts, "win bigint, sample_count bigint")
    kept = sorted(r.sample_count for r in features.drop_partial_windows(df).collect())
    assert kept == [461, 500, 512]


def test_feature_plan_shuffles_whole_readings_once(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 70.0)], READING).withColumn("x", F.rand(1))
    plan = feature_plan(
        df, sensor_cols=["x"], slow_col="heart_rate", window_seconds=5.12, expected=1
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 2
    lines = text.splitlines()
    moved = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert sum("rand(1)" in line for line in moved) <= 1


def test_feature_plan_is_the_same_for_any_span(spark):
    rows = [(1, 1, i / 50, float(i) if i % 9 == 0 else None) for i in range(3000)]
    rows += [(s, 2, i / 50, 1.0) for s in range(2, 60) for i in range(60)]
    df = spark.createDataFrame(rows, READING).withColumn("x", F.sin("timestamp_s"))
    options = dict(
        sensor_cols=["x"],
        slow_col="heart_rate",
        window_seconds=5.12,
        expected=256,
        train_subjects=[1],
    )
    order = ["subject_id", "activity_id", "win", "phase"]
    a, b = (
        feature_plan(df, **options, span_seconds=span).orderBy(*order).toPandas() for span in (3600, 3)
    )
    assert len(a) > 20
    for column in a:
        if a[column].dtype == float:
            assert (a[column] - b[column]).abs().max() < 1e-9


def test_statistics_skip_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0), (1, None)], "k int, x double")
    got = features.window_features(df, ["k"], ["x"], {"x": "y"}).first()
    assert (got.x_mean, got.x_min, got.x_max, got.x_energy, got.y_max) == (2.0, 1.0, 3.0, 5.0, 3.0)
    assert got.sample_count == 4
