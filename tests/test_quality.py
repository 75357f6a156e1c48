import pytest
from pyspark.sql import functions as F

from stridewatch.operators import quality, scoring, training
from stridewatch.session import observing_session


@pytest.fixture
def gold(spark):
    rows = [(1, 1, "train", None), (1, 2, "train", 2.0), (2, 1, "holdout", 3.0), (None, 3, "holdout", 4.0)]
    return spark.createDataFrame(rows, "subject_id int, activity_id int, split string, x double")


def outcomes(result):
    return [(r.observed, r.passed) for r in result.collect()]


def test_scalar_expectations_share_one_pass(gold):
    result = quality.check(
        gold,
        [
            quality.null_rate_between("x", 0.2, 0.3),
            quality.null_rate_between("x", 0.3, 0.4),
            quality.null_rate_below("x", 0.25),
            quality.distinct_exactly("subject_id", 2),
            quality.not_empty(),
            quality.some_row("validation rows", F.col("split") == "validation"),
            quality.no_row("no activity 3", F.col("activity_id") == 3),
            quality.no_null("subject_id"),
        ],
    )
    assert outcomes(result) == [
        (0.25, True),
        (0.25, False),
        (0.25, False),
        (2.0, True),
        (4.0, True),
        (0.0, False),
        (1.0, False),
        (1.0, False),
    ]


def test_rates_of_an_empty_table_fail(gold):
    empty = gold.limit(0)
    result = quality.check(empty, [quality.null_rate_below("x", 0.5), quality.not_empty()])
    assert [passed for _, passed in outcomes(result)] == [False, False]


def test_enforce_lists_every_failure(gold):
    result = quality.check(gold, [quality.no_null("x"), quality.no_null("subject_id"), quality.not_empty()])
    with pytest.raises(quality.ContractViolation) as error:
        quality.enforce(result)
    assert "no null x" in str(error.value) and "no null subject_id" in str(error.value)
    assert "has rows" not in str(error.value)
    quality.enforce(result.filter("passed"))


def test_columns(gold):
    assert outcomes(quality.require_columns(gold, ["x", "split"], "orient_")) == [(0.0, True), (0.0, True)]
    assert outcomes(quality.require_columns(gold, ["y"], "spl")) == [(1.0, False), (1.0, False)]


def test_leakage_forms_agree(spark):
    rows = [(1, "train"), (1, "holdout"), (2, "train"), (3, "holdout"), (3, "unassigned"), (None, "train")]
    df = spark.createDataFrame(rows, "s int, split string")
    one_pass = quality.split_leakage(df, "s").collect()
    both = quality.shared_keys(df.filter("split = 'train'"), df.filter("split = 'holdout'"), "s").collect()
    assert one_pass == both and [r.s for r in both] == [1]


def test_class_coverage(gold):
    split = F.col("split")
    found = quality.class_coverage(gold.filter(split == "train"), gold.filter(split == "holdout"), "activity_id")
    assert {tuple(r) for r in found.collect()} == {(2, "left"), (3, "right")}


def test_unknown_values(spark, gold):
    predicted = spark.createDataFrame([(1,), (9,), (9,)], "p int")
    assert [r.p for r in quality.unknown_values(predicted, "p", gold, "activity_id").collect()] == [9]


def test_set_checks_become_expectations(gold):
    assert outcomes(quality.expect_empty("nothing", gold.limit(0))) == [(0.0, True)]
    assert outcomes(quality.expect_empty("nothing", gold)) == [(4.0, False)]
    assert outcomes(quality.expect_any("something", gold.limit(0))) == [(0.0, False)]


def test_latest_prediction_wins(spark):
    features = spark.createDataFrame([(1, 0, 0, 5), (1, 1, 0, 6)], "subject_id int, win bigint, phase int, activity_id int")
    predictions = spark.createDataFrame(
        [(1, 0, 0, 3, 1), (1, 0, 0, 5, 2), (1, 0, 0, 4, 2), (2, 0, 0, 1, 1)],
        "subject_id int, win bigint, phase int, predicted_activity_id bigint, scored_at int",
    )
    joined = scoring.join_predictions(features, predictions).collect()
    assert [(r.win, r.predicted_activity_id) for r in joined] == [(0, 5)]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i % 2 + 7, float(i % 2) + (i % 5) / 10, None if i % 3 else 1.0, None) for i in range(60)]
    df = spark.createDataFrame(rows, "activity_id int, a double, b double, c double")
    model = training.train_classifier(df, ["a", "b", "c"], "activity_id", params={"numTrees": 3, "maxDepth": 2, "seed": 1})
    return df, model


def test_model_tolerates_missing_values(trained):
    df, model = trained
    assert scoring.model_inputs(model) == ["a", "b"]
    assert training.model_contract(model, df) == [("a", "double"), ("b", "double")]
    scored = scoring.score(model, df.withColumn("a", F.nanvl("a", F.lit(0.0))), ["activity_id"], "p")
    assert scored.dtypes == [("activity_id", "int"), ("p", "bigint")]
    assert scored.filter("p <> activity_id").count() == 0
    assert scored.count() == 60


def test_wrong_inputs_are_named(trained):
    df, _ = trained
    scoring.require_inputs(df, [("a", "double")])
    with pytest.raises(ValueError, match="a: expected float, found double; z: expected double, found nothing"):
        scoring.require_inputs(df, [("a", "float"), ("z", "double")])


def test_boosted_multiclass(spark):
    df = spark.createDataFrame([(i % 3, float(i % 3)) for i in range(30)], "y int, a double")
    model = training.train_classifier(df, ["a"], "y", boosted=True, params={"maxIter": 2, "maxDepth": 2, "seed": 1})
    assert scoring.score(model, df, ["y"], "p").filter("p <> y").count() == 0


@pytest.fixture(scope="module")
def stepped(spark):
    """A label that follows from a, b and whether c is missing; twenty subjects."""
    rows = [
        (i, f"s{i % 20}", float(i % 7), float(i * 5 % 11), None if i % 3 == 0 else float(i % 4)) for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k int, subject string, a double, b double, c double")
    label = F.when(F.col("c").isNull(), 9).when(F.col("a") < 3, 4).when(F.col("b") < 5, 5).otherwise(7)
    return df.withColumn("y", label)


STEPS = {"maxIter": 40, "stepSize": 0.8, "maxDepth": 3, "seed": 3, "validationTol": 0.2}


def test_boosting_stops_early_and_is_saved_whole(spark, stepped, tmp_path):
    model = training.train_classifier(
        stepped, ["a", "b", "c"], "y", boosted=True, params=STEPS, subject_col="subject", validation_fraction=0.2
    )
    rounds = training.rounds_used(model)
    assert len(rounds) == 4 and all(1 <= r < 40 for r in rounds)
    model.write().save(str(tmp_path / "model"))
    loaded = training.PipelineModel.load(str(tmp_path / "model"))
    assert scoring.model_inputs(loaded) == ["a", "b", "c"]
    assert training.rounds_used(loaded) == rounds
    # the median of c is a reading of others: only the indicator tells them apart
    assert scoring.score(loaded, stepped, ["y"], "p").filter("p <> y").count() == 0


def test_validation_is_by_subject(spark, stepped):
    marked = training.with_validation_subjects(stepped, "subject", 0.2)
    sides = marked.groupBy("subject").agg(F.count_distinct(training.VALIDATES).alias("n"), F.max(training.VALIDATES).alias("v"))
    rows = sides.collect()
    assert all(r.n == 1 for r in rows) and sum(r.v for r in rows) in (3, 4, 5)
    few = training.with_validation_subjects(stepped.filter("k < 3"), "subject", 0.1)
    assert few.filter(training.VALIDATES).select("subject").distinct().count() == 1


def test_one_subject_leaves_nothing_to_validate_on(spark, stepped):
    alone = stepped.withColumn("subject", F.lit("s")).filter("c IS NOT NULL")
    params = {**STEPS, "maxIter": 3}
    model = training.train_classifier(alone, ["a", "b", "c"], "y", boosted=True, params=params, subject_col="subject")
    assert training.rounds_used(model) == [3, 3, 3]


def test_lineage(spark):
    df = spark.range(3)
    champion = spark.createDataFrame([("m", 2, "r")], "model_name string, model_version bigint, model_run_id string")
    a = scoring.stamp_lineage(df, "m", 2, "r")
    b = scoring.stamp_lineage_from(df, champion)
    assert a.collect() == b.collect() and len(a.columns) == 4


def test_a_nan_column_fails_the_null_rate_contract(spark):
    df = spark.createDataFrame([(1.0, "NaN"), (float("nan"), "a"), (None, None)], "x double, s string")
    got = quality.check(df, [quality.null_rate_below("x", 0.5), quality.null_rate_below("s", 0.5)]).collect()
    assert [round(r.observed, 6) for r in got] == [0.666667, 0.333333]
    assert [r.passed for r in got] == [False, True]


def test_a_contract_measured_during_the_write(spark, tmp_path):
    own = observing_session(spark)
    df = own.createDataFrame([(i % 5, float(i) if i % 4 else None) for i in range(40)], "k int, x double")
    wanted = [
        quality.not_empty(),
        quality.null_rate_between("x", 0.2, 0.3),
        quality.distinct_exactly("k", 5),
        quality.no_row("k is small", F.col("k") > 3),
    ]
    contract = quality.WrittenContract(df, wanted)
    path = str(tmp_path / "table")
    contract.observed.write.parquet(path)
    written = spark.read.parquet(path)
    both = quality.all_checks(contract.result(spark), quality.check(written, contract.left_over))
    assert [e.name for e in contract.left_over] == ["5 distinct k"]
    assert sorted(both.collect()) == sorted(quality.check(df, wanted).collect())
    with pytest.raises(quality.ContractViolation, match="k is small"):
        quality.enforce(both)


def test_a_contract_over_no_rows(spark, tmp_path):
    df = observing_session(spark).createDataFrame([], "k int, x double")
    contract = quality.WrittenContract(df, [quality.not_empty(), quality.null_rate_below("x", 0.5)])
    contract.observed.write.parquet(str(tmp_path / "none"))
    assert [r.passed for r in contract.result(spark).collect()] == [False, False]


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    from stridewatch.plans import catalog

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = catalog.join_predictions_bucketed(spark, sf_dir)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan and "Join" in plan
        assert joined.count() == catalog.join_predictions(spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
