import pytest
from pyspark.sql import functions as F

from stridewatch.operators import registry

NAN = float("nan")
CANDIDATE = "candidate_score double, has_signature boolean, champion_score double"


def judge(spark, score, signed=True, champion=None, **limits):
    df = spark.createDataFrame([(score, signed, champion)], CANDIDATE)
    return registry.evaluate_gate(df, **limits).first()


@pytest.mark.parametrize(
    "score, signed, champion, failed",
    [
        (0.83, True, None, []),
        (0.71, True, None, ["above_floor"]),
        (0.90, False, None, ["signature_present"]),
        (0.80, True, 0.85, ["no_regression"]),
        (0.845, True, 0.85, []),
        (0.88, True, 0.85, []),
        (0.75, True, None, []),
        (0.75 - 1e-9, True, None, ["above_floor"]),
        (0.84, True, 0.85, []),
        (0.10, False, 0.85, ["signature_present", "above_floor", "no_regression"]),
        (NAN, True, None, ["above_floor"]),
        (NAN, True, 0.8, ["above_floor", "no_regression"]),
        (None, True, 0.8, ["above_floor", "no_regression"]),
        (0.9, True, NAN, ["no_regression"]),
        (0.9, None, None, ["signature_present"]),
    ],
)
def test_gate(spark, score, signed, champion, failed):
    row = judge(spark, score, signed, champion)
    assert row.failed_checks == failed and row.passed == (not failed)
    assert row.checks == {
        name: name not in failed for name in ("signature_present", "above_floor", "no_regression")
    }


def test_comparison_text(spark):
    assert judge(spark, 0.88, champion=0.85).comparison == "champion 0.8500, delta +0.0300"
    assert judge(spark, 0.88).comparison == "no existing champion"
    df = spark.createDataFrame([(0.9, True, None, 3)], CANDIDATE + ", champion_version bigint")
    assert registry.evaluate_gate(df).first().comparison == "champion without a score"


def test_tags_are_text_and_name_every_check(spark):
    df = spark.createDataFrame(
        [("m", 7, "r1", 0.88, True, 0.95)], "model_name string, version bigint, run_id string, " + CANDIDATE
    )
    rows = registry.gate_tags(registry.evaluate_gate(df))
    assert dict(rows.dtypes)["value"] == "string"
    tags = {r.key: r.value for r in rows.collect()}
    assert tags == {
        "gate_passed": "false",
        "gate_metric": "holdout_macro_f1",
        "gate_candidate_score": "0.8800",
        "gate_floor": "0.75",
        "gate_regression_tolerance": "0.01",
        "gate_comparison": "champion 0.9500, delta -0.0700",
        "source_run_id": "r1",
        "gate_check_signature_present": "true",
        "gate_check_above_floor": "true",
        "gate_check_no_regression": "false",
    }


@pytest.fixture
def tables(spark):
    runs = spark.createDataFrame(
        [
            ("r1", "FINISHED", 1, {"holdout_macro_f1": 0.8}),
            ("r2", "FINISHED", 2, {"holdout_macro_f1": 0.9}),
            ("r3", "FAILED", 3, {"holdout_macro_f1": 0.99}),
            ("r4", "FINISHED", 0, {}),
        ],
        "run_id string, status string, start_time int, metrics map<string,double>",
    )
    versions = spark.createDataFrame(
        [("a", 1, "r1"), ("a", 2, "r2"), ("b", 5, "r4")],
        "model_name string, version bigint, run_id string",
    )
    events = spark.createDataFrame(
        [
            ("a", "champion", 1, 1),
            ("a", "champion", 2, 2),
            ("a", "challenger", 9, 3),
            ("b", "champion", 5, 1),
        ],
        "model_name string, alias string, version bigint, seq bigint",
    ).withColumn("moved_at", F.current_timestamp())
    models = spark.createDataFrame([("a",), ("b",), ("c",)], "model_name string")
    return models, events, versions, runs


def test_latest_finished_run(spark, tables):
    assert registry.latest_run(tables[3]).first().run_id == "r2"
    assert registry.latest_run(tables[3].filter("status = 'FAILED'")).count() == 0


def test_champion_lookup(tables):
    got = {r.model_name: tuple(r)[1:] for r in registry.champion_lookup(*tables).collect()}
    assert got == {"a": (2, "r2", 0.9), "b": (5, "r4", None), "c": (None, None, None)}


def test_rollback_moves_the_alias_back(tables):
    models, events, versions, runs = tables
    after = events.unionByName(registry.rollback(events, "a", 1))
    got = {r.model_name: r.version for r in registry.champion_lookup(models, after, versions, runs).collect()}
    assert got == {"a": 1, "b": 5, "c": None}


def test_next_version(tables):
    got = {r.model_name: r.version for r in registry.next_version(tables[0], tables[2]).collect()}
    assert got == {"a": 3, "b": 6, "c": 1}


def test_alias_moves(spark, tables):
    judged = spark.createDataFrame(
        [("a", 3, False), ("b", 6, True), ("c", 1, True)],
        "model_name string, version bigint, passed boolean",
    )
    moves = registry.alias_moves(judged, tables[1])
    assert {tuple(r)[:4] for r in moves.collect()} == {
        ("a", "challenger", 3, 4),
        ("b", "champion", 6, 2),
        ("c", "champion", 1, 1),
    }
