import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from stridewatch.operators import metrics, profile


def counts(spark, pairs):
    return metrics.confusion(spark.createDataFrame(pairs, "label int, prediction int"))


def value(df):
    return df.first()[0]


def test_class_seen_only_in_labels_or_only_in_predictions(spark):
    got = {r["class"]: r for r in metrics.per_class(counts(spark, [(1, 1), (2, 1), (1, 3)])).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[2].f1, got[2].recall, got[2].precision, got[2].support) == (0.0, 0.0, 0.0, 1)
    assert (got[3].f1, got[3].recall, got[3].precision, got[3].support) == (0.0, 0.0, 0.0, 0)
    assert value(metrics.macro_f1(counts(spark, [(1, 1), (2, 1), (1, 3)]))) == pytest.approx(0.5 / 3)


def test_perfect_and_single_class(spark):
    assert value(metrics.macro_f1(counts(spark, [(1, 1), (2, 2), (3, 3)]))) == 1.0
    assert value(metrics.macro_f1(counts(spark, [(4, 4)]))) == 1.0


def test_weighted_f1_equals_the_evaluator(spark):
    pairs = [(i % 3, (i * i) % 4) for i in range(50)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    expected = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert value(metrics.weighted_f1(counts(spark, pairs))) == pytest.approx(expected)


def test_evaluation_agrees_with_its_parts(spark):
    c = counts(spark, [(1, 1), (2, 1), (1, 3), (2, 2)])
    row = metrics.evaluation(c).first()
    assert row.accuracy == value(metrics.accuracy(c)) == 0.5
    assert row.macro_f1 == value(metrics.macro_f1(c))
    assert row.weighted_f1 == value(metrics.weighted_f1(c))


def test_report(spark):
    rows = {r["class"]: r for r in metrics.classification_report(counts(spark, [(1, 1), (1, 1), (1, 2), (2, 2)])).collect()}
    assert rows["1"].precision == 1.0 and rows["1"].recall == pytest.approx(2 / 3)
    assert rows["accuracy"].f1 == 0.75 and rows["accuracy"].support == 4
    assert rows["macro avg"].precision == 0.75
    assert rows["weighted avg"].recall == pytest.approx(0.75)


def test_ingest_profile(spark):
    rows = [(1, 1, None), (1, 1, 70.0), (1, 2, None), (2, None, 60.0)]
    df = spark.createDataFrame(rows, "subject_id int, activity_id int, heart_rate double")
    got = [tuple(r) for r in profile.ingest_profile(df).collect()]
    assert got == [(1, 3, 2, 0.667), (2, 1, 0, 0.0)]


def test_provenance_sorts_numerically(spark):
    df = spark.createDataFrame([(i,) for i in (109, 9, 101, 9, None)], "s int")
    assert profile.provenance_list(df, "s").first().members == "9,101,109"


def test_split_profile_counts_null_keys_like_count_distinct(spark):
    rows = [("train", 1, 1), ("train", 1, 2), ("train", 2, None), ("train", 1, 1)]
    df = spark.createDataFrame(rows, "split string, subject_id int, activity_id int")
    assert tuple(profile.split_profile(df).first()) == ("train", 4, 2, 2)
