import math

import pytest
from pyspark.sql import functions as F

from stridewatch.operators import cleaning
from stridewatch.sources import (
    REJECTED,
    append_history,
    claim,
    claim_folder,
    claim_next,
    create_namespace,
    overwrite_table,
    read_delimited_sensor,
    read_history,
    read_table,
    rejected_lines,
    sensor_schema,
    shared_folder,
)

NAN = float("nan")


def test_nan_is_not_null_in_spark(spark):
    df = spark.createDataFrame([(NAN,)], "v double")
    assert df.filter(F.col("v").isNull()).count() == 0


def test_nan_becomes_null_and_nothing_else_changes(spark):
    rows = [(1, NAN, NAN), (2, 72.0, 1.0), (3, 0.0, 2.0), (4, -1.5, None), (5, None, 3.0)]
    df = spark.createDataFrame(rows, "id bigint, heart_rate double, temp_c double")
    out = cleaning.normalize_nan_to_null(df, ["heart_rate"])
    assert out.columns == df.columns
    got = {r.id: r for r in out.collect()}
    assert [got[i].heart_rate for i in range(1, 6)] == [None, 72.0, 0.0, -1.5, None]
    assert math.isnan(got[1].temp_c) and got[4].temp_c is None


def test_nan_to_null_keeps_float_type(spark):
    df = spark.createDataFrame([(NAN,)], "v float")
    out = cleaning.normalize_nan_to_null(df, ["v"])
    assert out.dtypes == [("v", "float")] and out.first().v is None


def test_subject_from_file_name(spark):
    names = [("subject101.dat",), ("notes.dat",), ("subject.dat",), (None,)]
    df = spark.createDataFrame(names, "source_file string")
    got = [r.subject_id for r in cleaning.extract_subject(df).collect()]
    assert got == [101, None, None, None]


def test_transient_and_null_activity_are_dropped(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "activity_id double")
    assert [r.activity_id for r in cleaning.drop_transient(df).collect()] == [1.0]


def test_schema_has_54_doubles():
    schema = sensor_schema()
    assert len(schema) == 54
    assert schema.names[:4] == ["timestamp_s", "activity_id", "heart_rate", "hand_temp_c"]
    assert schema.names[-1] == "ankle_orient_3"
    assert {f.dataType.typeName() for f in schema} == {"double"}


@pytest.fixture
def raw_folder(tmp_path):
    def line(time, activity, rate, rest=51):
        return " ".join([str(time), str(activity), rate, *["1.5"] * rest])

    (tmp_path / "subject101.dat").write_text(
        "\n".join([line(0.0, 0, "NaN"), line(0.01, 1, "NaN"), line(0.02, 1, "90")]) + "\n"
    )
    (tmp_path / "subject102.dat").write_text(
        "\n".join([line(0.0, 2, "80", rest=50), line(0.01, 2, "oops")]) + "\n"
    )
    (tmp_path / "readme.dat").write_text(line(0.0, 3, "70") + "\n")
    return str(tmp_path)


def test_raw_text_to_readings(spark, raw_folder):
    raw = read_delimited_sensor(spark, raw_folder)
    readings = cleaning.clean_readings(raw, sensor_cols=sensor_schema().names)
    assert len(readings.columns) == 45
    assert dict(readings.dtypes)["activity_id"] == "int"
    rows = {(r.subject_id, r.timestamp_s): r for r in readings.collect()}
    assert set(rows) == {(101, 0.01), (101, 0.02), (102, 0.0), (102, 0.01)}
    assert rows[101, 0.01].heart_rate is None and rows[101, 0.02].heart_rate == 90.0
    assert rows[102, 0.0].ankle_mag_z == 1.5
    assert rows[102, 0.01].heart_rate is None


def test_history_keeps_batches_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(spark.createDataFrame([(1, "a")], "v int, k string"), path, ["k"])
    append_history(spark.createDataFrame([(2, 0.5, "b")], "v int, extra double, k string"), path, ["k"])
    got = {(r.v, r.extra, r.k) for r in read_history(spark, path).collect()}
    assert got == {(1, None, "a"), (2, 0.5, "b")}


def test_overwrite_replaces_schema(spark, tmp_path):
    path = str(tmp_path / "gold")
    overwrite_table(spark.createDataFrame([(1,)], "a int"), path)
    overwrite_table(spark.createDataFrame([("x",)], "b string"), path)
    assert read_table(spark, path).dtypes == [("b", "string")]


def test_namespace(spark):
    create_namespace(spark, "wearables", "it's a test")
    assert spark.catalog.databaseExists("wearables")


def test_shared_folder_follows_the_cluster():
    # The setting is fixed when a session starts, so a stand-in holds it here.
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs:///shared/"}

    assert shared_folder(Session(), "x").startswith("hdfs:///shared/x-")


SMALL = sensor_schema(sensors=("s",), channels=("x", "orient_0"), lead=("t", "activity_id"))


@pytest.fixture()
def broken_lines(tmp_path):
    lines = ["0.1 1 2 3", "0.2 1 2", "0.3 1 2 3 4", "0.4 one 2 3", "0.5 1 NaN 3", "0.6 1  3", "0.7 1 2 bad", "0.8 1 2 3"]
    (tmp_path / "subject101.dat").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_rejected_lines_and_why(spark, broken_lines):
    raw = read_delimited_sensor(spark, broken_lines, SMALL, rejected_col=REJECTED)
    got = {r.line: (r.source_file, r.reason, r.column) for r in rejected_lines(raw, SMALL).collect()}
    assert got == {
        "0.2 1 2": ("subject101.dat", "too few values", None),
        "0.3 1 2 3 4": ("subject101.dat", "too many values", None),
        "0.4 one 2 3": ("subject101.dat", "not a number", "activity_id"),
        "0.7 1 2 bad": ("subject101.dat", "not a number", "s_orient_0"),
    }


def test_rejected_rows_keep_what_can_be_read(spark, broken_lines):
    plain = read_delimited_sensor(spark, broken_lines, SMALL)
    marked = read_delimited_sensor(spark, broken_lines, SMALL, rejected_col=REJECTED)
    key = lambda r: r.t
    assert str(sorted(marked.drop(REJECTED).collect(), key=key)) == str(sorted(plain.collect(), key=key))
    # a column that is not used is parsed all the same
    assert len(marked.select("t", REJECTED).where(F.col(REJECTED).isNotNull()).collect()) == 4


def test_a_number_is_claimed_once(spark, tmp_path):
    folder = claim_folder(str(tmp_path), "a model/one", "versions")
    assert claim_next(spark, folder, 0, "first") == 1
    assert claim_next(spark, folder, 0, "second") == 2
    assert not claim(spark, folder, 2, "third") and claim(spark, folder, 9, "third")
    assert claim_next(spark, folder, 8, "fourth") == 10
