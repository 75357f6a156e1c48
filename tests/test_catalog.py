import glob
import os

import duckdb
import pytest
from tools.check_oracle import canonical

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = db.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
