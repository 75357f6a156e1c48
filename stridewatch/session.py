"""Session settings, and sessions for tests and local runs. On a cluster, bring your own."""

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

WIDE_ROW_FIELDS = 1000


@contextmanager
def wide_code_generation(spark: SparkSession) -> Iterator[None]:
    """Keep an aggregation of wide rows in generated code while an action runs.

    Spark leaves whole-stage code generation for rows of more than 100 fields. A window has 205
    columns and about 400 aggregation buffers, and its aggregation runs several times faster in
    generated code. Elsewhere the limit is right: code that also unpacks hundreds of columns grows
    too long for the JVM to compile.
    """
    key = "spark.sql.codegen.maxFields"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), WIDE_ROW_FIELDS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(app_name: str, cpus: int | None = None, **conf: str) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def observing_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings for writes that are observed.

    A session that has observed a write cannot be serialised any more, and models that MLlib has just fitted carry theirs to
    the executors: so the session that trains must not be the one that observes.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own
