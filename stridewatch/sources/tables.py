"""Parquet tables: scans, replaced tables and append-only histories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A path if it looks like one, else a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def overwrite_table(
    df: DataFrame, name: str, partition_by: list[str] | tuple[str, ...] = ()
) -> None:
    """Replace a table, its schema included."""
    writer = df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    writer.save(name) if "/" in name else writer.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """A catalog table dealt by its keys into sorted buckets. Tables with equal keys and numbers of buckets are joined and
    grouped by those keys without a shuffle, every time they are read: the shuffle is paid once, at the write."""
    dealt = df.repartition(buckets, *keys)  # one task a bucket, else every task writes a file for each
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_history(
    df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = ()
) -> None:
    """Append a batch. Later batches may bring new columns."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_history(spark: SparkSession, path: str, **partition) -> DataFrame:
    """All batches under the union of their columns; a column a batch lacked is null.

    With ``column=value`` of the partition columns, in their order, only the files of that partition
    are listed and only their schemas merged.
    """
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in partition.items()]])
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(folder)


def create_namespace(spark: SparkSession, name: str, comment: str = "") -> None:
    note = comment.replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{note}'")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach: under the cluster's checkpoint folder.

    Where the session names none, as in local tests, it is under the warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
