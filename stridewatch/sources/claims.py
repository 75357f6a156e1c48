"""Numbers that only one writer gets: an exclusive file in a shared folder for each.

Two writers that read the same table see the same last number. Each then tries to create the file of the next one, and the
file system lets one of them: the other goes on to the number after it. Exclusive creation is up to the file system
(HDFS and stores with conditional writes have it; a local folder has it within one process).
"""

from __future__ import annotations

from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def claim(spark: SparkSession, folder: str, number: int, owner: str) -> bool:
    """Take a number; False if it is taken. The file holds its owner."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{number:012d}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(bytearray(owner.encode()))
    finally:
        stream.close()
    return True


def claim_next(spark: SparkSession, folder: str, after: int, owner: str) -> int:
    """The first number beyond ``after`` that nobody has taken, now taken by ``owner``."""
    number = after + 1
    while not claim(spark, folder, number, owner):
        number += 1
    return number


def claim_folder(root: str, *names: str) -> str:
    """A folder of claims, names made safe for a path."""
    return "/".join([root.rstrip("/"), *[quote(name, safe="") for name in names]])
