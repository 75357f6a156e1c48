"""Headerless, space-delimited sensor text with a declared schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

# The column layout of the raw files.
LEAD = ("timestamp_s", "activity_id", "heart_rate")
SENSORS = ("hand", "chest", "ankle")
CHANNELS = (
    "temp_c",
    "acc16_x",
    "acc16_y",
    "acc16_z",
    "acc6_x",
    "acc6_y",
    "acc6_z",
    "gyro_x",
    "gyro_y",
    "gyro_z",
    "mag_x",
    "mag_y",
    "mag_z",
    "orient_0",
    "orient_1",
    "orient_2",
    "orient_3",
)

#: The column that carries the line of a row that was not read as it stands.
REJECTED = "_rejected_line"


def sensor_schema(sensors=SENSORS, channels=CHANNELS, lead=LEAD) -> StructType:
    """All-double schema: the leading columns, then every channel of each sensor in turn."""
    schema = StructType()
    for name in lead:
        schema.add(name, DoubleType())
    for sensor in sensors:
        for channel in channels:
            schema.add(f"{sensor}_{channel}", DoubleType())
    return schema


def read_delimited_sensor(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    delimiter: str = " ",
    nan_value: str = "NaN",
    file_col: str = "source_file",
    rejected_col: str | None = None,
) -> DataFrame:
    """Rows plus the name of the file each came from. Short rows and bad tokens read as null.

    With ``rejected_col`` a row that was not read as it stands carries its line there; see ``rejected_lines``.
    """
    wanted = schema or sensor_schema()
    options = {"sep": delimiter, "nanValue": nan_value, "mode": "PERMISSIVE"}
    if rejected_col is not None:
        wanted = StructType([*wanted.fields]).add(rejected_col, StringType())
        options |= {"columnNameOfCorruptRecord": rejected_col}
    rows = spark.read.options(**options).schema(wanted).csv(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias(file_col))
    if rejected_col is None:
        return rows
    # Spark parses only columns that are used. Both branches are the line; the condition uses every column, so that
    # what counts as broken does not depend on what a query reads.
    line = F.col(rejected_col)
    columns = [f.name for f in wanted.fields if f.name != rejected_col]
    same = F.when(F.xxhash64(*columns) != 0, line).otherwise(F.concat(line, F.lit("")))
    return rows.withColumn(rejected_col, same)


def rejected_lines(
    raw: DataFrame,
    schema: StructType | None = None,
    *,
    delimiter: str = " ",
    nan_value: str = "NaN",
    file_col: str = "source_file",
    rejected_col: str = REJECTED,
) -> DataFrame:
    """(source_file, line, reason, column, values_read): the lines that were not read as they stand, and why.

    Reasons are too few values, too many values, and values that are no number; then ``column`` names the first such
    column. An empty value is no reading and no fault.
    """
    names = (schema or sensor_schema()).names
    lines = raw.where(F.col(rejected_col).isNotNull()).select(
        F.col(file_col).alias("source_file"),
        F.col(rejected_col).alias("line"),
        F.size(F.array_compact(F.array(*[F.col(n).cast("string") for n in names]))).alias("values_read"),
    )
    parts = F.split("line", _literal_pattern(delimiter))
    is_bad = F.transform(
        parts, lambda v: (v != "") & (v != nan_value) & v.try_cast("double").isNull()
    )
    first = F.array_position(is_bad, F.lit(True))
    count = F.size(parts)
    reason = (
        F.when(count < len(names), "too few values")
        .when(count > len(names), "too many values")
        .when(first > 0, "not a number")
        .otherwise("not readable")
    )
    named = F.get(F.array(*[F.lit(n) for n in names]), (first - 1).cast("int"))
    return lines.select(
        "source_file",
        "line",
        reason.alias("reason"),
        F.when((count == len(names)) & (first > 0), named).alias("column"),
        "values_read",
    )


def _literal_pattern(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in text)
