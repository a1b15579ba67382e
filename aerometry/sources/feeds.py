"""The device directory and the raw payload feed, as landed in storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.functions.payload import FIELD_SEPARATOR, first_field
from aerometry.schemas import DEVICE, PAYLOAD


def read_device_directory(spark: SparkSession, path: str) -> DataFrame:
    """Device ids from text files: a header line, then ``id|...`` lines.

    The CSV reader skips the first line of every file even when a large file is
    split over tasks; a separator that cannot occur keeps each line whole.
    Lines without the field separator are left out.
    """
    lines = (
        spark.read.schema("line string")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .csv(path)
    )
    return lines.where(F.col("line").contains(FIELD_SEPARATOR)).select(
        first_field(F.col("line")).alias(DEVICE)
    )


def read_payload_files(spark: SparkSession, path: str, stream: bool = False, **options: str):
    """One payload per file below ``deviceId=<id>/`` folders.

    Arrival order is the file's modification time, then its name.
    """
    reader = spark.readStream if stream else spark.read
    files = (
        reader.schema(f"value string, {DEVICE} string")
        .options(**options)
        .text(path, wholetext=True)
    )
    return files.select(
        DEVICE,
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_name").alias("seq"),
    )


def read_payload_table(spark: SparkSession, path: str, stream: bool = False, **options: str):
    """Payloads landed as parquet rows; one file holds many, unlike one file each."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(PAYLOAD).options(**options).parquet(path)


def fan_in(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, duplicates kept; columns a feed lacks are NULL."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first
