"""Statistics per device and per month. All combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerometry.schemas import DEVICE, TIME


def device_max(df: DataFrame, value: str, name: str) -> DataFrame:
    """Largest value per device."""
    return df.groupBy(DEVICE).agg(F.max(value).cast("float").alias(name))


def device_min(df: DataFrame, value: str, name: str) -> DataFrame:
    """Smallest value per device."""
    return df.groupBy(DEVICE).agg(F.min(value).cast("float").alias(name))


def device_avg(df: DataFrame, value: str, name: str) -> DataFrame:
    """Mean per device."""
    return df.groupBy(DEVICE).agg(F.avg(value).alias(name))


def device_stddev(df: DataFrame, value: str, name: str) -> DataFrame:
    """Sample standard deviation per device; NULL for a single reading."""
    return df.groupBy(DEVICE).agg(F.stddev(value).cast("float").alias(name))


def device_min_avg(df: DataFrame, value: str, min_name: str, avg_name: str) -> DataFrame:
    """Smallest value and mean per device in one pass."""
    return df.groupBy(DEVICE).agg(
        F.min(value).cast("float").alias(min_name), F.avg(value).alias(avg_name)
    )


def positive_only(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is above zero; NULL is not, NaN is."""
    return df.where(F.col(value) > 0)


def in_year(df: DataFrame, year: int, time: str = TIME) -> DataFrame:
    """Rows of one calendar year, as a range that scans can skip files by.

    A copy by month (``sinks.copies.write_by_month``) has a partition column ``year``, by
    which other years' files are not even listed for reading.
    """
    if "year" in df.columns and "month" in df.columns:
        df = df.where(F.col("year") == year)
    kind = "TIMESTAMP_NTZ" if df.schema[time].dataType == T.TimestampNTZType() else "TIMESTAMP_LTZ"
    first, after = (F.expr(f"{kind} '{y:04d}-01-01 00:00:00'") for y in (year, year + 1))
    return df.where((F.col(time) >= first) & (F.col(time) < after))


def between_exclusive(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows strictly between two bounds; NaN sorts above every number and is left out."""
    return df.where(f"{value} > {low}").where(f"{value} < {high}")


def monthly_stats(df: DataFrame, value: str, name: str, time: str = TIME) -> DataFrame:
    """Mean, smallest and largest value per (year, month)."""
    return df.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        F.avg(value).alias(f"avg_{name}"),
        F.min(value).alias(f"min_{name}"),
        F.max(value).alias(f"max_{name}"),
    )


def monthly_air_quality(df: DataFrame, numeric_range: bool = False) -> DataFrame:
    """Monthly air quality, whose readings are text.

    The mean leaves out text that is no number. Smallest and largest compare as
    text ("10" before "9") unless ``numeric_range`` is set.

    Extremes of text cannot be kept in a hash table, so Spark would sort all
    readings to find them. Equal readings of a month are counted first, which
    hashes, and only the different texts are sorted.
    """
    number = F.col("airQuality").try_cast("double")
    if numeric_range:
        return monthly_stats(df.withColumn("airQuality", number), "airQuality", "air_quality")
    counted = df.groupBy(
        F.year(TIME).alias("year"), F.month(TIME).alias("month"), "airQuality"
    ).agg(F.count("*").alias("n"))
    numbers = F.sum(F.when(number.isNotNull(), F.col("n")))
    return counted.groupBy("year", "month").agg(
        (F.sum(number * F.col("n")) / numbers).alias("avg_air_quality"),
        F.min("airQuality").alias("min_air_quality"),
        F.max("airQuality").alias("max_air_quality"),
    )


def monthly_temperature(
    df: DataFrame, year: int, low: float = -100, high: float = 100
) -> DataFrame:
    """Temperature per month of one year, readings outside the bounds left out, in order."""
    kept = between_exclusive(in_year(df, year), "temperature", low, high)
    return (
        kept.groupBy(F.month(TIME).alias("month"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
        )
        .orderBy("month")
    )
