"""Tumbling-window rollups and alarms; the same functions serve batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometry.operators.changes import time_slices, with_previous
from aerometry.schemas import READING_VALUES, TIME

# The reading fields the mean per city and its change need; the rollup needs READING_VALUES.
CITY_FIELDS = ("temperature", "city")
CHANGE_FIELDS = ("time", *CITY_FIELDS)

WINDOW_LENGTH = "30 seconds"
LOW_TEMPERATURE = 20.0
TEMPERATURE_CHANGE = 10.0


def window_rollup(
    readings: DataFrame,
    time: str = TIME,
    length: str = WINDOW_LENGTH,
    values: Sequence[str] = READING_VALUES,
) -> DataFrame:
    """Mean, largest and smallest of every measurement per window."""
    aggregates = [
        how(f"data.{value}").alias(f"{label}_{value}")
        for label, how in (("avg", F.avg), ("max", F.max), ("min", F.min))
        for value in values
    ]
    return readings.groupBy(F.window(time, length)).agg(*aggregates)


def city_temperature(
    readings: DataFrame, time: str = TIME, length: str = WINDOW_LENGTH
) -> DataFrame:
    """Mean temperature per window and city."""
    return readings.groupBy(F.window(time, length), "data.city").agg(
        F.avg("data.temperature").alias("avg_temperature")
    )


def low_temperature(averages: DataFrame, threshold: float = LOW_TEMPERATURE) -> DataFrame:
    """Windows and cities whose mean is below the threshold; a NULL mean never is."""
    return averages.where(F.col("avg_temperature") < threshold)


def temperature_changes(
    averages: DataFrame,
    threshold: float = TEMPERATURE_CHANGE,
    before: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Windows whose mean differs from the city's previous window by the threshold or more.

    A city has one row per window here. Its windows are put in order year by
    year, so one task orders a million rows at most (30-second windows), however
    long the history and however many the readings. With ``hot_rows`` only cities
    with more windows are cut; that counts them first and suits averages at hand.
    """
    compared = with_previous(
        averages,
        "avg_temperature",
        ("window.start",),
        time_slices("window.start"),
        "city",
        before,
        hot_rows,
        cut_all=F.date_trunc("year", "window.start") if hot_rows is None else None,
    )
    change = F.abs(F.col("avg_temperature") - F.col("_previous"))
    return (
        compared.withColumn("temperature_change", change)
        .where(F.col("temperature_change") >= threshold)
        .drop("_previous")
    )


def alarm_cities(alarms: DataFrame) -> DataFrame:
    """Cities that have an alarm."""
    return alarms.select("city").distinct()


def alarm_notice(alarms: DataFrame, threshold: float = LOW_TEMPERATURE) -> DataFrame:
    """One message per city with a low-temperature alarm; none if there is no alarm."""
    return alarm_cities(alarms).select(
        F.format_string(
            f"Low temperature: the mean in %s is below {threshold:g}",
            F.coalesce("city", F.lit("unknown city")),
        ).alias("message")
    )


def change_notice(changes: DataFrame) -> DataFrame:
    """One message per change alarm."""
    return changes.select(
        F.format_string(
            "Temperature change: the mean in %s moved by %s since the window before",
            F.coalesce("city", F.lit("unknown city")),
            F.col("temperature_change").cast("string"),
        ).alias("message")
    )
