"""The batch pipeline: eight sensor tables in, thirteen result tables out."""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.operators import stats
from aerometry.operators.combine import hourly_measurements, key_counts
from aerometry.schemas import DEVICE, SENSORS
from aerometry.session import pin_utc
from aerometry.sinks.copies import CALENDAR, read_by_month, write_by_month
from aerometry.sinks.tables import preview, write_table
from aerometry.sources.sensors import read_sensors, sensor_path

DEFAULT_YEAR = 2021

# Table, its value column and the name its monthly statistics carry.
MONTHLY = {
    "monthly_pressure": ("atmospheric_pressure", "atmosphericPressure", "atmospheric_pressure"),
    "monthly_humidity": ("humidity", "humidity", "humidity"),
    "monthly_pm1": ("pm_1", "pm1", "pm1"),
    "monthly_pm10": ("pm_10", "pm10", "pm10"),
    "monthly_pm25": ("pm_2_5", "pm25", "pm25"),
}


RESULTS = (
    "total_measurements",
    "hourly_measurements",
    "max_temperature",
    "min_atmospheric_pressure",
    "avg_pressure_by_device",
    "stddev_humidity",
    "monthly_temperature",
    "monthly_air_quality",
    *MONTHLY,
)

# Results worth a look, and the column that must be positive to be shown.
PREVIEWED = {
    "total_measurements": None,
    "hourly_measurements": None,
    "max_temperature": None,
    "min_atmospheric_pressure": "min_atmospheric_pressure",
    "stddev_humidity": "stddev_humidity",
}


def copy_sensors(tables: Mapping[str, DataFrame], root: str) -> None:
    """Keep the tables as parquet, so that later reads skip columns and row groups.

    Temperature, of which one year is read, is kept by month.
    """
    for name, df in tables.items():
        path = sensor_path(SENSORS[name], root, "parquet")
        if name == "temperature":
            write_by_month(df, path)
        else:
            write_table(df, path, "parquet")


def result_tables(
    tables: Mapping[str, DataFrame],
    hourly: DataFrame,
    pressure: DataFrame,
    year: int = DEFAULT_YEAR,
) -> dict[str, DataFrame]:
    """Every result by name; ``hourly`` and ``pressure`` feed two results each."""
    temperature = tables["temperature"]
    results = {
        "total_measurements": hourly.groupBy(DEVICE).agg(
            F.sum("num_measurements").alias("total_measurements")
        ),
        "hourly_measurements": hourly,
        "max_temperature": stats.device_max(temperature, "temperature", "max_temperature"),
        "min_atmospheric_pressure": pressure.select(DEVICE, "min_atmospheric_pressure"),
        "avg_pressure_by_device": pressure.select(DEVICE, "avg_atmospheric_pressure"),
        "stddev_humidity": stats.device_stddev(
            tables["humidity"], "humidity", "stddev_humidity"
        ),
        "monthly_temperature": stats.monthly_temperature(temperature, year),
        "monthly_air_quality": stats.monthly_air_quality(tables["air_quality"]),
    }
    for result, (name, value, label) in MONTHLY.items():
        results[result] = stats.monthly_stats(tables[name], value, label)
    return results


def result_preview(name: str, result: DataFrame) -> DataFrame:
    """The first rows of a result, without non-positive values where those are noise."""
    positive = PREVIEWED[name]
    return preview(result if positive is None else stats.positive_only(result, positive))


def run_batch(
    spark: SparkSession,
    raw_root: str,
    transform_root: str,
    raw_format: str = "csv",
    file_format: str = "csv",
    mode: str = "errorifexists",
    year: int = DEFAULT_YEAR,
    columnar_root: str | None = None,
    show: bool = False,
) -> None:
    """Read, compute, write. ``columnar_root`` first copies CSV input to parquet.

    ``show`` prints the first rows of some written tables. Two of them show
    positive values only; what is written holds all.
    """
    pin_utc(spark)
    out = transform_root.rstrip("/")
    tables = read_sensors(spark, raw_root, raw_format)
    if columnar_root is not None:
        copy_sensors(tables, columnar_root)
        tables = read_sensors(spark, columnar_root, "parquet")
        temperature = SENSORS["temperature"]
        by_month = read_by_month(spark, sensor_path(temperature, columnar_root, "parquet"))
        tables["temperature"] = by_month.select(*temperature.schema.names, *CALENDAR)
    hourly = hourly_measurements(key_counts(tables)).persist()
    pressure = stats.device_min_avg(
        tables["atmospheric_pressure"],
        "atmosphericPressure",
        "min_atmospheric_pressure",
        "avg_atmospheric_pressure",
    ).persist()
    try:
        for name, df in result_tables(tables, hourly, pressure, year).items():
            path = f"{out}/{name}.{file_format}"
            write_table(df, path, file_format, mode)
            if show and name in PREVIEWED:
                written = spark.read.schema(df.schema).format(file_format).load(path)
                result_preview(name, written).show()
    finally:
        hourly.unpersist()
        pressure.unpersist()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_root")
    parser.add_argument("transform_root")
    parser.add_argument("--raw-format", default="csv")
    parser.add_argument("--file-format", default="csv")
    parser.add_argument("--mode", default="errorifexists")
    parser.add_argument("--year", type=int, default=DEFAULT_YEAR)
    parser.add_argument("--columnar-root")
    parser.add_argument("--show", action="store_true")
    args = parser.parse_args()
    run_batch(SparkSession.builder.getOrCreate(), **vars(args))


if __name__ == "__main__":
    main()
