"""Sensor tables with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from aerometry.schemas import SENSORS, SensorSpec


def sensor_path(spec: SensorSpec, root: str, file_format: str = "csv") -> str:
    """Where a table lies below the raw prefix, for example ``s3a://raw/x/humidity.csv``."""
    return f"{root.rstrip('/')}/{spec.name}.{file_format}"


def read_sensor(
    spark: SparkSession,
    spec: SensorSpec | str,
    root: str,
    file_format: str = "csv",
    **options: str,
) -> DataFrame:
    """Read one sensor table.

    CSV files have no header and are read permissively: a value that does not
    parse is NULL in its column only. The same tables may be kept as parquet,
    which prunes columns and skips row groups. Endpoint and credentials of an
    object store come from the caller's Hadoop configuration.
    """
    spec = SENSORS[spec] if isinstance(spec, str) else spec
    reader = spark.read.schema(spec.schema).options(**options)
    if file_format == "csv":
        reader = reader.option("header", False)
    found = reader.format(file_format).load(sensor_path(spec, root, file_format))
    # A copy by month has its partition columns too.
    return found.select(*spec.schema.names)


def read_sensors(
    spark: SparkSession,
    root: str,
    file_format: str = "csv",
    names: Iterable[str] = tuple(SENSORS),
    **options: str,
) -> dict[str, DataFrame]:
    """All sensor tables by name, in combining order."""
    return {name: read_sensor(spark, name, root, file_format, **options) for name in names}
