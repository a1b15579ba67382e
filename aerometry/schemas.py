"""Declared schemas: the eight sensor tables, the stream reading, the feed payload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DEVICE = "deviceId"
TIME = "timestamp"
KEY = (DEVICE, TIME)


@dataclass(frozen=True)
class SensorSpec:
    """One measurement kind: its table name and its columns in file order."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind, True) for name, kind in self.columns])

    @property
    def values(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns if name not in KEY)


def _measurement(name: str, column: str, kind: T.DataType) -> SensorSpec:
    return SensorSpec(name, ((DEVICE, T.StringType()), (TIME, T.TimestampType()), (column, kind)))


# Table names, column names and column order of the sensor files,
# in the order in which the combined table lists them.
SENSORS: dict[str, SensorSpec] = {
    spec.name: spec
    for spec in (
        _measurement("air_quality", "airQuality", T.StringType()),
        _measurement("atmospheric_pressure", "atmosphericPressure", T.FloatType()),
        _measurement("humidity", "humidity", T.FloatType()),
        SensorSpec(
            "location",
            (
                (DEVICE, T.StringType()),
                ("name", T.StringType()),
                (TIME, T.TimestampType()),
                ("lat", T.FloatType()),
                ("lon", T.FloatType()),
            ),
        ),
        _measurement("pm_1", "pm1", T.FloatType()),
        _measurement("pm_10", "pm10", T.FloatType()),
        _measurement("pm_2_5", "pm25", T.FloatType()),
        _measurement("temperature", "temperature", T.FloatType()),
    )
}

# The six numeric fields of a reading, in rollup order.
READING_VALUES = ("pm1", "pm2", "pm10", "pressure", "humidity", "temperature")

# Fields of a reading as decoded from a message.
READING = T.StructType(
    [
        T.StructField(DEVICE, T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("temperature", T.FloatType()),
        T.StructField("humidity", T.FloatType()),
        T.StructField("pressure", T.FloatType()),
        T.StructField("pm1", T.FloatType()),
        T.StructField("pm2", T.FloatType()),
        T.StructField("pm10", T.FloatType()),
        T.StructField("city", T.StringType()),
    ]
)

# A reading field and the batch table column that carries the same measurement.
READING_TO_SENSOR = {
    "time": TIME,
    "temperature": "temperature",
    "humidity": "humidity",
    "pressure": "atmosphericPressure",
    "pm1": "pm1",
    "pm2": "pm25",
    "pm10": "pm10",
}

# The cities a reading may be assigned to.
CITIES = ("Novi Sad", "Beograd", "Nis", "Subotica", "Valjevo", "Kragujevac")

# Message envelope as a broker hands it over; only these two columns are used.
ENVELOPE = T.StructType(
    [T.StructField("value", T.BinaryType()), T.StructField(TIME, T.TimestampType())]
)

# Raw payload as landed: whose it is, its text, and when it arrived.
PAYLOAD = T.StructType(
    [
        T.StructField(DEVICE, T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("arrived", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
