"""Adapters: the test tables seen as sensor tables, readings and payloads.

``ts``, ``o_orderdate`` and ``l_shipdate`` are zone-less; batch adapters keep
them so, which leaves filters on them to the scan. Streams need instants for
their watermark and cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.functions.cities import assign_city
from aerometry.functions.readings import encode_readings
from aerometry.schemas import DEVICE, READING_VALUES, SENSORS, TIME

EVENT_COLUMNS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_number() -> Column:
    """Which of the eight sensors an event belongs to."""
    return F.pmod(F.col("event_id"), F.lit(len(SENSORS)))


def event_keys(events: DataFrame, instants: str = "6 hours") -> DataFrame:
    """Events with device and instant; instants hours apart make keys meet and repeat."""
    return events.withColumns(
        {DEVICE: F.col("user_id").cast("string"), TIME: F.window("ts", instants)["start"]}
    )


def special_number() -> Column:
    """An event's value, but zeros of both signs and NaN in three quarters of the rows."""
    kind = F.pmod(F.floor(F.col("event_id") / len(SENSORS)), F.lit(4))
    special = F.when(kind == 0, F.lit(-0.0)).when(kind == 1, 0.0).when(kind == 2, float("nan"))
    return special.otherwise(F.col("value"))


def event_sensors(
    spark: SparkSession, sf_dir: str, instants: str = "6 hours", special: bool = False
) -> dict[str, DataFrame]:
    """The eight sensor tables, by ``event_id`` modulo eight."""
    events = event_keys(table(spark, sf_dir, "events"), instants)
    number = (special_number() if special else F.col("value")).cast("float")
    text = F.col("value").cast("decimal(12,2)").cast("string")
    columns = {
        "airQuality": F.when(F.col("user_id") % 10 == 0, F.lit("BAD")).otherwise(text),
        "name": F.col("event_type"),
        "lat": number,
        "lon": (-F.col("value")).cast("float"),
    }
    return {
        spec.name: events.where(sensor_number() == i).select(
            *[
                F.col(c) if c in (DEVICE, TIME) else columns.get(c, number).alias(c)
                for c, _ in spec.columns
            ]
        )
        for i, spec in enumerate(SENSORS.values())
    }


def lineitem_sensors(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Sensor tables that cover several years, one reading per line item."""
    items = table(spark, sf_dir, "lineitem")
    values = {
        "atmospheric_pressure": ("atmosphericPressure", F.col("l_quantity")),
        "humidity": ("humidity", F.col("l_extendedprice")),
        "pm_1": ("pm1", F.col("l_discount")),
        "pm_10": ("pm10", F.col("l_tax")),
        "pm_2_5": ("pm25", F.col("l_quantity") * F.col("l_discount")),
    }
    tables = {
        name: items.select(
            F.col("l_suppkey").cast("string").alias(DEVICE),
            F.col("l_shipdate").alias(TIME),
            number.cast("float").alias(column),
        )
        for name, (column, number) in values.items()
    }
    tables["air_quality"] = items.select(
        F.col("l_suppkey").cast("string").alias(DEVICE),
        F.col("l_shipdate").alias(TIME),
        F.when(F.col("l_returnflag") == "R", F.lit("BAD"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("airQuality"),
    )
    return tables


def order_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperatures from orders; some lie beyond either bound of the range filter."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(DEVICE),
        F.col("o_orderdate").alias(TIME),
        (F.col("o_totalprice") / 1000 - 200).cast("float").alias("temperature"),
    )


def reading_values() -> dict[str, Column]:
    """Six measurements from an event's value."""
    value = F.col("value")
    scaled = {
        "pm1": value / 4,
        "pm2": value / 2,
        "pm10": value * 2,
        "pressure": value + 1000,
        "humidity": 100 - value,
        "temperature": value,
    }
    return {name: scaled[name] for name in READING_VALUES}


def event_messages(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events as envelopes of JSON readings; every fiftieth user sends garbage."""
    readings = events.select(
        F.col("user_id").cast("string").alias(DEVICE),
        assign_city(F.col("user_id")).alias("city"),
        F.col("ts").cast("timestamp").alias(TIME),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        *[number.alias(name) for name, number in reading_values().items()],
        (F.col("user_id") % 50 == 0).alias("garbage"),
        *keep,
    )
    return encode_readings(readings, keep=(TIME, "garbage", *keep)).select(
        F.when(F.col("garbage"), F.lit("garbage").cast("binary"))
        .otherwise(F.col("value"))
        .alias("value"),
        TIME,
        *keep,
    )


def event_payloads(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events as raw payloads, in arrival order of ``seq``.

    Users of the last decades send what must be rejected: a header only, a word
    for a number, too few values. Others send one value too many, a header twice
    and a device and city of their own, which must not matter.
    """
    numbers = reading_values()
    header = F.lit("|".join(["time", "temperature", *numbers, "station", DEVICE, "city"]))
    clock = F.unix_seconds(F.date_trunc("day", F.col("ts").cast("timestamp"))).cast("string")
    word = F.when(F.col("user_id") % 30 == 7, F.lit("abc"))
    values = [
        F.coalesce(word, number.cast("string")) if name == "pm10" else number.cast("string")
        for name, number in numbers.items()
    ]
    full = F.concat_ws("|", clock, F.lit("-1"), *values, F.lit("s"), *map(F.lit, ("d0", "Nowhere", "surplus")))
    kind = F.col("user_id") % 30
    line = (
        F.when(kind == 8, F.concat_ws("|", clock, F.lit("-1"), *values[:2]))
        .when(kind == 9, clock)
        .otherwise(full)
    )
    return events.select(
        F.col("user_id").cast("string").alias(DEVICE),
        F.when(kind == 6, header).otherwise(F.concat_ws("\n", header, line)).alias("body"),
        F.col("ts").cast("timestamp").alias("arrived"),
        F.col("event_id").alias("seq"),
        *keep,
    )
