"""The change filter and the feed-to-message pipeline as streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerometry.functions.cities import assign_city
from aerometry.functions.payload import parse_payloads, rejected
from aerometry.functions.readings import encode_readings
from aerometry.schemas import DEVICE, READING_VALUES, TIME
from aerometry.sinks.messages import FilePublisher, KafkaPublisher
from aerometry.streaming.previous import (
    SLICE,
    state_partitions,
    stream_with_previous,
    time_slice,
)
from aerometry.streaming.sinks import UNTIL_READ, start_sink


def changed(previous: Column, value: Column) -> Column:
    """Whether a reading differs from the one before it, if any."""
    return previous.isNull() | (previous != value)


def stream_changed_readings(
    readings: DataFrame,
    value: str,
    order: Sequence[str] = (TIME,),
    key: str = DEVICE,
    unit: str = SLICE,
    passing: Column | None = None,
) -> DataFrame:
    """As ``operators.changes.changed_readings``, for a stream.

    The last value per device is Spark's keyed state. Devices are cut into slices of
    ``unit`` along the first column of ``order`` if that is a time; a slice's rows of
    one trigger are ordered by one task.
    """
    kind = readings.schema[order[0]].dataType.typeName()
    slices = time_slice(order[0], unit) if kind.startswith("timestamp") else F.lit("")
    valued = F.col(value).isNotNull()
    rows = readings.where(valued if passing is None else valued | passing)
    compared = stream_with_previous(rows, value, order, slices, key, True, passing)
    kept = F.coalesce(changed(F.col("_previous"), F.col(value)), F.lit(False))
    if passing is not None:
        kept = F.coalesce(passing, F.lit(False)) | kept
    return compared.where(kept).drop("_previous")


def start_changed_readings(
    readings: DataFrame,
    value: str,
    order: Sequence[str],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    key: str = DEVICE,
    unit: str = SLICE,
) -> StreamingQuery:
    """Hand ``sink`` the readings that differ from the device's previous one."""
    found = stream_changed_readings(readings, value, order, key, unit)
    with state_partitions(readings.sparkSession):
        return start_sink(found, sink, checkpoint, trigger)


def start_ingest(
    payloads: DataFrame,
    publisher: FilePublisher | KafkaPublisher,
    rejects_path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    order: Sequence[str] = ("arrived", "seq"),
    city_number: Column | None = None,
    unit: str = SLICE,
) -> StreamingQuery:
    """From raw payloads to published readings, in one streaming plan.

    Parse, set unusable payloads aside with their reason, drop readings whose
    key repeats the device's previous one, give each a city, publish as JSON.
    A rejected payload passes the comparison untouched and is not remembered, so a
    repaired one with the same key still goes out. The city follows ``city_number``,
    by default a hash of device and time.
    """
    if city_number is None:
        city_number = F.xxhash64(DEVICE, "time")
    unfit = F.col("reject_reason").isNotNull()
    parsed = parse_payloads(payloads).withColumn("body", F.when(unfit, F.col("body")))
    rows = parsed.select(
        DEVICE, "reading_key", "time", *READING_VALUES, *order, "body", "reject_reason"
    )
    found = stream_changed_readings(rows, "reading_key", order, unit=unit, passing=unfit)

    def publish(batch: DataFrame, epoch: int) -> None:
        rejected(batch).write.mode("overwrite").parquet(f"{rejects_path}/epoch={epoch}")
        placed = batch.where(~unfit).withColumn("city", assign_city(city_number))
        publisher.publish(encode_readings(placed), epoch)

    with state_partitions(payloads.sparkSession):
        return start_sink(found, publish, checkpoint, trigger)
