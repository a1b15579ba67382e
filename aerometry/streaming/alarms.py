"""Rollups and alarms over a stream of decoded readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerometry.functions.readings import decode_readings
from aerometry.operators.rollup import (
    CHANGE_FIELDS,
    CITY_FIELDS,
    LOW_TEMPERATURE,
    TEMPERATURE_CHANGE,
    WINDOW_LENGTH,
    alarm_notice,
    change_notice,
    city_temperature,
    low_temperature,
    window_rollup,
)
from aerometry.schemas import READING_VALUES
from aerometry.sinks.tables import merge_days
from aerometry.streaming.previous import stream_with_previous, time_slice
from aerometry.streaming.sinks import (
    UNTIL_READ,
    start_files,
    start_merging,
    start_replacing,
    start_sink,
    write_noticed,
)

#: How far behind the latest reading a window stays open.
DELAY = "5 minutes"

# Windows of a city that one task puts in order at a time: those of a day.
_CITY_SLICE = "day"


def by_reading_time(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """Readings with ``at``, their own time, and Spark's watermark on it.

    A window on it closes once a reading ``delay`` past its end was seen. Later
    readings are dropped and counted, see ``streaming.late``. Those without a time are
    in no window, and left out as progress would tell of them as the earliest.
    """
    timed = readings.where(F.col("data.time").isNotNull())
    return timed.withColumn("at", F.col("data.time")).withWatermark("at", delay)


# One query per result


def start_rollup(
    readings: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_READ
) -> StreamingQuery:
    """Rollup by envelope time; the table always holds every window seen."""
    return start_replacing(window_rollup(readings), path, checkpoint, trigger)


def start_merged_rollup(
    readings: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_READ
) -> StreamingQuery:
    """As :func:`start_rollup`, but a trigger writes the days of the windows it changes."""

    def merge(changed: DataFrame, epoch: int) -> None:
        merge_days(changed, path, epoch, ["window"], F.col("window.start"))

    return start_merging(window_rollup(readings), merge, checkpoint, trigger)


def start_closed_rollup(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    delay: str = DELAY,
) -> StreamingQuery:
    """Rollup by reading time: each window is written once, when closed."""
    closed = window_rollup(by_reading_time(readings, delay), "at")
    return start_files(closed, path, checkpoint, trigger)


def start_low_temperature_alarm(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    threshold: float = LOW_TEMPERATURE,
    notices_path: str | None = None,
) -> StreamingQuery:
    """Current low-temperature alarms; one that later readings lift disappears."""
    return start_replacing(
        low_temperature(city_temperature(readings), threshold),
        path,
        checkpoint,
        trigger,
        None if notices_path is None else lambda alarms: alarm_notice(alarms, threshold),
        notices_path,
    )


def start_merged_low_temperature_alarm(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    threshold: float = LOW_TEMPERATURE,
) -> StreamingQuery:
    """Low-temperature alarms by day; one that later readings lift is marked ``cleared``.

    A trigger writes the days whose alarms it raises, changes or lifts.
    """
    key = ["window", "city"]

    def merge(changed: DataFrame, epoch: int) -> None:
        # Rows that are no alarm matter only where an earlier trigger wrote one.
        cleared = ~F.coalesce(F.col("avg_temperature") < threshold, F.lit(False))
        marked = changed.withColumn("cleared", cleared)
        merge_days(marked, path, epoch, key, F.col("window.start"), only_known=F.col("cleared"))

    return start_merging(city_temperature(readings), merge, checkpoint, trigger)


def start_closed_low_temperature_alarm(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    delay: str = DELAY,
    threshold: float = LOW_TEMPERATURE,
    notices_path: str | None = None,
) -> StreamingQuery:
    """Low-temperature alarms of closed windows of reading time, each written once."""
    closed = city_temperature(by_reading_time(readings, delay), "at")
    found = low_temperature(closed, threshold)

    def write(batch: DataFrame, epoch: int) -> None:
        write_noticed(batch, path, epoch, lambda rows: alarm_notice(rows, threshold), notices_path)

    return start_sink(found, write, checkpoint, trigger)


def closed_with_previous(closed: DataFrame) -> DataFrame:
    """Closed windows per city, in append mode, with the mean of the city's window before.

    Windows close in order from trigger to trigger, so the city's last mean is all
    that has to be remembered.
    """
    flat = closed.withColumns({"_start": F.col("window.start"), "_end": F.col("window.end")})
    flat = flat.drop("window")
    compared = stream_with_previous(
        flat, "avg_temperature", ["_start"], time_slice("_start", _CITY_SLICE), "city"
    )
    window = F.struct(F.col("_start").alias("start"), F.col("_end").alias("end"))
    return compared.withColumn("window", window).drop("_start", "_end")


def large_changes(compared: DataFrame, threshold: float = TEMPERATURE_CHANGE) -> DataFrame:
    """Windows whose mean differs from the one before by the threshold or more; null never does."""
    change = F.abs(F.col("avg_temperature") - F.col("_previous"))
    found = compared.withColumn("temperature_change", change)
    return found.where(F.col("temperature_change") >= threshold).select(
        "window", "city", "avg_temperature", "temperature_change"
    )


def start_temperature_change_alarm(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    delay: str = DELAY,
    threshold: float = TEMPERATURE_CHANGE,
    length: str = WINDOW_LENGTH,
    notices_path: str | None = None,
) -> StreamingQuery:
    """Change alarms over windows of reading time: each written once, and nothing else."""
    closed = city_temperature(by_reading_time(readings, delay), "at", length)
    found = large_changes(closed_with_previous(closed), threshold)

    def write(batch: DataFrame, epoch: int) -> None:
        write_noticed(batch, path, epoch, change_notice, notices_path)

    return start_sink(found, write, checkpoint, trigger)


# All results of one query


def city_aggregates(readings: DataFrame, time: str = "at", length: str = WINDOW_LENGTH) -> DataFrame:
    """What rollup and alarms are made of: sums, counts and extremes per window and city."""
    aggregates = []
    for v in READING_VALUES:
        number = F.col(f"data.{v}")
        aggregates += [
            F.sum(number.cast("double")).alias(f"sum_{v}"),
            F.count(number).alias(f"n_{v}"),
            F.max(number).alias(f"max_{v}"),
            F.min(number).alias(f"min_{v}"),
        ]
    windows = readings.groupBy(F.window(time, length), F.col("data.city").alias("city"))
    mean = F.try_divide("sum_temperature", "n_temperature")
    return windows.agg(*aggregates).withColumn("avg_temperature", mean)


def rollup_of(cities: DataFrame) -> DataFrame:
    """The rollup from the aggregates of all cities of its windows."""
    means = [
        F.try_divide(F.sum(f"sum_{v}"), F.sum(f"n_{v}")).alias(f"avg_{v}") for v in READING_VALUES
    ]
    extremes = [
        how(f"{kind}_{v}").alias(f"{kind}_{v}")
        for kind, how in (("max", F.max), ("min", F.min))
        for v in READING_VALUES
    ]
    return cities.groupBy("window").agg(*means, *extremes)


def start_closed(
    messages: DataFrame,
    base: str,
    trigger: dict = UNTIL_READ,
    delay: str = DELAY,
) -> StreamingQuery:
    """Rollup and both alarms of closed windows from one read and one decoding.

    One plan: aggregates per window and city in append mode, then the city's previous
    mean. All cities of a window close together, so their rows make the rollup's row;
    each result is written from the same rows of a trigger.
    """
    readings = _decoded(messages, ("time", "city", *READING_VALUES))
    compared = closed_with_previous(city_aggregates(by_reading_time(readings, delay)))

    def write(batch: DataFrame, epoch: int) -> None:
        rollup_of(batch).write.mode("overwrite").parquet(f"{base}/aggs/epoch={epoch}")
        means = batch.select("window", "city", "avg_temperature")
        write_noticed(low_temperature(means), f"{base}/alarms", epoch, alarm_notice, f"{base}/notices")
        changes = large_changes(batch)
        write_noticed(changes, f"{base}/alarmdiffs", epoch, change_notice, f"{base}/change_notices")

    return start_sink(compared, write, f"{base}/_checkpoints/closed", trigger)


def _decoded(messages: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Messages that come with ``data`` are taken as decoded."""
    if "data" in messages.columns:
        return messages
    return decode_readings(messages, fields=fields)


def start_all(
    messages: DataFrame,
    base: str,
    trigger: dict = UNTIL_READ,
    delay: str = DELAY,
    closed: bool = False,
) -> list[StreamingQuery]:
    """Rollup, low-temperature alarm and change alarm over one stream.

    ``closed`` takes all three from one query, by reading time, with bounded state.
    Otherwise the first two hold every window seen, by arrival, and rewrite their
    tables every trigger. Such results need an output mode of their own, so each of the
    three queries reads the source for itself and decodes only the fields it needs.
    """
    if closed:
        return [start_closed(messages, base, trigger, delay)]

    def places(name: str) -> tuple[str, str, dict]:
        return f"{base}/{name}", f"{base}/_checkpoints/{name}", trigger

    return [
        start_rollup(_decoded(messages, READING_VALUES), *places("aggs")),
        start_low_temperature_alarm(
            _decoded(messages, CITY_FIELDS), *places("alarms"), notices_path=f"{base}/notices"
        ),
        start_temperature_change_alarm(
            _decoded(messages, CHANGE_FIELDS),
            *places("alarmdiffs"),
            delay,
            notices_path=f"{base}/change_notices",
        ),
    ]
