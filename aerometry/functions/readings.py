"""Readings as JSON messages: decode, encode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerometry.schemas import DEVICE, READING, READING_VALUES


def reading_from_json(
    text: Column, time_unit: str = "seconds", fields: Sequence[str] | None = None
) -> Column:
    """Parse a JSON reading into a struct.

    Text that is not JSON yields a struct of NULLs; a field of the wrong type is
    NULL on its own. An integer ``time`` counts seconds since 1970 unless
    ``time_unit`` is "milliseconds". ``fields`` names those wanted: the parser
    skips the others, which saves about half its time for two of nine.
    """
    if time_unit not in ("seconds", "milliseconds"):
        raise ValueError(f"time_unit must be seconds or milliseconds, not {time_unit!r}")
    wanted = [f for f in READING if fields is None or f.name in fields]
    if time_unit == "seconds" or "time" not in [f.name for f in wanted]:
        return F.from_json(text, T.StructType(wanted))
    counted = [
        T.StructField(f.name, T.LongType() if f.name == "time" else f.dataType) for f in wanted
    ]
    parsed = F.from_json(text, T.StructType(counted))
    return parsed.withField("time", F.timestamp_millis(parsed["time"]))


def decode_readings(
    messages: DataFrame,
    time_unit: str = "seconds",
    drop_malformed: bool = False,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``data``, the reading held by the binary ``value`` column of an envelope.

    Malformed messages stay as rows whose fields are all NULL, so that windows on
    the envelope time still count them; ``drop_malformed`` leaves them out, which
    takes all ``fields`` to tell.

    The one-row explode keeps a filter on ``data`` from being moved below the
    parse, where it would need a second parse of its own.
    """
    if drop_malformed and fields is not None:
        raise ValueError("malformed messages cannot be told by some fields only")
    data = reading_from_json(F.col("value").cast("string"), time_unit, fields)
    decoded = messages.select("*", F.explode(F.array(data)).alias("data"))
    if drop_malformed:
        found = [F.col(f"data.{f.name}").cast("string") for f in READING]
        decoded = decoded.where(F.coalesce(*found).isNotNull())
    return decoded


def finite_or_null(number: Column) -> Column:
    """JSON has no NaN or infinities; such numbers become NULL."""
    infinity = F.lit(float("inf"))
    return F.when(~F.isnan(number) & (F.abs(number) != infinity), number)


def reading_to_json(columns: dict[str, Column] | None = None) -> Column:
    """JSON text of one reading; ``columns`` overrides where a field comes from."""
    source = {name: F.col(name) for name in (DEVICE, "city", "time", *READING_VALUES)}
    source.update(columns or {})
    fields = [source[DEVICE].alias(DEVICE), source["city"].alias("city")]
    fields.append(source["time"].cast("bigint").alias("time"))
    fields += [
        finite_or_null(source[name].cast("double")).alias(name) for name in READING_VALUES
    ]
    return F.to_json(F.struct(*fields))


def encode_readings(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One binary ``value`` per reading, as published; ``keep`` passes columns through."""
    return readings.select(reading_to_json().cast("binary").alias("value"), *keep)
