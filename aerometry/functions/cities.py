"""City assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerometry.schemas import CITIES


def assign_city(number: Column, cities: tuple[str, ...] = CITIES) -> Column:
    """Pick a city by an integer column; the same number always gives the same city.

    A random pick would change when a lost task is run again, so a retry could
    publish the same reading under two cities. For text keys pass a hash, such
    as ``xxhash64(deviceId, time)``.
    """
    return F.element_at(
        F.array(*[F.lit(city) for city in cities]),
        (F.pmod(number, F.lit(len(cities))) + 1).cast("int"),
    )
