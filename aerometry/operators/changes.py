"""Comparing each row with the one before it: the change filter and what it rests on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometry.operators.skew import written_if_any
from aerometry.schemas import DEVICE, TIME

# Most rows of one device that one task should put in order.
HOT_ROWS = 2_000_000


def time_slices(
    time: str = TIME, sequence: str | None = None, hot_rows: int = HOT_ROWS
) -> list[Column]:
    """Ever finer cuts of the order (time, sequence), each refining the one before."""
    units = ("day", "hour", "minute", "second", "millisecond")
    cuts = [F.date_trunc(unit, time) for unit in units]
    cuts.append(F.col(time))
    if sequence is not None:
        cuts.append(F.floor(F.col(sequence) / F.lit(hot_rows)))
    return cuts


def with_previous(
    rows: DataFrame,
    value: str,
    order: Sequence[str] = (TIME,),
    slices: Sequence[Column] = (),
    key: str = DEVICE,
    before: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
    cut_all: Column | None = None,
) -> DataFrame:
    """Add ``_previous``: the ``value`` of the key's row just ahead along ``order``.

    ``before`` holds one (key, value) row per key remembered from earlier input;
    it comes ahead of all rows of that key.

    A key with more than ``hot_rows`` rows is not put in order by one task: it
    is cut by the first of ``slices`` (expressions that never decrease along
    ``order``), slices still too large by the second, and so on. Each slice is
    ordered on its own and starts from the last value of the slice before it,
    so the result is the same. Other keys stay whole. ``None`` never looks for
    such keys. ``cut_all`` cuts every key to begin with, without a look.
    """
    cut_rows, cuts = rows, []
    if cut_all is not None:
        cuts = ["_cut_all"]
        cut_rows = rows.withColumn("_cut_all", cut_all).withColumn("_is_cut", F.lit(True))
    cut_rows, cuts = _cut_hot_groups(cut_rows, key, slices, hot_rows, cuts)
    group = [key, *cuts]
    starts = [] if before is None else [before.select(key, value)]
    if cuts:
        hot = cut_rows.where("_is_cut")
        starts.append(_values_before_slices(hot, value, order, group, before))
    ordered = cut_rows.withColumn("_start", F.lit(False))
    for start in starts:
        ordered = ordered.unionByName(
            start.withColumn("_start", F.lit(True)), allowMissingColumns=True
        )
    along = Window.partitionBy(*group).orderBy(F.desc("_start"), *order)
    return (
        ordered.withColumn("_previous", F.lag(value).over(along))
        .where(~F.col("_start"))
        .select(*rows.columns, "_previous")
    )


def changed_readings(
    readings: DataFrame,
    value: str,
    order: Sequence[str] = (TIME,),
    slices: Sequence[Column] = (),
    key: str = DEVICE,
    before: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Readings whose ``value`` differs from that of the device's previous reading.

    A, A, B, A keeps A, B, A; a first reading is kept; a reading without a value
    is left out and not remembered. See :func:`with_previous` for the rest.
    """
    valued = readings.where(F.col(value).isNotNull())
    compared = with_previous(valued, value, order, slices, key, before, hot_rows)
    changed = F.col("_previous").isNull() | (F.col("_previous") != F.col(value))
    return compared.where(changed).drop("_previous")


def last_values(
    rows: DataFrame,
    value: str,
    order: Sequence[str] = (TIME,),
    key: str = DEVICE,
    before: DataFrame | None = None,
    count_missing: bool = False,
) -> DataFrame:
    """The value to remember per key: that of its last row, else the one remembered before.

    A row without a value is passed over unless ``count_missing``.
    """
    counted = rows if count_missing else rows.where(F.col(value).isNotNull())
    latest = counted.select(key, value, F.struct(F.lit(True), *order).alias("_at"))
    if before is not None:
        latest = latest.unionByName(before.select(key, value), allowMissingColumns=True)
    earlier = F.max(F.when(F.col("_at").isNull(), F.col(value)))
    return latest.groupBy(key).agg(
        F.when(F.count("_at") > 0, F.max_by(value, "_at")).otherwise(earlier).alias(value)
    )


def _values_before_slices(
    rows: DataFrame,
    value: str,
    order: Sequence[str],
    group: Sequence[str],
    before: DataFrame | None,
) -> DataFrame:
    """Per slice of a cut device, the last value ahead of it.

    The last value of each slice is found on the map side; what is put in order
    per device is one row per slice.
    """
    last = rows.groupBy(*group).agg(F.max_by(value, F.struct(*order)).alias(value))
    last = last.withColumn("_slice", F.lit(True))
    if before is not None:
        last = last.unionByName(before.select(group[0], value), allowMissingColumns=True)
    along = Window.partitionBy(group[0]).orderBy("_slice", *group[1:])
    return (
        last.withColumn(value, F.lag(value).over(along))
        .where(F.col("_slice") & F.col(value).isNotNull())
        .drop("_slice")
    )


def _cut_hot_groups(
    rows: DataFrame,
    key: str,
    slices: Sequence[Column],
    hot_rows: int | None,
    cuts: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Add a column per slice level in use: the level's value in groups that need it."""
    cuts = list(cuts)
    if hot_rows is None:
        return rows, cuts
    for level, cut in enumerate(slices):
        group = [key, *cuts]
        candidates = rows.where("_is_cut") if cuts else rows
        counts = candidates.groupBy(*group).agg(F.count("*").alias("_n"))
        hot = written_if_any(counts.where(F.col("_n") > hot_rows).select(*group), "hot-groups")
        if hot is None:
            break
        marks = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in group], F.lit(True).alias("_hot"))
        same = reduce(
            Column.__and__, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in group]
        )
        rows = rows.join(marks, same, "left").withColumn(f"_cut{level}", F.when(F.col("_hot"), cut))
        if "_is_cut" not in rows.columns:
            rows = rows.withColumn("_is_cut", F.col("_hot").isNotNull())
        rows = rows.drop("_hot", *[f"_hot_{c}" for c in group])
        cuts.append(f"_cut{level}")
    return rows, cuts
