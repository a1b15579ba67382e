"""Combining the sensor tables on (device, instant), and counting the combination.

The combined table has one row per matching combination: where tables hold
n1, n2, ... rows for a key, it holds the product of max(n, 1) rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometry.operators.skew import written_if_any
from aerometry.schemas import DEVICE, KEY, TIME
from aerometry.session import scratch_path

# Most rows of the combined table that one task should make from one key.
HOT_ROWS = 2_000_000


def with_key(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows whose key columns are all present.

    The combined table has no others: a NULL key never matches, so filtering
    the inputs gives what filtering the outer join would.
    """
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in key]))


def key_counts(tables: Mapping[str, DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """Rows per key and table, as columns ``n_<table>``; one shuffle of keys only."""
    parts = [
        with_key(df, key).select(*key, F.lit(i).alias("_table"))
        for i, df in enumerate(tables.values())
    ]
    return _count_per_table(reduce(DataFrame.union, parts), list(tables), F.col("_table"), key)


def key_counts_long(
    readings: DataFrame, table: Column, names: Sequence[str], key: Sequence[str] = KEY
) -> DataFrame:
    """As :func:`key_counts` for one long table; ``table`` is 0, 1, ... per ``names``."""
    return _count_per_table(with_key(readings, key), names, table, key)


def _count_per_table(
    rows: DataFrame, names: Sequence[str], table: Column, key: Sequence[str]
) -> DataFrame:
    return rows.groupBy(*key).agg(
        *[F.count_if(table == F.lit(i)).alias(f"n_{name}") for i, name in enumerate(names)]
    )


def combined_rows(counts: DataFrame) -> Column:
    """Rows the combined table holds for a key; an error if beyond bigint."""
    sizes = [F.greatest(F.col(c), F.lit(1)) for c in counts.columns if c.startswith("n_")]
    product = reduce(F.try_multiply, sizes)
    return F.coalesce(
        product, F.raise_error(F.lit("combined rows of one key exceed bigint")).cast("bigint")
    )


def total_measurements(counts: DataFrame) -> DataFrame:
    """Combined rows per device, from key counts; the join is never made."""
    return counts.groupBy(DEVICE).agg(F.sum(combined_rows(counts)).alias("total_measurements"))


def hourly_measurements(counts: DataFrame) -> DataFrame:
    """Combined rows per device and hour of day, all dates together."""
    return counts.groupBy(DEVICE, F.hour(TIME).alias("hour")).agg(
        F.sum(combined_rows(counts)).alias("num_measurements")
    )


def combine_sensors(
    tables: Mapping[str, DataFrame],
    key: Sequence[str] = KEY,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The combined wide table: every table's columns on matching keys.

    Equal to a chain of full outer joins. A chain reshuffles its growing result
    at every step, as the merged key of a full outer join has no known
    partitioning. Here the distinct keys of all tables are found once and each
    table is left-joined to them, which keeps partitioning and order: the wide
    rows are never moved.

    The keys are counted per table in one pass over the key columns and kept as
    a table, which is the left side of the joins. Keys that make more than
    ``hot_rows`` rows leave it; they are split into cells of about that many
    rows, which join separately. ``None`` splits nothing.
    """
    keyed = {name: with_key(df, key) for name, df in tables.items()}
    counted = key_counts(keyed, key)
    if hot_rows is None:
        return _attach(counted.select(*key), keyed, key)
    kept = scratch_path(counted.sparkSession, "key-counts")
    counted.write.parquet(kept)
    counts = counted.sparkSession.read.schema(counted.schema).parquet(kept)
    sizes = _sizes(list(keyed))
    hot = hot_keys(counts, list(keyed), key, hot_rows)
    if hot is None:
        return _attach(counts.select(*key), keyed, key)
    cold_tables = {name: df.join(hot, list(key), "left_anti") for name, df in keyed.items()}
    cold_keys = counts.where(_product(sizes) <= hot_rows).select(*key)
    cold = _attach(cold_keys, cold_tables, key)
    return cold.unionByName(_split(keyed, hot, key))


def _attach(keys: DataFrame, tables: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    wide = keys
    for df in tables.values():
        wide = wide.join(df, list(key), "left")
    return wide


def _sizes(names: Sequence[str]) -> list[Column]:
    """Rows per table that a key contributes to the product."""
    return [F.greatest(F.col(f"n_{name}"), F.lit(1)).cast("double") for name in names]


def _product(sizes: Sequence[Column]) -> Column:
    return reduce(Column.__mul__, sizes)


def hot_keys(
    counts: DataFrame, names: Sequence[str], key: Sequence[str], hot_rows: int
) -> DataFrame | None:
    """Keys that make more than ``hot_rows`` rows, and how each is split; None without any.

    The rows a key makes are a grid with one side per table. Every side is cut
    into chunks of at most s rows, where s is the largest number with which no
    cell holds more than ``hot_rows``: small tables stay whole, large ones are
    cut alike, and so rows are copied no more often than the cells need.
    ``_chunk_<table>`` is the length of a table's chunks, ``_fan_<table>`` their
    number. At most total/hot_rows keys are hot.
    """
    found = counts.where(_product(_sizes(names)) > hot_rows)
    ordered = F.array_sort(F.array(*_sizes(names)))
    side = None
    below = F.lit(1.0)
    for whole in range(len(names)):
        # The smallest tables whole, the others cut at the same length.
        length = F.pow(F.lit(float(hot_rows)) / below, F.lit(1.0 / (len(names) - whole)))
        following = F.element_at(ordered, whole + 1)
        side = (F if side is None else side).when(length <= following, length)
        below = below * following
    cut = found.withColumn("_side", F.greatest(F.floor(side + F.lit(1e-9)), F.lit(1)))
    chunks = {
        name: F.least(F.greatest(F.col(f"n_{name}"), F.lit(1)), F.col("_side")) for name in names
    }
    fans = {
        name: F.ceil(F.greatest(F.col(f"n_{name}"), F.lit(1)) / F.col(f"_chunk_{name}"))
        for name in names
    }
    cut = cut.withColumns({f"_chunk_{name}": c.cast("bigint") for name, c in chunks.items()})
    cut = cut.withColumns({f"_fan_{name}": c.cast("bigint") for name, c in fans.items()})
    parameters = [c for name in names for c in (f"_chunk_{name}", f"_fan_{name}")]
    return written_if_any(cut.select(*key, *parameters), "hot-keys")


def _split(tables: Mapping[str, DataFrame], hot: DataFrame, key: Sequence[str]) -> DataFrame:
    """The combined rows of the hot keys: every cell of every key joins separately."""
    names = list(tables)
    cells = hot.select(
        *key,
        F.explode(F.sequence(F.lit(0).cast("bigint"), _cells(names) - 1)).alias("_cell"),
    )
    dealt = {name: dealt_rows(df, hot, name, names, key) for name, df in tables.items()}
    return _attach(cells, dealt, [*key, "_cell"]).drop("_cell")


def _cells(names: Sequence[str]) -> Column:
    return reduce(Column.__mul__, [F.col(f"_fan_{name}") for name in names], F.lit(1).cast("bigint"))


def dealt_rows(
    df: DataFrame, hot: DataFrame, name: str, names: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """A table's rows of the hot keys with ``_cell``, once for every cell of its chunk.

    Rows are numbered, so that chunks are full whatever the rows hold: first
    within the part of a key that one task has written, then by adding up the
    parts before it. The rows are written once; a repeated task numbers alike.
    """
    at = names.index(name)
    path = scratch_path(df.sparkSession, "hot-rows")
    marked = df.join(hot, list(key)).withColumn("_at", F.monotonically_increasing_id())
    marked.write.parquet(path)
    rows = df.sparkSession.read.schema(marked.schema).parquet(path)
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy(*key, "_part").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(along), F.lit(0)))
    within = Window.partitionBy(*key, "_part").orderBy("_at")
    numbered = (
        rows.withColumn("_number", F.row_number().over(within) - 1)
        .join(parts.drop("_n"), [*key, "_part"])
        .withColumn(
            "_own", F.floor((F.col("_number") + F.col("_before")) / F.col(f"_chunk_{name}"))
        )
    )
    own = F.col(f"_fan_{name}")
    inner = reduce(
        Column.__mul__, [F.col(f"_fan_{n}") for n in names[at + 1 :]], F.lit(1).cast("bigint")
    )
    others = F.sequence(F.lit(0).cast("bigint"), (_cells(names) / own).cast("bigint") - 1)
    cell = (
        F.floor(F.col("_other") / inner) * (inner * own)
        + F.col("_own") * inner
        + F.pmod(F.col("_other"), inner)
    )
    return numbered.withColumn("_other", F.explode(others)).select(
        *df.columns, cell.cast("bigint").alias("_cell")
    )
