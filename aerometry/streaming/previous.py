"""The row before, per key, on a stream: Spark's keyed state behind a split into time slices.

Two stateful steps follow each other in one plan. The first puts the rows of each
(key, slice) in order and compares them with each other. What it cannot know, the value
ahead of a slice, concerns the slice's first row only. That row, with the slice's last
value, goes on to the second step, which holds the key's last value in a ``MapState``
and walks from slice to slice. All other rows pass it unopened. So a key that sends a
third of all readings reaches a single task with a row per slice only.

A group of Spark's keyed state costs Python some thousand times what a row costs in a
column. So keys are dealt to parts by hash and slices to shares of a part; a group is a
share or a part, its rows travel as Arrow tables in single binary values, and its keys
are ordered and compared together, column by column.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from aerometry.schemas import DEVICE

# The processors travel with the plan, so workers need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Length of a slice unless told otherwise; a slice's rows of a trigger are ordered in memory.
SLICE = "hour"

#: Parts that keys are dealt to. A key's state lies with its part: fixed by the first start.
PARTS = 128

#: Shares of a part that slices are dealt to; nothing is kept by share.
SHARES = 4

#: What a task deals at a time, and the most rows of one packed table.
DEALT_BYTES = 32 << 20
PACKED_ROWS = 10_000

_SENT = "_part int, _share int, _rows binary"
_COMPARED = T.StructType(
    [
        T.StructField("_part", T.IntegerType()),
        T.StructField("_ahead", T.BooleanType()),
        T.StructField("_rows", T.BinaryType()),
    ]
)
_WALKED = T.StructType([T.StructField("_rows", T.BinaryType())])


def time_slice(time: str, unit: str = SLICE) -> Column:
    """Slices of one unit of time, as text; rows without a time make one more."""
    return F.coalesce(F.date_trunc(unit, time).cast("string"), F.lit(""))


def stream_with_previous(
    rows: DataFrame,
    value: str,
    order: Sequence[str],
    time_slice: Column,
    key: str = DEVICE,
    drop_equal: bool = False,
    passing: Column | None = None,
) -> DataFrame:
    """Add ``_previous`` to a stream: the ``value`` of the key's row just ahead along ``order``.

    Rows of a trigger follow those of the trigger before. ``time_slice`` must not
    decrease along ``order``. With ``drop_equal``, rows within a slice that equal the one
    before go no further than the first step; first rows of slices are not looked at.
    Rows that are ``passing`` are no one's previous row and have none; they are dealt by
    ``order``, as many may share a key. A null key is a key.
    """
    passes = F.lit(False) if passing is None else F.coalesce(passing, F.lit(False))
    part = F.when(passes, F.xxhash64(*order)).otherwise(F.xxhash64(key))
    sliced = rows.withColumns(
        {
            "_slice": time_slice,
            "_passes": passes,
            "_part": F.pmod(part, F.lit(PARTS)).cast("int"),
        }
    ).withColumn("_share", F.pmod(F.xxhash64("_slice"), F.lit(SHARES)).cast("int"))
    kind = rows.schema[value].dataType
    key_kind = rows.schema[key].dataType
    first = (
        sliced.mapInArrow(deal, _SENT)
        .groupBy("_part", "_share")
        .transformWithState(
            WithinSlices(key, value, list(order), drop_equal), _COMPARED, "Append", "None"
        )
    )
    second = first.groupBy("_part").transformWithState(
        AcrossSlices(key, value, list(order), key_kind, kind), _WALKED, "Append", "None"
    )
    return second.mapInArrow(open_rows, T.StructType([*rows.schema, T.StructField("_previous", kind)]))


@contextmanager
def state_partitions(session: SparkSession) -> Iterator[None]:
    """Start a stream of these steps with no more state partitions than there are parts.

    A further one would never hold a row, but cost a task per step and trigger. The
    session's setting is as before afterwards.
    """
    name = "spark.sql.shuffle.partitions"
    wanted = session.conf.get(name)
    session.conf.set(name, str(min(int(wanted), PARTS)))
    try:
        yield
    finally:
        session.conf.set(name, wanted)


def packed(rows: pa.Table) -> Iterator[bytes]:
    """A table as binary values of at most ``PACKED_ROWS`` rows; none for no rows."""
    for start in range(0, rows.num_rows, PACKED_ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as stream:
            stream.write_table(rows.slice(start, PACKED_ROWS))
        yield sink.getvalue().to_pybytes()


def opened(values: Sequence[bytes]) -> pa.Table:
    """The rows of packed tables in one table."""
    tables = [pa.ipc.open_stream(value).read_all() for value in values]
    return pa.concat_tables(tables).combine_chunks()


def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack the rows of each part and share, a bounded number of bytes at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= DEALT_BYTES:
            yield _dealt(held)
            held, size = [], 0
    if held:
        yield _dealt(held)


def _dealt(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches)
    rows = _sorted(rows, ["_part", "_share"])
    parts, shares = (rows[name].to_numpy() for name in ("_part", "_share"))
    rows = rows.drop_columns(["_part", "_share"])
    bounds = np.flatnonzero(_differs(pa.array(parts)) | _differs(pa.array(shares)))
    made = []
    for start, end in zip(bounds, [*bounds[1:], len(parts)]):
        for value in packed(rows.slice(start, end - start)):
            made.append((parts[start], shares[start], value))
    columns = zip(*made) if made else ((), (), ())
    kinds = (pa.int32(), pa.int32(), pa.binary())
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["_part", "_share", "_rows"])


def open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of packed tables, in batches of some ``PACKED_ROWS``."""
    held, count = [], 0
    for batch in batches:
        for value in batch.column(0):
            held.append(pa.ipc.open_stream(value.as_buffer()).read_all())
            count += held[-1].num_rows
            if count >= PACKED_ROWS:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, count = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _sorted(rows: pa.Table, names: Sequence[str]) -> pa.Table:
    """Rows in order; missing values first, as Spark sorts them."""
    keys = [(name, "ascending") for name in names]
    places = pc.sort_indices(rows, sort_keys=keys, null_placement="at_start")
    return rows.take(places).combine_chunks()


def _differs(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Whether a value differs from the one ahead of it, as the first one does; null equals null."""
    here, ahead = column[1:], column[: max(len(column) - 1, 0)]
    unequal = pc.fill_null(pc.not_equal(here, ahead), False)
    unequal = pc.or_(unequal, pc.xor(pc.is_null(here), pc.is_null(ahead)))
    return np.concatenate([np.ones(min(len(column), 1), bool), unequal.to_numpy(zero_copy_only=False)])


def _taken(column: pa.ChunkedArray, places: np.ndarray) -> pa.ChunkedArray:
    """Values at places; null where a place is negative."""
    return column.take(pa.array(places, pa.int64(), mask=places < 0))


class _InOrder(StatefulProcessor):
    def __init__(self, key: str, value: str, order: list[str]) -> None:
        self.key, self.value, self.order = key, value, order

    def close(self) -> None:
        pass


class WithinSlices(_InOrder):
    """Compares the rows of slices; a slice's first row waits for the value ahead of it."""

    def __init__(self, key: str, value: str, order: list[str], drop_equal: bool) -> None:
        super().__init__(key, value, order)
        self.drop_equal = drop_equal

    def init(self, handle) -> None:
        self.made = Row(*_COMPARED.names)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        table = opened([row._rows for row in rows])
        held = table.filter(pc.invert(table["_passes"]))
        if held.num_rows < table.num_rows:
            passing = table.filter(table["_passes"]).drop_columns(["_slice", "_passes"])
            none = pa.nulls(passing.num_rows, table.schema.field(self.value).type)
            yield from self.sent(key[0], False, passing.append_column("_previous", none))
        if held.num_rows == 0:
            return
        held = _sorted(held, [self.key, *self.order])
        first = _differs(held[self.key]) | _differs(held["_slice"])
        held = held.drop_columns(["_slice", "_passes"])
        values = held[self.value]
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], held.num_rows) - 1
        ahead = held.take(pa.array(starts)).append_column("_last", _taken(values, ends))
        yield from self.sent(key[0], True, ahead)
        compared = held.append_column("_previous", _taken(values, np.arange(held.num_rows) - 1))
        kept = pa.array(~first)
        if self.drop_equal and not pa.types.is_nested(values.type):
            equal = pc.fill_null(pc.equal(compared["_previous"], values), False)
            kept = pc.and_not(kept, equal)
        yield from self.sent(key[0], False, compared.filter(kept))

    def sent(self, part: int, ahead: bool, rows: pa.Table) -> Iterator[Row]:
        for value in packed(rows):
            yield self.made(part, ahead, value)


class AcrossSlices(_InOrder):
    """Walks from slice to slice of each key of a part; last values are Spark's to keep."""

    def __init__(
        self, key: str, value: str, order: list[str], key_kind: T.DataType, kind: T.DataType
    ) -> None:
        super().__init__(key, value, order)
        self.key_kind, self.kind = key_kind, kind

    def init(self, handle) -> None:
        self.made = Row(*_WALKED.names)
        keys = T.StructType([T.StructField("key", self.key_kind)])
        state = T.StructType([T.StructField("value", self.kind)])
        self.remembered = handle.getMapState("last", keys, state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        waiting = []
        for row in rows:
            if row._ahead:
                waiting.append(row._rows)
            else:
                yield self.made(row._rows)
        if not waiting:
            return
        table = _sorted(opened(waiting), [self.key, *self.order])
        last = table["_last"]
        starts = np.flatnonzero(_differs(table[self.key]))
        ends = np.append(starts[1:], table.num_rows) - 1
        # A key's first row follows what is remembered, any other one the slice ahead of it.
        known = self.remember(_taken(table[self.key], starts).to_pylist(), _taken(last, ends).to_pylist())
        places = np.arange(table.num_rows) - 1
        places[starts] = table.num_rows + np.arange(len(starts))
        values = pa.chunked_array([*last.chunks, pa.array(known, last.type)])
        walked = table.drop_columns(["_last"]).append_column("_previous", _taken(values, places))
        for value in packed(walked):
            yield self.made(value)

    def remember(self, keys: list, values: list) -> list:
        """Keep the last values of keys and return what was kept before them."""
        known = []
        for name, value in zip(keys, values):
            before = self.remembered.getValue((name,))
            known.append(None if before is None else before[0])
            if before is None or before[0] != value:
                self.remembered.updateValue((name,), (value,))
        return known
