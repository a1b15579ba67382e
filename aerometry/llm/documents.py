"""What the document operators share: their input columns, words and batches.

A word is a maximal run of characters other than space and the control
characters 9 to 13. In UTF-8 these six are single bytes that occur in no other
character, so splitting bytes splits characters alike.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from aerometry.session import delete_tree, scratch_path

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Characters one call of a batch function sees at most, unless one text is longer.
BATCH_BYTES = 16 << 20

BatchFunction = Callable[[pa.Array, pa.Array], pa.RecordBatch]


def share_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver does.

    A cluster that installs the library elsewhere is not affected.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def kept(rows: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Rows as a table in the shared folder, read back.

    Besides cutting the lineage, a table that was grouped before it is joined lets
    adaptive execution split a skewed partition of the join, which it cannot while
    the grouping is part of the same stage.
    """
    path = scratch_path(rows.sparkSession, purpose) if path is None else path
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Passing:
    """Tables in the shared folder that are dropped once all that comes of them is written.

    Until then they are there for tasks that run again; a job that fails leaves them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def path(self, purpose: str) -> str:
        self.paths.append(scratch_path(self.spark, purpose))
        return self.paths[-1]

    def kept(self, rows: DataFrame, purpose: str) -> DataFrame:
        return kept(rows, purpose, self.path(purpose))

    def drop(self) -> None:
        while self.paths:
            delete_tree(self.spark, self.paths.pop())


def sampled(rows: DataFrame, most: int, *key: str) -> list[Row]:
    """About ``most`` rows, all if there are fewer, chosen by a hash of ``key``.

    Only the chosen rows reach the driver, whatever the number of partitions.
    """
    count = rows.count()
    if count > most:
        scale = 1 << 40
        share = max(1, most * scale // count)
        rows = rows.where(F.pmod(F.xxhash64(*key), F.lit(scale)) < share).limit(2 * most)
    return rows.collect()


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def map_texts(
    docs: DataFrame, function: BatchFunction, schema: str, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Apply ``function(ids, texts)`` to every row in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            for start, end in slices(texts, batch_bytes):
                yield function(batch.column(0)[start:end], texts[start:end])

    return texts_of(docs).mapInArrow(run, schema)


def slices(texts: pa.Array, batch_bytes: int) -> Iterator[tuple[int, int]]:
    """Cut a batch so that no part has more bytes, unless one text has."""
    _, offsets = text_bytes(texts)
    start = 0
    while start < len(texts):
        limit = offsets[start] + batch_bytes
        end = max(start + 1, int(np.searchsorted(offsets, limit, side="right")) - 1)
        yield start, min(end, len(texts))
        start = end


#: Keys that a task remembers to leave out rows that repeat.
RECENT_KEYS = 100_000


def without_repeats(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[pa.RecordBatch]:
    """Batches without rows whose ``columns`` a task has seen a short while ago.

    Repeated rows thus leave a task once, or a few times; who needs them once drops the
    rest behind the shuffle.
    """
    seen: set[tuple] = set()
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in columns], strict=True)
        fresh = []
        for key in keys:
            fresh.append(key not in seen)
            seen.add(key)
        if len(seen) > RECENT_KEYS:
            seen.clear()
        yield batch if all(fresh) else batch.filter(pa.array(fresh, pa.bool_()))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and each text's first byte, with the end last."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of every word, and the number of words before each text.

    A word ends with its text, also where the next text goes on without a space.
    """
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~SPACE[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    edges = offsets[1:-1]
    joined = edges[inside[edges] & inside[edges + 1]]
    starts[joined] = ends[joined] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, offsets)
