"""Starting a streaming query with a place to put its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerometry.sinks.tables import current_path, replace_table

# Keyword arguments of DataStreamWriter.trigger; this one empties the source and stops.
UNTIL_READ = {"availableNow": True}


def start_replacing(
    result: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = UNTIL_READ,
    notices: Callable[[DataFrame], DataFrame] | None = None,
    notices_path: str | None = None,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Complete mode: every trigger replaces the table by the whole current result.

    The table is read at ``sinks.tables.current_path``. An empty result replaces it
    too, so resolved alarms go away. ``notices`` turns a result into messages; they are
    kept per trigger under ``notices_path`` and only if the result, counted as it is
    written, has rows.
    """

    def replace(result: DataFrame, epoch: int) -> None:
        seen = Observation()
        counted = result.observe(seen, F.count(F.lit(1)).alias("rows"))
        replace_table(counted, path, epoch, file_format)
        if notices is not None and seen.get.get("rows"):
            written = result.sparkSession.read.schema(result.schema).format(file_format)
            messages = notices(written.load(current_path(result.sparkSession, path)))
            messages.write.mode("overwrite").parquet(f"{notices_path}/epoch={epoch}")

    return (
        result.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_merging(
    result: DataFrame,
    merge: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict = UNTIL_READ,
) -> StreamingQuery:
    """Update mode: hand the rows that a trigger changes, and its number, to ``merge``."""
    return _start_batches(result, merge, checkpoint, trigger, "update")


def start_sink(
    rows: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict = UNTIL_READ,
) -> StreamingQuery:
    """Append mode: hand every micro-batch of new rows, and its number, to ``sink``.

    The rows are computed once, however often ``sink`` reads them. A batch that fails
    runs again from the state it began with, under the same number.
    """

    return _start_batches(rows, sink, checkpoint, trigger, "append")


def _start_batches(
    rows: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict,
    mode: str,
) -> StreamingQuery:
    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            sink(batch, epoch)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_files(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_READ
) -> StreamingQuery:
    """Append mode into a folder of files, which lists the committed ones itself."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_noticed(
    found: DataFrame,
    path: str,
    epoch: int,
    notices: Callable[[DataFrame], DataFrame],
    notices_path: str | None,
) -> None:
    """Write rows of a micro-batch, and messages about them if there are any.

    The rows are counted as they are written; without any nothing is read again.
    """
    seen = Observation()
    counted = found.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    if notices_path is not None and seen.get.get("rows"):
        notices(found).write.mode("overwrite").parquet(f"{notices_path}/epoch={epoch}")
