"""Readings behind the watermark: how many there were, and how to put them right.

Windows on reading time close when Spark's watermark passes them; what comes later is
dropped from the stream and counted in its progress. The raw messages are kept by a
query of their own, so the windows that missed readings can be settled afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from aerometry.operators.rollup import WINDOW_LENGTH
from aerometry.streaming.sinks import UNTIL_READ, start_files

# What progress says before there is a watermark.
NO_WATERMARK = "1970-01-01T00:00:00.000Z"


@dataclass
class Late:
    """What a query has dropped behind its watermark: rows as its windows counted them,
    added up per task, and the reading times between which they lie."""

    rows: int = 0
    since: datetime | None = None
    until: datetime | None = None


    def take(self, progress: StreamingQueryProgress) -> None:
        """Add what a trigger has dropped."""
        watermark = progress.eventTime.get("watermark")
        if watermark in (None, NO_WATERMARK):
            return
        watermark = datetime.fromisoformat(watermark)
        self.until = max(watermark, self.until or watermark)
        dropped = sum(step.numRowsDroppedByWatermark for step in progress.stateOperators)
        earliest = progress.eventTime.get("min")
        if dropped and earliest is not None:
            earliest = datetime.fromisoformat(earliest)
            self.rows += dropped
            self.since = min(earliest, self.since or earliest)


class LateReadings(StreamingQueryListener):
    """Listens to the progress of queries; ``of`` tells what one of them has dropped.

    ``session.streams.addListener`` puts it to work. Progress arrives a moment after
    the trigger it tells of.
    """

    def __init__(self) -> None:
        self.found: dict[str, Late] = {}

    def of(self, query: StreamingQuery) -> Late:
        return self.found.get(str(query.id), Late())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.found.setdefault(str(event.progress.id), Late()).take(event.progress)

    def onQueryTerminated(self, event) -> None:
        pass


def late_readings(query: StreamingQuery) -> Late:
    """As the listener tells it, of a query's latest triggers: all of a short run."""
    late = Late()
    for progress in query.recentProgress:
        late.take(progress)
    return late


def start_archive(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict = UNTIL_READ
) -> StreamingQuery:
    """Keep every raw message, malformed and untimed ones too, as files listed once committed."""
    return start_files(messages, path, checkpoint, trigger)


def city_means(readings: DataFrame, time: str, length: str = WINDOW_LENGTH) -> DataFrame:
    """Mean temperature per window and city, and how many readings have one; none without a time."""
    temperature = F.col("data.temperature")
    windows = readings.groupBy(F.window(time, length), F.col("data.city").alias("city"))
    return windows.agg(
        F.avg(temperature).alias("avg_temperature"), F.count(temperature).alias("n_temperature")
    )


def settled(closed: DataFrame, again: DataFrame, late: Late, *key: str) -> DataFrame:
    """The closed windows, those that missed readings replaced.

    ``again`` holds the windows as computed from the archive. Only those between the
    earliest late reading and the watermark are looked at, a range that reaches the
    scan; windows beyond the watermark are still open. ``key`` names what a window is
    kept per.
    """
    if late.since is None:
        return closed
    touched = again.where(
        (F.col("window.end") > F.lit(late.since)) & (F.col("window.end") <= F.lit(late.until))
    )
    name = ("window", *key)
    ahead = touched.select(*[F.col(c).alias(f"_{c}") for c in name])
    same = F.lit(True)
    for c in name:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return closed.join(ahead, same, "left_anti").unionByName(touched)
