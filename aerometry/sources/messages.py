"""Message streams: the broker topic and its file twin share one envelope."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from aerometry.schemas import ENVELOPE


@dataclass(frozen=True)
class KafkaTopic:
    """One topic, replayed from its beginning unless told otherwise.

    ``max_per_trigger`` bounds the size of a micro-batch, so that the first
    batch of a long replay does not try to hold the whole topic.
    """

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    max_per_trigger: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
        }
        if self.max_per_trigger is not None:
            chosen["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return {**chosen, **self.extra}

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()


@dataclass(frozen=True)
class MessageFiles:
    """The same envelope landed as parquet files; files arriving later are picked up."""

    path: str
    max_per_trigger: int | None = None

    def options(self) -> dict[str, str]:
        if self.max_per_trigger is None:
            return {}
        return {"maxFilesPerTrigger": str(self.max_per_trigger)}

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.schema(ENVELOPE).options(**self.options()).parquet(self.path)


def read_messages(spark: SparkSession, source: KafkaTopic | MessageFiles) -> DataFrame:
    """The envelope columns the pipelines use: binary ``value`` and ``timestamp``."""
    return source.read(spark).select(*ENVELOPE.fieldNames())
