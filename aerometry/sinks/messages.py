"""Publishing readings: a broker topic, or its file twin."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class KafkaPublisher:
    """Value-only messages to one topic; a send counts once the leader has it."""

    servers: str
    topic: str
    acks: str = "1"
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            "kafka.acks": self.acks,
            **self.extra,
        }

    def publish(self, messages: DataFrame, epoch: int) -> None:
        messages.select("value").write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class FilePublisher:
    """One folder per micro-batch; running a batch again replaces its folder."""

    path: str

    def publish(self, messages: DataFrame, epoch: int) -> None:
        messages.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
