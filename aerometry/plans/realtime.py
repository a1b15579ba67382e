"""The streaming pipelines: readings to rollup and alarms, payloads to readings."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from aerometry.session import streaming_session
from aerometry.sinks.messages import FilePublisher, KafkaPublisher
from aerometry.sources.feeds import read_payload_table
from aerometry.sources.messages import KafkaTopic, MessageFiles, read_messages
from aerometry.streaming.alarms import DELAY, start_all
from aerometry.streaming.changes import start_ingest

#: Sizes of a micro-batch that a long replay is cut into.
FILES_PER_TRIGGER = 1000
MESSAGES_PER_TRIGGER = 50_000_000


def run_alarms(
    spark: SparkSession,
    source: KafkaTopic | MessageFiles,
    base: str,
    trigger: dict,
    delay: str = DELAY,
    closed: bool = True,
) -> None:
    """Rollup and both alarms until one of the queries ends.

    By default their state is bounded, and one query reads the source for all three;
    windows by reading time are written once, when closed.
    """
    session = streaming_session(spark)
    start_all(read_messages(session, source), base, trigger, delay, closed)
    session.streams.awaitAnyTermination()


def run_ingest(
    spark: SparkSession,
    feed: str,
    publisher: KafkaPublisher | FilePublisher,
    base: str,
    trigger: dict,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> None:
    """Publish changed readings from landed payloads until stopped."""
    payloads = read_payload_table(
        streaming_session(spark), feed, stream=True, maxFilesPerTrigger=str(files_per_trigger)
    )
    start_ingest(
        payloads, publisher, f"{base}/rejects", f"{base}/_checkpoints/ingest", trigger
    ).awaitTermination()


def arguments(words: Sequence[str] | None = None) -> argparse.Namespace:
    """Parsed and checked arguments; a missing place is an error, not a folder called None."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("pipeline", choices=("alarms", "ingest"))
    parser.add_argument("base", help="where results and checkpoints go")
    parser.add_argument("--servers", help="broker addresses; files are used without")
    parser.add_argument("--topic", default="readings")
    parser.add_argument("--files", help="folder of messages, in place of a topic")
    parser.add_argument("--feed", help="folder of landed payloads")
    parser.add_argument("--every", default="10 seconds", help="time between triggers")
    parser.add_argument("--delay", default=DELAY, help="how long windows wait for readings")
    form = parser.add_mutually_exclusive_group()
    form.add_argument(
        "--closed",
        action="store_true",
        default=True,
        help="bounded rollup and alarm, by reading time (the default)",
    )
    form.add_argument(
        "--complete",
        dest="closed",
        action="store_false",
        help="rollup and alarm by arrival that hold every window seen",
    )
    parser.add_argument(
        "--max-per-trigger", type=int, help="messages of a topic, or files, in one micro-batch"
    )
    args = parser.parse_args(words)
    if (args.servers is None) == (args.files is None):
        parser.error("give either --servers or --files")
    if args.pipeline == "ingest" and args.feed is None:
        parser.error("ingest needs --feed")
    if args.max_per_trigger is None:
        files = args.pipeline == "ingest" or args.servers is None
        args.max_per_trigger = FILES_PER_TRIGGER if files else MESSAGES_PER_TRIGGER
    if args.max_per_trigger < 1:
        parser.error("--max-per-trigger must be positive")
    return args


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.getOrCreate()
    trigger = {"processingTime": args.every}
    by_topic = args.servers is not None
    if args.pipeline == "alarms":
        limit = {"max_per_trigger": args.max_per_trigger}
        source = (
            KafkaTopic(args.servers, args.topic, **limit)
            if by_topic
            else MessageFiles(args.files, **limit)
        )
        run_alarms(spark, source, args.base, trigger, args.delay, args.closed)
    else:
        publisher = (
            KafkaPublisher(args.servers, args.topic) if by_topic else FilePublisher(args.files)
        )
        run_ingest(spark, args.feed, publisher, args.base, trigger, args.max_per_trigger)


if __name__ == "__main__":
    main()
