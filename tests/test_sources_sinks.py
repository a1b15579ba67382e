from datetime import datetime
from pathlib import Path

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from aerometry.schemas import DEVICE, READING, READING_TO_SENSOR, SENSORS, TIME
from aerometry.session import scratch_path, shared_root, streaming_session
from aerometry.sinks.messages import FilePublisher, KafkaPublisher
from aerometry.sinks.tables import flatten_structs, preview, write_table
from aerometry.sources.feeds import (
    fan_in,
    read_device_directory,
    read_payload_files,
    read_payload_table,
)
from aerometry.sources.messages import KafkaTopic, MessageFiles, read_messages
from aerometry.sources.sensors import read_sensor, read_sensors, sensor_path


def write_text(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)


@pytest.mark.parametrize("name", SENSORS)
def test_every_sensor_file_reads_with_its_schema(spark, base, name):
    spec = SENSORS[name]
    sample = {DEVICE: "d1", TIME: "2021-05-06 07:08:09"}
    line = ",".join(sample.get(c, "1.5") for c, _ in spec.columns)
    write_text(sensor_path(spec, base), line + "\n")
    df = read_sensor(spark, name, base)
    assert df.schema == spec.schema
    row = df.first()
    assert row[DEVICE] == "d1" and row[TIME] == datetime(2021, 5, 6, 7, 8, 9)
    assert all(str(row[c]) == "1.5" for c in spec.values)


def test_csv_rows_that_do_not_fit(spark, base):
    write_text(
        f"{base}/humidity.csv",
        "d1,notatime,2.5\nd2,2021-01-01 00:00:00,x\nd3\nd4,2021-01-01 00:00:00,1.0,surplus\n"
        "d5,2021-01-01 00:00:00,NaN\n",
    )
    when = datetime(2021, 1, 1)
    found = rows(read_sensor(spark, "humidity", base))
    assert found[0] == ("d1", None, 2.5)
    assert found[1] == ("d2", when, None)
    assert found[2] == ("d3", None, None)
    assert found[3] == ("d4", when, 1.0)
    assert found[4][:2] == ("d5", when) and found[4][2] != found[4][2]


def test_tables_kept_as_parquet(spark, base):
    for name, spec in SENSORS.items():
        spark.createDataFrame([], spec.schema).write.parquet(sensor_path(spec, base, "parquet"))
    found = read_sensors(spark, base, "parquet")
    assert list(found) == list(SENSORS)
    assert all(found[name].schema == spec.schema for name, spec in SENSORS.items())


def test_reading_fields_map_onto_sensor_columns():
    columns = {c for spec in SENSORS.values() for c, _ in spec.columns}
    assert set(READING_TO_SENSOR.values()) <= columns
    assert set(READING_TO_SENSOR) | {DEVICE, "city"} == set(READING.fieldNames())


def test_device_directory(spark, base):
    write_text(f"{base}/one.txt", "id|name\n7|x|y\nnodelimiter\n\n8|\n|nine\n\"q|r\n")
    write_text(f"{base}/two.txt", "other header\n9|z\n")
    found = rows(read_device_directory(spark, base))
    assert found == sorted([("7",), ("8",), ("",), ('"q',), ("9",)], key=repr)


def test_payload_files(spark, base):
    write_text(f"{base}/deviceId=007/a.txt", "h|i\n1|2")
    write_text(f"{base}/deviceId=8/b.txt", "h|i\n3|4")
    found = read_payload_files(spark, base)
    assert rows(found, "deviceId", "body", "seq") == [
        ("007", "h|i\n1|2", "a.txt"),
        ("8", "h|i\n3|4", "b.txt"),
    ]
    stream = read_payload_files(spark, base, stream=True)
    assert stream.isStreaming and stream.columns == found.columns


def test_payload_table(spark, base):
    assert read_payload_table(spark, base, stream=True, maxFilesPerTrigger="1").isStreaming


def test_fan_in_keeps_duplicates(spark):
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    two = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(fan_in(one, two)) == [("a", 1), ("a", None), ("a", None)]


def test_topic_options():
    topic = KafkaTopic("broker:1", "readings", max_per_trigger=500)
    assert topic.options() == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "readings",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
    }
    assert KafkaPublisher("broker:1", "readings").options() == {
        "kafka.bootstrap.servers": "broker:1",
        "topic": "readings",
        "kafka.acks": "1",
    }


def test_message_files(spark, base):
    source = MessageFiles(base, max_per_trigger=1)
    assert source.options() == {"maxFilesPerTrigger": "1"}
    assert read_messages(spark, source).columns == ["value", "timestamp"]


def test_publishing_an_epoch_again_replaces_it(spark, base):
    publisher = FilePublisher(base)
    df = spark.createDataFrame([("a",)], "value string")
    for _ in range(2):
        publisher.publish(df, 3)
    publisher.publish(df, 4)
    assert rows(spark.read.parquet(base)) == [("a", 3), ("a", 4)]


def test_second_write_fails_unless_told_to_replace(spark, base):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    path = f"{base}/t.csv"
    write_table(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(df, path)
    write_table(df.where("v > 1"), path, mode="overwrite")
    assert spark.read.schema(df.schema).csv(path).count() == 0


def test_windows_are_flattened_for_text(spark, base):
    df = spark.createDataFrame(
        [((at("00:00:00"), at("00:00:30")), 1)],
        "window struct<start: timestamp, end: timestamp>, v int",
    )
    assert flatten_structs(df).columns == ["window_start", "window_end", "v"]
    write_table(df, f"{base}/w.csv")
    assert spark.read.csv(f"{base}/w.csv").count() == 1


def test_preview(spark):
    df = spark.range(100).select(F.col("id"))
    assert preview(df).count() == 20
    assert [r.id for r in preview(df, "id", rows=3).collect()] == [0, 1, 2]


def test_scratch_lies_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    assert scratch_path(spark, "x").startswith(f"{named}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_streaming_session_leaves_the_callers_settings_alone(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1234567")
    try:
        sibling = streaming_session(spark)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "RocksDB" in sibling.conf.get(name)
    assert sibling.conf.get("spark.sql.files.maxPartitionBytes") == "1234567"
    assert spark.conf.get(name) == before
