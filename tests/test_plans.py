from pathlib import Path

import pytest
from conftest import at, rows

from aerometry.operators.combine import combine_sensors
from aerometry.plans import batch, realtime
from aerometry.plans.batch import result_preview, run_batch
from aerometry.plans.realtime import run_alarms, run_ingest
from aerometry.schemas import DEVICE, ENVELOPE, PAYLOAD, SENSORS, TIME
from aerometry.sinks.messages import FilePublisher
from aerometry.sources.messages import MessageFiles
from aerometry.sources.sensors import read_sensors, sensor_path

RESULTS = {
    "total_measurements": "deviceId string, total_measurements bigint",
    "hourly_measurements": "deviceId string, hour int, num_measurements bigint",
    "max_temperature": "deviceId string, max_temperature float",
    "min_atmospheric_pressure": "deviceId string, min_atmospheric_pressure float",
    "avg_pressure_by_device": "deviceId string, avg_atmospheric_pressure double",
    "stddev_humidity": "deviceId string, stddev_humidity float",
    "monthly_temperature": "month int, avg_temperature double, min float, max float",
    "monthly_air_quality": "year int, month int, avg double, min string, max string",
    "monthly_pressure": "year int, month int, avg double, min float, max float",
    "monthly_humidity": "year int, month int, avg double, min float, max float",
    "monthly_pm1": "year int, month int, avg double, min float, max float",
    "monthly_pm10": "year int, month int, avg double, min float, max float",
    "monthly_pm25": "year int, month int, avg double, min float, max float",
}


@pytest.fixture
def raw(base):
    """Eight CSV files: two readings of d1 at one instant, one of d2 an hour later."""
    for name, spec in SENSORS.items():
        lines = []
        for device, time, number in (
            ("d1", "2021-03-04 05:00:00", "10"),
            ("d1", "2021-03-04 05:00:00", "30"),
            ("d2", "2021-03-04 06:00:00", "50"),
        ):
            values = {DEVICE: device, TIME: time}
            lines.append(",".join(values.get(c, number) for c, _ in spec.columns))
        Path(sensor_path(spec, f"{base}/raw")).parent.mkdir(exist_ok=True)
        Path(sensor_path(spec, f"{base}/raw")).write_text("\n".join(lines))
    return f"{base}/raw"


def test_batch_writes_every_result(spark, base, raw):
    run_batch(spark, raw, f"{base}/out")
    read = {
        name: rows(spark.read.schema(schema).csv(f"{base}/out/{name}.csv"))
        for name, schema in RESULTS.items()
    }
    assert set(RESULTS) == set(batch.RESULTS)
    assert sorted(p.stem for p in Path(f"{base}/out").iterdir()) == sorted(RESULTS)
    assert read["total_measurements"] == [("d1", 256), ("d2", 1)]
    assert read["hourly_measurements"] == [("d1", 5, 256), ("d2", 6, 1)]
    assert read["max_temperature"] == [("d1", 30.0), ("d2", 50.0)]
    assert read["min_atmospheric_pressure"] == [("d1", 10.0), ("d2", 50.0)]
    assert read["avg_pressure_by_device"] == [("d1", 20.0), ("d2", 50.0)]
    assert read["stddev_humidity"] == [("d1", pytest.approx(14.142136)), ("d2", None)]
    assert read["monthly_temperature"] == [(3, 30.0, 10.0, 50.0)]
    assert read["monthly_air_quality"] == [(2021, 3, 30.0, "10", "50")]
    assert read["monthly_pm25"] == [(2021, 3, 30.0, 10.0, 50.0)]


def test_previews_leave_out_what_is_not_positive(spark, base, raw, capfd):
    run_batch(spark, raw, f"{base}/out", show=True)
    shown = spark.read.schema(RESULTS["stddev_humidity"]).csv(f"{base}/out/stddev_humidity.csv")
    assert [row.deviceId for row in result_preview("stddev_humidity", shown).collect()] == ["d1"]
    assert shown.count() == 2
    assert capfd.readouterr().out.count("+-") > 5


def test_second_batch_run_fails_unless_replacing(spark, base, raw):
    run_batch(spark, raw, f"{base}/out")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_batch(spark, raw, f"{base}/out")
    run_batch(spark, raw, f"{base}/out", mode="overwrite", columnar_root=f"{base}/columnar")
    assert spark.read.parquet(f"{base}/columnar/location.parquet").count() == 3


def test_combined_table_of_the_files(spark, raw):
    wide = combine_sensors(read_sensors(spark, raw))
    assert wide.columns == [
        "deviceId",
        "timestamp",
        "airQuality",
        "atmosphericPressure",
        "humidity",
        "name",
        "lat",
        "lon",
        "pm1",
        "pm10",
        "pm25",
        "temperature",
    ]
    assert wide.count() == 257


def test_alarm_pipeline(spark, base):
    text = '{"city": "Nis", "temperature": 5, "time": 1704067200}'
    data = spark.createDataFrame([(bytearray(text.encode()), at("00:00:00"))], ENVELOPE)
    data.write.parquet(f"{base}/in")
    run_alarms(spark, MessageFiles(f"{base}/in"), f"{base}/out", {"availableNow": True})
    spark.streams.resetTerminated()


def test_ingest_pipeline(spark, base):
    header = "time|temperature|humidity|pressure|pm1|pm2|pm10"
    body = f"{header}\n1|2|3|4|5|6|7"
    spark.createDataFrame([("d", body, at("00:00:00"), 1)], PAYLOAD).write.parquet(f"{base}/feed")
    publisher = FilePublisher(f"{base}/out")
    run_ingest(spark, f"{base}/feed", publisher, base, {"availableNow": True})
    assert spark.read.parquet(f"{base}/out").count() == 1


@pytest.mark.parametrize(
    "words",
    [
        ["alarms", "out"],
        ["alarms", "out", "--servers", "b", "--files", "f"],
        ["ingest", "out", "--files", "f"],
        ["alarms", "out", "--files", "f", "--max-per-trigger", "0"],
    ],
)
def test_missing_or_clashing_arguments_are_errors(words):
    with pytest.raises(SystemExit):
        realtime.arguments(words)


def test_micro_batches_are_bounded_unless_told_otherwise():
    by_files = realtime.arguments(["alarms", "out", "--files", "f", "--closed", "--delay", "1 hour"])
    assert (by_files.max_per_trigger, by_files.closed, by_files.delay) == (1000, True, "1 hour")
    by_topic = realtime.arguments(["alarms", "out", "--servers", "b"])
    assert by_topic.max_per_trigger == realtime.MESSAGES_PER_TRIGGER
