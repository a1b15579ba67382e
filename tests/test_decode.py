from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerometry.functions.cities import assign_city
from aerometry.functions.payload import (
    accepted,
    field_map,
    parse_payloads,
    rejected,
    split_payload,
    strict_bigint,
    strict_double,
)
from aerometry.functions.readings import decode_readings, encode_readings, reading_from_json
from aerometry.schemas import CITIES, READING_VALUES

GOOD = "time|temperature|humidity|pressure|pm1|pm2|pm10\n1681000000|21.5|40|1001|1|2|3"


def decoded(spark, text, **options):
    df = spark.createDataFrame([(text,)], "value string")
    return df.select(reading_from_json(F.col("value"), **options).alias("r")).select("r.*").first()


def test_time_counts_seconds(spark):
    assert decoded(spark, '{"time": 1681000000}').time == datetime(2023, 4, 9, 0, 26, 40)
    assert decoded(spark, '{"time": "1681000000"}').time is None
    in_millis = decoded(spark, '{"time": 1681000000500}', time_unit="milliseconds")
    assert in_millis.time == datetime(2023, 4, 9, 0, 26, 40, 500000)
    with pytest.raises(ValueError):
        reading_from_json(F.lit(""), "hours")


def test_bad_fields_and_garbage(spark):
    row = decoded(spark, '{"deviceId": "d", "temperature": "x", "humidity": 5}')
    assert (row.deviceId, row.temperature, row.humidity) == ("d", None, 5.0)
    assert set(decoded(spark, "garbage").asDict().values()) == {None}


def test_some_fields_only(spark):
    text = '{"deviceId": "d", "city": "Nis", "time": 1681000000500, "temperature": 3}'
    row = decoded(spark, text, fields=("temperature", "city"))
    assert row.asDict() == {"temperature": 3.0, "city": "Nis"}
    row = decoded(spark, text, fields=("time",), time_unit="milliseconds")
    assert row.time == datetime(2023, 4, 9, 0, 26, 40, 500000)
    assert set(decoded(spark, "garbage", fields=("city",)).asDict().values()) == {None}
    with pytest.raises(ValueError):
        messages = spark.createDataFrame([(bytearray(b""),)], "value binary")
        decode_readings(messages, drop_malformed=True, fields=("city",))


def test_malformed_messages_stay_unless_dropped(spark):
    messages = spark.createDataFrame(
        [(bytearray(b"garbage"),), (bytearray(b'{"city": "Nis"}'),)], "value binary"
    )
    assert decode_readings(messages).count() == 2
    kept = decode_readings(messages, drop_malformed=True)
    assert rows(kept, "data.city") == [("Nis",)]


number = st.floats(allow_nan=False, allow_infinity=False, width=32)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(number, number, number, number, number, number), min_size=1, max_size=5))
def test_encode_then_decode_gives_the_reading_back(spark, numbers):
    data = [(f"d{i}", "Nis", 1681000000 + i, *values) for i, values in enumerate(numbers)]
    names = ["deviceId", "city", "time", *READING_VALUES]
    kinds = ["string", "string", "bigint"] + ["double"] * 6
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    df = spark.createDataFrame(data, schema)
    back = decode_readings(encode_readings(df)).select("data.*")
    expected = df.withColumn("time", F.timestamp_seconds("time"))
    assert rows(back, *names) == rows(expected, *names)


def test_non_finite_numbers_are_left_out(spark):
    df = spark.createDataFrame(
        [("d", "Nis", 1, float("nan"), float("inf"), 1.0, 1.0, 1.0, 1.0)],
        "deviceId string, city string, time bigint, pm1 double, pm2 double, pm10 double, "
        "pressure double, humidity double, temperature double",
    )
    text = encode_readings(df).select(F.col("value").cast("string")).first()[0]
    assert '"pm1"' not in text and '"pm2"' not in text and "NaN" not in text


def parsed(spark, *bodies):
    df = spark.createDataFrame(
        [(f"d{i}", body) for i, body in enumerate(bodies)], "deviceId string, body string"
    )
    return parse_payloads(df)


def test_payload_columns(spark):
    row = accepted(parsed(spark, GOOD)).first()
    assert (row.deviceId, row.reading_key, row.time) == ("d0", "1681000000", 1681000000)
    assert (row.temperature, row.humidity, row.pressure) == (21.5, 40.0, 1001.0)
    assert (row.pm1, row.pm2, row.pm10) == (1.0, 2.0, 3.0)


def test_surplus_values_and_repeated_headers(spark):
    lines = GOOD.split("\n")
    surplus = f"{lines[0]}\n{lines[1]}|9|9"
    repeated = f"{lines[0]}|pm1\n{lines[1]}|7"
    late_repeat = f"{lines[0]}|pm1\n{lines[1]}"
    found = rows(accepted(parsed(spark, surplus, repeated, late_repeat)), "deviceId", "pm1")
    assert found == [("d0", 1.0), ("d1", 7.0), ("d2", 1.0)]


def test_payload_map(spark):
    df = spark.createDataFrame([("a|b|a\n1|2|3|4",), ("a|b",)], "body string")
    maps = split_payload(df).select(field_map(F.col("_fields")).alias("m")).collect()
    assert [row.m for row in maps] == [{"a": "3", "b": "2"}, None]


def test_own_device_and_city_in_the_payload_are_ignored(spark):
    lines = GOOD.split("\n")
    row = accepted(parsed(spark, f"{lines[0]}|deviceId|city\n{lines[1]}|other|Paris")).first()
    assert row.deviceId == "d0" and "city" not in row.asDict()


def test_rejects_name_their_reason(spark):
    lines = GOOD.split("\n")
    bad_number = GOOD.replace("|3", "|abc")
    bodies = [lines[0], f"{lines[0]}\n17", bad_number, f"{lines[0]}\n17|1", "time|x\n1.5|2", None]
    found = rows(rejected(parsed(spark, *bodies)), "deviceId", "reject_reason")
    assert found == [
        ("d0", "no value line"),
        ("d1", "no separator in value line"),
        ("d2", "bad pm10"),
        ("d3", "missing pm1"),
        ("d4", "bad time"),
        ("d5", "no value line"),
    ]
    assert accepted(parsed(spark, *bodies)).count() == 0


def test_strict_numbers(spark):
    texts = ["5", "+5", "-5", " 5", "5 ", "1.5", "", "99999999999999999999", "5L", "5\r"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(strict_bigint(F.col("t"))).collect()]
    assert found == [5, 5, -5] + [None] * 7
    texts = ["1", ".5", "5.", "-1e3", "1.5d", " 1", "x", "", ".", "1.0\r"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(strict_double(F.col("t"))).collect()]
    assert found == [1.0, 0.5, 5.0, -1000.0] + [None] * 6
    infinite = spark.createDataFrame([("inf",), ("-Infinity",)], "t string")
    found = [r[0] for r in infinite.select(strict_double(F.col("t"))).collect()]
    assert found == [float("inf"), float("-inf")]


def test_city_is_stable_and_any_integer_has_one(spark):
    df = spark.range(-6, 12).select("id", assign_city(F.col("id")).alias("city"))
    found = dict(rows(df))
    assert all(found[i] == CITIES[i % 6] for i in range(-6, 12))
