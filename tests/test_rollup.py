from conftest import at, rows
from pyspark.sql import functions as F

from aerometry.functions.readings import decode_readings
from aerometry.operators.rollup import (
    alarm_cities,
    alarm_notice,
    change_notice,
    city_temperature,
    low_temperature,
    temperature_changes,
    window_rollup,
)
from aerometry.schemas import ENVELOPE, READING_VALUES


def messages(spark, data):
    """Envelopes of (time of day, JSON text)."""
    return spark.createDataFrame([(bytearray(text.encode()), at(t)) for t, text in data], ENVELOPE)


def reading(city, temperature):
    return f'{{"city": "{city}", "temperature": {temperature}}}'


def averages(spark, data):
    df = spark.createDataFrame(
        [((at(t), at(t)), city, a) for t, city, a in data],
        "window struct<start: timestamp, end: timestamp>, city string, avg_temperature double",
    )
    return df


def test_rollup_columns_and_values(spark):
    df = decode_readings(
        messages(
            spark,
            [
                ("00:00:00", '{"pm1": 1, "temperature": 10}'),
                ("00:00:29", '{"pm1": 3}'),
                ("00:00:30", '{"pm1": 5}'),
                ("00:00:31", "garbage"),
            ],
        )
    )
    result = window_rollup(df)
    names = [f"{how}_{v}" for how in ("avg", "max", "min") for v in READING_VALUES]
    assert result.columns == ["window", *names]
    assert rows(result, "window.start", "avg_pm1", "max_pm1", "min_pm1", "avg_temperature") == [
        (at("00:00:00"), 2.0, 3.0, 1.0, 10.0),
        (at("00:00:30"), 5.0, 5.0, 5.0, None),
    ]


def test_malformed_messages_group_under_no_city(spark):
    data = [("00:00:00", "garbage"), ("00:00:01", reading("Nis", 5))]
    df = decode_readings(messages(spark, data))
    assert rows(city_temperature(df), "city", "avg_temperature") == [("Nis", 5.0), (None, None)]


def test_low_temperature_is_strict_and_ignores_missing_means(spark):
    data = [("00:00:00", "a", 20.0), ("00:00:00", "b", 19.9), ("00:00:00", "c", None)]
    assert rows(low_temperature(averages(spark, data)), "city") == [("b",)]


def test_change_alarm(spark):
    data = averages(
        spark,
        [
            ("00:01:00", "a", 15.0),
            ("00:00:00", "a", 25.0),
            ("00:01:30", "a", 15.0),
            ("00:02:00", "a", 24.9),
            ("00:00:00", "b", 99.0),
            ("00:00:00", "c", 1.0),
            ("00:00:30", "c", None),
            ("00:01:00", "c", 50.0),
        ],
    )
    found = temperature_changes(data)
    columns = ("window.start", "city", "temperature_change")
    assert rows(found, *columns) == [(at("00:01:00"), "a", 10.0)]
    assert rows(change_notice(found)) == [
        ("Temperature change: the mean in a moved by 10.0 since the window before",)
    ]


def test_notices_name_each_city_once(spark):
    data = averages(
        spark, [("00:00:00", "a", 1.0), ("00:00:30", "a", 2.0), ("00:00:00", None, 3.0)]
    )
    assert rows(alarm_cities(data)) == [("a",), (None,)]
    assert rows(alarm_notice(data, 12.5)) == [
        ("Low temperature: the mean in a is below 12.5",),
        ("Low temperature: the mean in unknown city is below 12.5",),
    ]
    assert alarm_notice(data.where(F.lit(False))).count() == 0


def test_change_alarm_of_a_long_history_is_cut(spark):
    data = [
        (f"{i // 120:02d}:{i // 2 % 60:02d}:{i % 2 * 30:02d}", "a", float(i * i % 50))
        for i in range(600)
    ]
    df = averages(spark, data)
    cut = temperature_changes(df, hot_rows=50)
    assert rows(cut) == rows(temperature_changes(df))
    assert cut.count() > 100


def test_change_alarm_across_the_turn_of_a_year(spark):
    df = spark.sql(
        """select named_struct('start', t, 'end', t) as window, 'a' as city, x as avg_temperature
        from values (timestamp '2023-12-31 23:59:30', 10d), (timestamp '2024-01-01 00:00:00', 30d),
                    (timestamp '2025-05-05 00:00:00', 31d), (timestamp '2026-01-01 00:00:00', 0d)
             as v(t, x)"""
    )
    found = rows(temperature_changes(df), F.year("window.start"), "temperature_change")
    assert found == [(2024, 20.0), (2026, 31.0)]


def test_change_alarm_aggregates_once(spark, base):
    """The years' last means come from the same shuffled averages, not a second pass."""
    data = messages(spark, [("00:00:00", reading("Nis", 5))])
    data.write.parquet(f"{base}/in")
    stored = decode_readings(spark.read.parquet(f"{base}/in"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        changes = temperature_changes(city_temperature(stored))
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan
