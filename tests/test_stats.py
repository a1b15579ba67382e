import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aerometry.operators import stats


def frame(spark, data, column="temperature", kind="float"):
    df = spark.createDataFrame(data, f"deviceId string, t string, {column} {kind}")
    return df.select("deviceId", F.col("t").cast("timestamp").alias("timestamp"), column)


def test_device_statistics_keep_the_null_device(spark):
    df = frame(spark, [("a", None, 1.0), ("a", None, 3.0), (None, None, 5.0), ("b", None, None)])
    assert rows(stats.device_max(df, "temperature", "m")) == [("a", 3.0), ("b", None), (None, 5.0)]
    assert rows(stats.device_min(df, "temperature", "m")) == [("a", 1.0), ("b", None), (None, 5.0)]
    assert rows(stats.device_avg(df, "temperature", "m")) == [("a", 2.0), ("b", None), (None, 5.0)]
    both = stats.device_min_avg(df, "temperature", "low", "mean")
    assert rows(both) == [("a", 1.0, 2.0), ("b", None, None), (None, 5.0, 5.0)]


def test_result_types(spark):
    df = frame(spark, [("a", "2021-01-01", 1.0)])
    assert stats.device_max(df, "temperature", "m").dtypes[1] == ("m", "float")
    assert stats.device_stddev(df, "temperature", "m").dtypes[1] == ("m", "float")
    assert stats.device_avg(df, "temperature", "m").dtypes[1] == ("m", "double")
    assert stats.monthly_stats(df, "temperature", "t").dtypes == [
        ("year", "int"),
        ("month", "int"),
        ("avg_t", "double"),
        ("min_t", "float"),
        ("max_t", "float"),
    ]


def test_single_reading_has_no_deviation_and_is_not_positive(spark):
    df = frame(spark, [("a", None, 1.0), ("b", None, 1.0), ("b", None, 3.0)])
    deviation = stats.device_stddev(df, "temperature", "s")
    assert rows(deviation.where("deviceId = 'a'")) == [("a", None)]
    kept = rows(stats.positive_only(deviation, "s"))
    assert [name for name, _ in kept] == ["b"]
    assert kept[0][1] == pytest.approx(math.sqrt(2), rel=1e-6)


def test_positive_only_keeps_nan(spark):
    df = frame(spark, [("a", None, float("nan")), ("b", None, 0.0), ("c", None, -1.0)])
    assert [r[0] for r in rows(stats.positive_only(df, "temperature"))] == ["a"]


def test_monthly_temperature_bounds_and_year(spark):
    df = frame(
        spark,
        [
            ("a", "2021-01-01 00:00:00", 10.0),
            ("a", "2021-01-31 23:59:59", 20.0),
            ("a", "2021-12-31 23:59:59", -5.0),
            ("a", "2021-02-01 00:00:00", -100.0),
            ("a", "2021-02-01 00:00:00", 100.0),
            ("a", "2021-02-01 00:00:00", float("nan")),
            ("a", "2022-01-01 00:00:00", 1.0),
            ("a", "2020-12-31 23:59:59", 1.0),
            ("a", None, 1.0),
        ],
    )
    result = [tuple(r) for r in stats.monthly_temperature(df, 2021).collect()]
    assert result == [(1, 15.0, 10.0, 20.0), (12, -5.0, -5.0, -5.0)]


def test_year_range_reaches_the_scan(spark, base):
    frame(spark, [("a", "2021-01-01", 1.0)]).write.parquet(f"{base}/t")
    df = stats.in_year(spark.read.parquet(f"{base}/t"), 2021)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_year_range_of_zoneless_times(spark):
    df = spark.sql("select timestamp_ntz '2021-06-01 00:00:00' as timestamp, 1 as x")
    assert stats.in_year(df, 2021).count() == 1
    assert stats.in_year(df, 2020).count() == 0


def test_air_quality_is_text(spark):
    df = frame(
        spark,
        [("a", "2021-01-01", v) for v in ("10", "9", "BAD", None)],
        "airQuality",
        "string",
    )
    assert rows(stats.monthly_air_quality(df)) == [(2021, 1, 9.5, "10", "BAD")]
    assert rows(stats.monthly_air_quality(df, numeric_range=True)) == [(2021, 1, 9.5, 9.0, 10.0)]


def test_monthly_keeps_readings_without_time(spark):
    df = frame(spark, [("a", "2021-03-01", 1.0), ("a", None, 4.0)])
    assert rows(stats.monthly_stats(df, "temperature", "t")) == [
        (2021, 3, 1.0, 1.0, 1.0),
        (None, None, 4.0, 4.0, 4.0),
    ]
