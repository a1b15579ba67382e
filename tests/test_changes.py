from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerometry.operators.changes import changed_readings, last_values, time_slices

SCHEMA = "deviceId string, seconds bigint, seq bigint, value string"


def frame(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumn("timestamp", F.timestamp_seconds("seconds")).drop("seconds")


def kept(df, **options):
    found = changed_readings(df, "value", ("timestamp", "seq"), **options)
    return rows(found, "deviceId", "seq", "value")


def expected(data, before=None):
    """The change filter said plainly, device by device."""
    last, out = dict(before or {}), []
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    for device, _, seq, value in order:
        if value is not None and last.get(device) != value:
            last[device] = value
            out.append((device, seq, value))
    return sorted(out, key=repr)


def test_returning_value_is_a_change(spark):
    data = [("d", i, i, v) for i, v in enumerate("AABA")]
    assert [v for _, _, v in kept(frame(spark, data))] == ["A", "B", "A"]


def test_devices_do_not_mix_and_missing_values_are_skipped(spark):
    data = [("d", 1, 1, "A"), ("e", 2, 2, "A"), ("d", 3, 3, None), ("d", 4, 4, "A")]
    data.append((None, 5, 5, "A"))
    assert kept(frame(spark, data)) == sorted(
        [("d", 1, "A"), ("e", 2, "A"), (None, 5, "A")], key=repr
    )


readings = st.lists(
    st.tuples(
        st.sampled_from(["d", "e", None]),
        st.sampled_from([0, 1, 59, 60, 3600, 3601, 86400, 200000, None]),
        st.sampled_from(["A", "B", None]),
    ),
    min_size=1,
    max_size=30,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(readings)
def test_cut_devices_give_the_same_result(spark, drawn):
    data = [(d, s, i, v) for i, (d, s, v) in enumerate(drawn)]
    df = frame(spark, data)
    want = expected(data)
    slices = time_slices("timestamp", "seq", hot_rows=3)
    assert kept(df, hot_rows=None) == want
    assert kept(df, slices=slices, hot_rows=3) == want
    remembered = {"d": "A", None: "B", "z": "A"}
    before = spark.createDataFrame(list(remembered.items()), "deviceId string, value string")
    want = expected(data, remembered)
    assert kept(df, before=before) == want
    assert kept(df, slices=slices, hot_rows=3, before=before) == want


def test_one_instant_is_cut_by_sequence(spark):
    """All readings of a device at one instant: only the sequence can cut them."""
    data = [("d", 7, i, "AB"[i // 10 % 2]) for i in range(200)]
    slices = time_slices("timestamp", "seq", hot_rows=8)
    assert kept(frame(spark, data), slices=slices, hot_rows=8) == expected(data)


def test_no_group_to_order_exceeds_the_limit(spark):
    """A device with a third of all rows is ordered in pieces below the limit."""
    limit = 500
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise((F.col("id") % 1000).cast("string"))
        .alias("deviceId"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
        F.col("id").alias("seq"),
        F.lit("A").alias("value"),
    )
    from aerometry.operators.changes import _cut_hot_groups

    cut, names = _cut_hot_groups(df, "deviceId", time_slices("timestamp", "seq", limit), limit)
    largest = cut.groupBy("deviceId", *names).count().agg(F.max("count")).first()[0]
    assert largest <= limit
    assert cut.count() == 30_000
    found = changed_readings(
        df, "value", ("timestamp", "seq"), time_slices("timestamp", "seq", limit), hot_rows=limit
    )
    assert found.groupBy("deviceId").count().where("count > 1").count() == 0


def test_last_values_prefer_new_readings(spark):
    df = frame(spark, [("d", 2, 2, "B"), ("d", 1, 1, "A"), ("e", 1, 1, None)])
    remembered = [("d", "X"), ("e", "Y"), ("f", "Z")]
    before = spark.createDataFrame(remembered, "deviceId string, value string")
    found = last_values(df, "value", ("timestamp", "seq"), before=before)
    assert rows(found) == [("d", "B"), ("e", "Y"), ("f", "Z")]


def test_last_values_may_count_a_missing_value(spark):
    df = frame(spark, [("d", 2, 2, None), ("d", 1, 1, "A")])
    before = spark.createDataFrame([("d", "X"), ("f", "Z")], "deviceId string, value string")
    found = last_values(df, "value", ("timestamp", "seq"), before=before, count_missing=True)
    assert rows(found) == [("d", None), ("f", "Z")]
