from functools import reduce

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerometry.operators.combine import (
    combine_sensors,
    dealt_rows,
    hot_keys,
    hourly_measurements,
    key_counts,
    key_counts_long,
    total_measurements,
)
from aerometry.schemas import KEY

SMALL = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def instant(spark, data):
    """Rows of (device, hour or None, value) as a frame with timestamps of one day."""
    return [(d, None if h is None else f"2024-01-01 {h:02d}:00:00", v) for d, h, v in data]


def tables_of(spark, contents):
    made = {}
    for name, data in contents.items():
        data = [(d, h, None if v is None else float(v)) for d, h, v in data]
        df = spark.createDataFrame(instant(spark, data), f"deviceId string, t string, {name} double")
        made[name] = df.select("deviceId", F.col("t").cast("timestamp").alias("timestamp"), name)
    return made


def joined(tables):
    """The combined table as a plain chain of full outer joins, filtered afterwards."""
    wide = reduce(lambda a, b: a.join(b, list(KEY), "outer"), tables.values())
    return wide.where("deviceId is not null and timestamp is not null")


reading = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from([0, 1, None]),
    st.sampled_from([1.5, 0.0, -0.0, float("nan"), None]),
)
three_tables = st.fixed_dictionaries(
    {name: st.lists(reading, max_size=8) for name in ("x", "y", "z")}
)


@SMALL
@given(three_tables)
def test_combining_equals_outer_join_chain(spark, contents):
    tables = tables_of(spark, contents)
    expected = joined(tables)
    columns = expected.columns
    # Written out, so that NaN equals NaN and zeros of either sign differ.
    want = list(map(repr, rows(expected)))
    assert list(map(repr, rows(combine_sensors(tables), *columns))) == want
    for hot_rows in (1, 3):
        found = rows(combine_sensors(tables, hot_rows=hot_rows), *columns)
        assert list(map(repr, found)) == want


@SMALL
@given(three_tables)
def test_counts_equal_join_then_count(spark, contents):
    tables = tables_of(spark, contents)
    counts = key_counts(tables)
    wide = joined(tables)
    assert rows(total_measurements(counts)) == rows(wide.groupBy("deviceId").count())
    by_hour = wide.groupBy("deviceId", F.hour("timestamp").alias("hour")).count()
    assert rows(hourly_measurements(counts)) == rows(by_hour)


def test_duplicates_multiply_and_null_keys_vanish(spark):
    tables = tables_of(
        spark,
        {
            "x": [("a", 0, 1), ("a", 0, 2), (None, 0, 1), ("a", None, 1)],
            "y": [("a", 0, 1), ("a", 0, 2), ("a", 0, 3), (None, 0, 1)],
            "z": [("a", 0, 1), ("b", 5, 1), ("b", 5, 1)],
        },
    )
    totals = rows(total_measurements(key_counts(tables)))
    assert totals == [("a", 6), ("b", 2)]


def test_long_table_counts_equal_separate_tables(spark):
    data = [("a", 0, 0), ("a", 0, 0), ("a", 0, 1), ("b", 1, 1), (None, 1, 0)]
    long = spark.createDataFrame(
        instant(spark, data), "deviceId string, t string, sensor int"
    ).withColumn("timestamp", F.col("t").cast("timestamp"))
    counts = key_counts_long(long, F.col("sensor"), ["x", "y"])
    assert rows(total_measurements(counts)) == [("a", 2), ("b", 1)]


def test_copies_of_one_row_come_back_whole(spark):
    """A third of the rows being one row: counted, cut into parts, and returned."""
    tables = {
        "x": spark.range(3000).select(
            F.when(F.col("id") < 1000, "hot")
            .otherwise(F.col("id").cast("string"))
            .alias("deviceId"),
            F.timestamp_seconds(F.lit(0)).alias("timestamp"),
            F.lit(7).alias("x"),
        ),
        "y": spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3)], "deviceId string, y int")
        .withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
        .select("deviceId", "timestamp", "y"),
    }
    wide = combine_sensors(tables, hot_rows=100)
    found = wide.groupBy(
        F.when(F.col("deviceId") == "hot", "hot").otherwise("cold").alias("kind"), "x", "y"
    ).count()
    assert rows(found) == rows(
        spark.createDataFrame(
            [
                ("hot", 7, 1, 1000),
                ("hot", 7, 2, 1000),
                ("cold", 7, None, 2000),
                ("cold", None, 3, 1),
            ],
            "kind string, x int, y int, count bigint",
        )
    )


def test_hot_key_spreads_over_tasks(spark):
    """Different rows of one hot key end up in many partitions, not in one."""
    tables = {
        "x": spark.range(20_000).select(
            F.lit("hot").alias("deviceId"),
            F.timestamp_seconds(F.lit(0)).alias("timestamp"),
            F.col("id").alias("x"),
        ),
        "y": spark.range(2).select(
            F.lit("hot").alias("deviceId"),
            F.timestamp_seconds(F.lit(0)).alias("timestamp"),
            F.col("id").alias("y"),
        ),
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = combine_sensors(tables, hot_rows=500)
        per_task = wide.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = [row["count"] for row in per_task]
    assert sum(sizes) == 40_000
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_wide_rows_are_not_shuffled_again(spark):
    """One exchange for the keys and one per table, however many tables there are."""
    tables = tables_of(spark, {name: [("a", 0, 1)] for name in ("u", "v", "w", "x", "y")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = combine_sensors(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 + len(tables)


def test_product_beyond_bigint_is_an_error(spark):
    counts = spark.createDataFrame(
        [("a", 2**40, 2**40)], "deviceId string, n_x bigint, n_y bigint"
    )
    with pytest.raises(Exception, match="exceed bigint"):
        total_measurements(counts).collect()


def test_grid_keeps_cells_small_and_copies_few(spark):
    """One key of 1,000 x 1,000 rows: no cell above the limit, copies far below the output."""
    at = F.timestamp_seconds(F.lit(0)).alias("timestamp")
    tables = {
        name: spark.range(1000).select(F.lit("hot").alias("deviceId"), at, F.col("id").alias(name))
        for name in ("x", "y")
    }
    hot = hot_keys(key_counts(tables), list(tables), KEY, 500)
    dealt = {name: dealt_rows(df, hot, name, list(tables), KEY) for name, df in tables.items()}
    copies = sum(df.count() for df in dealt.values())
    cells = dealt["x"].join(dealt["y"], [*KEY, "_cell"]).groupBy("_cell").count()
    assert cells.agg(F.max("count")).first()[0] <= 500
    assert copies <= 100_000
    assert combine_sensors(tables, hot_rows=500).count() == 1_000_000


def test_three_large_tables_share_the_split(spark):
    """The product of two tables alone exceeds the limit; all three are cut."""
    at = F.timestamp_seconds(F.lit(0)).alias("timestamp")
    tables = {
        name: spark.range(n).select(F.lit("hot").alias("deviceId"), at, F.col("id").alias(name))
        for name, n in (("x", 30), ("y", 25), ("z", 20), ("w", 0))
    }
    hot = hot_keys(key_counts(tables), list(tables), KEY, 64).first()
    assert (hot["_chunk_x"], hot["_chunk_y"], hot["_chunk_z"], hot["_chunk_w"]) == (4, 4, 4, 1)
    wide = combine_sensors(tables, hot_rows=64)
    assert wide.count() == 15_000 and wide.distinct().count() == 15_000


def test_tables_are_read_twice_where_nothing_is_hot(spark):
    tables = {
        name: spark.range(5).select(
            F.col("id").cast("string").alias("deviceId"),
            F.timestamp_seconds("id").alias("timestamp"),
            F.col("id").alias(name),
        )
        for name in ("x", "y")
    }
    plan = combine_sensors(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 2
