import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("aerometry-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def at(text):
    """A UTC time of 2024-01-01, given as ``HH:MM:SS``."""
    return datetime.fromisoformat(f"2024-01-01T{text}")


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(row) for row in found), key=repr)
