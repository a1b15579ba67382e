"""Copies of tables laid out for what is read from them: by calendar month, or in buckets of a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.schemas import KEY, TIME

# Partition columns of a copy by calendar month.
CALENDAR = ("year", "month")


def write_by_month(df: DataFrame, path: str, time: str = TIME, mode: str = "errorifexists") -> None:
    """A copy as parquet, one folder per year and month of ``time``; rows without a time have one too.

    Readers of a year skip the other years' files. Rows are rebalanced by month: adaptive
    execution writes a large month from several tasks and several small ones from one.
    """
    dated = df.withColumns({"year": F.year(time), "month": F.month(time)})
    balanced = dated.hint("rebalance", *CALENDAR)
    balanced.write.mode(mode).partitionBy(*CALENDAR).parquet(path)


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    """A copy by month, with its partition columns ``year`` and ``month``."""
    return spark.read.parquet(path)


def write_bucketed(
    tables: Mapping[str, DataFrame],
    prefix: str,
    buckets: int,
    key: Sequence[str] = KEY,
    path: str | None = None,
) -> dict[str, DataFrame]:
    """Copies as tables ``<prefix>_<name>``, cut and sorted by ``key``, and what reads them.

    Joins and groupings on the key find equal keys in equal buckets and move no rows.
    Each bucket is dealt to one task ahead of writing, so it is one file. The layout is
    known to the catalogue, not to the files; ``path`` places them outside the warehouse.
    """
    for name, df in tables.items():
        writer = df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key)
        if path is not None:
            writer = writer.option("path", f"{path}/{name}")
        writer.mode("overwrite").format("parquet").saveAsTable(f"{prefix}_{name}")
    return read_bucketed(next(iter(tables.values())).sparkSession, prefix, tuple(tables))


def read_bucketed(spark: SparkSession, prefix: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Bucketed tables by name."""
    return {name: spark.table(f"{prefix}_{name}") for name in names}
