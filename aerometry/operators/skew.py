"""Keeping the list of groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aerometry.session import scratch_path


def written_if_any(found: DataFrame, purpose: str) -> DataFrame | None:
    """The rows of a small search result as a written table; None if there are none.

    Most searches find nothing and then write nothing. The files of a written
    table give Spark its true size: a later join broadcasts it only if it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, so no
    hint is needed. They also cut the lineage: a lost executor does not repeat
    the search.
    """
    spark = found.sparkSession
    found.persist()
    try:
        if found.count() == 0:
            return None
        path = scratch_path(spark, purpose)
        found.write.parquet(path)
    finally:
        found.unpersist()
    return spark.read.schema(found.schema).parquet(path)
