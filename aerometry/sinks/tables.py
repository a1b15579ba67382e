"""Result tables and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerometry.session import delete_tree

PREVIEW_ROWS = 20

# Partition columns of a table that is kept by day.
DATE, VERSION = "_date", "_version"

# What is told of a row while changed and known rows of a key are together.
_NEW, _ANY_NEW, _ANY_KNOWN = "_new", "_any_new", "_any_known"


def flatten_structs(df: DataFrame) -> DataFrame:
    """Replace each struct column by its fields, as text formats hold no structs.

    ``window`` becomes ``window_start`` and ``window_end``.
    """
    columns = []
    for column in df.schema:
        if isinstance(column.dataType, T.StructType):
            columns += [
                F.col(f"{column.name}.{name}").alias(f"{column.name}_{name}")
                for name in column.dataType.fieldNames()
            ]
        else:
            columns.append(F.col(column.name))
    return df.select(*columns)


def write_table(
    df: DataFrame, path: str, file_format: str = "csv", mode: str = "errorifexists"
) -> None:
    """Write a result as a directory of files; CSV has no header.

    A second run fails unless ``mode`` says "overwrite".
    """
    if file_format == "csv":
        df = flatten_structs(df)
    df.write.mode(mode).format(file_format).save(path)


def replace_table(
    df: DataFrame, path: str, version: int, file_format: str = "parquet"
) -> None:
    """Replace a result so that readers always see a whole one.

    The version is written to a folder of its own; then a pointer is moved to it in
    one step. The version before stays for those who read it just now, older ones go.
    Writing a version again replaces it.
    """
    write_table(df, f"{path}/version={version}", file_format, "overwrite")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    configuration = spark._jsc.hadoopConfiguration()
    pointer, fresh = hadoop.Path(f"{path}/current.txt"), hadoop.Path(f"{path}/next.txt")
    stream = pointer.getFileSystem(configuration).create(fresh, True)
    stream.writeBytes(str(version))
    stream.close()
    overwrite = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = [o for o in overwrite.getEnumConstants() if o.toString() == "OVERWRITE"][0]
    hadoop.FileContext.getFileContext(pointer.toUri(), configuration).rename(fresh, pointer, options)
    if version > 1:
        delete_tree(spark, f"{path}/version={version - 2}")


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the version that a replaced table now points to."""
    pointer = spark.read.schema("version string").text(f"{path}/current.txt").first()
    return f"{path}/version={pointer['version']}"


def merge_days(
    changed: DataFrame,
    path: str,
    version: int,
    key: list[str],
    time: Column,
    only_known: Column | None = None,
) -> None:
    """Put changed rows into a table that is kept by day; other days are not touched.

    A day is written whole, as a partition of its date and the version: its rows of the
    version before, those with a changed ``key`` replaced. Readers take the latest
    version of each day, so they see a day before or after a change, and a version
    that is written again starts from the same rows. Rows marked ``only_known`` are
    left out unless the table has their key. Of older versions one stays.
    """
    spark = changed.sparkSession
    dated = changed.withColumn(DATE, F.date_format(time, "yyyy-MM-dd"))
    kept = {day: [v for v in versions if v < version] for day, versions in _days(spark, path).items()}
    before = {day: max(versions) for day, versions in kept.items() if versions}
    dates = [row[DATE] for row in dated.select(DATE).distinct().collect()]
    touched = {day: before[day] for day in dates if day in before}
    merged = dated
    if touched:
        merged = _replaced(_read_days(spark, path, touched), dated, [DATE, *key], only_known)
    elif only_known is not None:
        merged = dated.where(~only_known)
    (
        merged.withColumn(VERSION, F.lit(version))
        .repartition(DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE, VERSION)
        .parquet(path)
    )
    for day in touched:
        for old_version in kept[day]:
            if old_version < touched[day]:
                delete_tree(spark, f"{path}/{DATE}={day}/{VERSION}={old_version}")


def _replaced(
    known: DataFrame, changed: DataFrame, key: list[str], only_known: Column | None
) -> DataFrame:
    """Known rows, those with a changed key replaced; NULL keys are equal.

    Both meet by key in one union, so ``changed`` occurs once in the plan. In a join
    with itself Spark renames its columns, and may then not find a micro-batch that is
    kept and run the stream's state again.
    """
    if only_known is not None:
        changed = changed.where(only_known.isNotNull())
    both = changed.withColumn(_NEW, F.lit(True)).unionByName(
        known.select(*changed.columns).withColumn(_NEW, F.lit(False))
    )
    same = Window.partitionBy(*key)
    both = both.withColumns(
        {_ANY_NEW: F.bool_or(_NEW).over(same), _ANY_KNOWN: F.bool_or(~F.col(_NEW)).over(same)}
    )
    wanted = F.lit(True) if only_known is None else ~only_known | F.col(_ANY_KNOWN)
    kept = both.where(F.when(F.col(_NEW), wanted).otherwise(~F.col(_ANY_NEW)))
    return kept.drop(_NEW, _ANY_NEW, _ANY_KNOWN)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table kept by day, of each day's latest version."""
    latest = {day: max(versions) for day, versions in _days(spark, path).items()}
    return _read_days(spark, path, latest).drop(DATE, VERSION)


def _read_days(spark: SparkSession, path: str, versions: dict[str, int]) -> DataFrame:
    folders = [f"{path}/{DATE}={day}/{VERSION}={version}" for day, version in versions.items()]
    return spark.read.option("basePath", path).parquet(*folders).withColumn(
        DATE, F.date_format(DATE, "yyyy-MM-dd")
    )


def _days(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The versions of every day, by the names of the table's folders."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}=*/{VERSION}=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {}
    for status in files.globStatus(pattern) or []:
        folder = status.getPath()
        day = folder.getParent().getName().partition("=")[2]
        found.setdefault(day, []).append(int(folder.getName().partition("=")[2]))
    return found


def preview(df: DataFrame, *order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows for a look at a result; with ``order`` always the same ones."""
    return df.orderBy(*order).limit(rows) if order else df.limit(rows)
