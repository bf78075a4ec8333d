"""What is known of files before they are read: landed ones, and the days in bronze."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.months import Months, at, in_months
from fareloom.sources.landing import FILE_PATTERN, landing_glob, relative_to, source_month
from fareloom.sources.tables import Warehouse

LANDED = "_source_file string, _execution_date string, bytes long, rows long, landed_at timestamp_ntz"
FILE_DAYS = "file string, day date, rows long"


def _table(warehouse: Warehouse, name: str, schema: str) -> DataFrame:
    """A table of the ledger; empty before its first row."""
    try:
        return warehouse.spark.read.schema(schema).parquet(warehouse.path("metadata", name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return warehouse.spark.createDataFrame([], schema)


def _append(warehouse: Warehouse, name: str, rows: DataFrame) -> None:
    rows.hint("rebalance").write.mode("append").parquet(warehouse.path("metadata", name))


# Landed files


def landed_files(warehouse: Warehouse) -> DataFrame:
    """Files that were loaded into bronze, with their size and rows."""
    return _table(warehouse, "landed_files", LANDED)


def delivered_files(
    spark: SparkSession, root: str, months: Months = None, pattern: str = FILE_PATTERN
) -> DataFrame:
    """Files in the landing folder, listed and not opened: path, size, month.

    A delivery may be one file or a folder of files.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(landing_glob(root, months, pattern))
        .select(F.col("path"), F.col("length").alias("bytes"))
    )
    source = relative_to(root, F.col("path"))
    return found.select(
        "path", source.alias("_source_file"), source_month(source, pattern).alias("_execution_date"), "bytes"
    ).where(in_months(F.col("_execution_date"), months))


def new_files(warehouse: Warehouse, delivered: DataFrame) -> DataFrame:
    """Delivered files that the ledger does not name."""
    return delivered.join(landed_files(warehouse).select("_source_file").distinct(), "_source_file", "left_anti")


def record_landed(warehouse: Warehouse, files: DataFrame, when: dt.datetime) -> None:
    """Enter loaded files: ``_source_file, _execution_date, bytes, rows``."""
    rows = files.select("_source_file", "_execution_date", "bytes", F.col("rows").cast("long"), at(when).alias("landed_at"))
    _append(warehouse, "landed_files", rows)


def rows_of_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Rows of Parquet files from their footers: ``_source_file, rows``."""
    source = relative_to(root, F.col("_metadata.file_path"))
    return spark.read.parquet(*paths).groupBy(source.alias("_source_file")).agg(F.count(F.lit(1)).alias("rows"))


def enter_bronze_files(warehouse: Warehouse, when: dt.datetime) -> None:
    """Enter files of rows that were loaded before there was a ledger."""
    loaded = warehouse.bronze_trips().where(F.col("_source_file").isNotNull())
    counted = loaded.groupBy("_source_file", "_execution_date").agg(F.count(F.lit(1)).alias("rows"))
    known = landed_files(warehouse).select("_source_file").distinct()
    missing = counted.join(known, "_source_file", "left_anti").withColumn("bytes", F.lit(None).cast("long"))
    record_landed(warehouse, missing, when)


# Days held by the files of bronze


def file_days(warehouse: Warehouse) -> DataFrame:
    """Which days' pickups each file of bronze holds; a NULL day stands for no time."""
    return _table(warehouse, "bronze_file_days", FILE_DAYS)


def _bronze_root(warehouse: Warehouse) -> str:
    return warehouse.path("bronze", "trips")


def index_bronze(warehouse: Warehouse) -> int:
    """Enter the days of files not entered yet; returns how many files these are.

    Of new files only the pickup time is read; files that are known are only listed.
    It may run again after a failure: a file is entered in one write with all its days.
    """
    spark, root = warehouse.spark, _bronze_root(warehouse)
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    listed = listed.select("path", relative_to(root, F.col("path")).alias("file"))
    known = file_days(warehouse).select("file").distinct()
    paths = [row["path"] for row in listed.join(known, "file", "left_anti").select("path").collect()]
    if paths:
        day = F.to_date("tpep_pickup_datetime")
        file = relative_to(root, F.col("_metadata.file_path"))
        days = (
            spark.read.parquet(*paths)
            .groupBy(file.alias("file"), day.alias("day"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        _append(warehouse, "bronze_file_days", days)
    return len(paths)


def files_of_days(warehouse: Warehouse, rows: DataFrame) -> list[str]:
    """Files of bronze that hold a day on which one of the rows was picked up.

    Days are matched one by one, so a stray row decades away opens the file of that
    day and not all between. What comes to the driver are names of files to be read.
    """
    staged = rows.select(F.to_date("tpep_pickup_datetime").alias("day")).distinct()
    held = file_days(warehouse)
    files = held.join(staged, held["day"].eqNullSafe(staged["day"]), "left_semi").select("file").distinct()
    root = _bronze_root(warehouse)
    return [f"{root}/{row['file']}" for row in files.orderBy("file").collect()]
