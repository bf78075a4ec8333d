"""Raw monthly files: scan, declared schema, audit columns, skipping of loaded files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schemas
from fareloom.functions.months import Months, at, month_list

# Fixed value: where a month's file lands under the landing root.
FILE_PATTERN = "yellow/{month}/yellow_tripdata_{month}.parquet"

_ANY_MONTH = "[0-9][0-9][0-9][0-9]-[0-9][0-9]"


class MissingColumnsError(ValueError):
    """Raw data lacks columns it must have."""


def file_name(month: str, pattern: str = FILE_PATTERN) -> str:
    """Name of a month's file relative to the landing root."""
    return pattern.format(month=month)


def landing_glob(root: str, months: Months = None, pattern: str = FILE_PATTERN) -> str:
    """One glob for the files of the months, so that they are read as one scan."""
    wanted = month_list(months)
    if wanted is None:
        choice = _ANY_MONTH
    elif len(wanted) == 1:
        choice = wanted[0]
    else:
        choice = "{" + ",".join(wanted) + "}"
    return f"{root.rstrip('/')}/{pattern.format(month=choice)}"


def relative_to(root: str, path: Column) -> Column:
    """Path below the landing root."""
    return F.substring_index(path, root.rstrip("/").split("://")[-1] + "/", -1)


def source_month(source_file: Column, pattern: str = FILE_PATTERN) -> Column:
    """The month in a relative path, at its first place in the pattern."""
    before = pattern.split("{month}")[0]
    return F.regexp_extract(source_file, rf"^\Q{before}\E(\d{{4}}-\d{{2}})", 1)


def scan_raw_trips(
    spark: SparkSession,
    root: str,
    months: Months = None,
    pattern: str = FILE_PATTERN,
    schema: T.StructType | None = schemas.RAW_TRIPS,
) -> DataFrame:
    """Raw rows of some or all months, with ``_source_file`` and ``_execution_date``.

    Both come from the path of the file a row was read from. ``schema=None``
    takes the columns as the files have them, to be conformed later.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.parquet(landing_glob(root, months, pattern))
    source = relative_to(root, F.col("_metadata.file_path"))
    return raw.select(
        "*",
        source.alias("_source_file"),
        source_month(source, pattern).alias("_execution_date"),
    )


def normalize_column_names(frame: DataFrame) -> DataFrame:
    """Trim blanks around column names; letters keep their case."""
    return frame.toDF(*[name.strip() for name in frame.columns])


def add_audit_columns(
    frame: DataFrame,
    month: str | Column,
    source_file: str | Column,
    ingested_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Add when, from which file and for which month a row was ingested."""

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    when = ingested_at
    if not isinstance(when, Column):
        when = F.localtimestamp() if when is None else at(when)
    return frame.withColumns(
        {
            "_ingested_at": when.cast("timestamp_ntz"),
            "_source_file": column(source_file),
            "_execution_date": column(month),
        }
    )


def conform_bronze_schema(
    frame: DataFrame,
    schema: T.StructType = schemas.BRONZE_TRIPS,
    required: tuple[str, ...] = schemas.REQUIRED_RAW_COLUMNS,
) -> DataFrame:
    """The declared columns in order and type; further columns are left out.

    Names match without regard to case. A missing required column is an error,
    any other missing column is NULL.
    """
    present = {name.lower(): name for name in frame.columns}
    missing = [name for name in required if name.lower() not in present]
    if missing:
        raise MissingColumnsError(f"missing required columns: {', '.join(missing)}")

    def conformed(field: T.StructField) -> Column:
        source = present.get(field.name.lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        return value.cast(field.dataType).alias(field.name)

    return frame.select([conformed(field) for field in schema.fields])


def skip_loaded_files(files: DataFrame, bronze: DataFrame) -> DataFrame:
    """Files (``_source_file``, ``_execution_date``, ...) no row of bronze came from.

    The names in bronze are made distinct first, so the one column is reduced
    within each task and a file with most of the rows costs no more than another.
    """
    loaded = bronze.select("_source_file").where(F.col("_source_file").isNotNull()).distinct()
    return files.join(loaded, "_source_file", "left_anti")
