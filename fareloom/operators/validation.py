"""Checks on raw data before it is loaded: one pass for any number of months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.measures import percent_text, safe_divide
from fareloom.functions.months import Months, month_list, same_month

# Less than this share of rows inside the expected month makes a file invalid.
SMALLEST_MONTH_SHARE = 0.8

# The texts of the issues.
EMPTY_ISSUE = "DataFrame is empty — no rows to process"
MISSING_ISSUE = "Missing required column: {name}"
MONTH_ISSUE = "Only {share} of rows are within expected month {month}"


class ValidationError(ValueError):
    """Raw data is not fit to be loaded."""


def missing_required_columns(columns: list[str]) -> list[str]:
    """Required columns not among the given ones; needs no job."""
    return [name for name in schemas.REQUIRED_RAW_COLUMNS if name not in columns]


def _with_every_month(spark, report: DataFrame, months: Months) -> DataFrame:
    """Add the months asked for that have no row at all."""
    wanted = month_list(months)
    if wanted is None:
        return report
    spine = spark.createDataFrame([(month,) for month in wanted], "_execution_date string")
    return spine.join(report, "_execution_date", "left").withColumns(
        {"row_count": F.coalesce("row_count", F.lit(0))}
    )


def raw_month_counts(raw: DataFrame, months: Months = None) -> DataFrame:
    """Rows and rows inside the expected month, by ``_execution_date``.

    A row without a pickup time counts as outside. The grouping is reduced
    within each task, so one huge file moves a single row per task.
    """
    if "tpep_pickup_datetime" in raw.columns:
        inside = same_month(F.col("tpep_pickup_datetime"), F.col("_execution_date"))
        in_month = F.count_if(inside)
    else:
        in_month = F.lit(None).cast("long")
    counts = raw.groupBy("_execution_date").agg(
        F.count(F.lit(1)).alias("row_count"), in_month.alias("rows_in_month")
    )
    return _with_every_month(raw.sparkSession, counts, months).withColumn(
        "month_share", safe_divide(F.col("rows_in_month"), F.col("row_count"))
    )


def _issues(columns: list[str]) -> Column:
    """Array of issue texts for a row of ``raw_month_counts``."""
    found = [F.when(F.col("row_count") == 0, EMPTY_ISSUE)]
    found += [
        F.lit(MISSING_ISSUE.format(name=name)) for name in missing_required_columns(columns)
    ]
    before, after = MONTH_ISSUE.split("{share}")
    text = F.concat(
        F.lit(before),
        percent_text(F.col("month_share"), 1),
        F.lit(after.replace("{month}", "")),
        F.col("_execution_date"),
    )
    found.append(F.when(F.col("month_share") < SMALLEST_MONTH_SHARE, text))
    return F.array_compact(F.array(*found))


def validation_report(raw: DataFrame, months: Months = None) -> DataFrame:
    """One row per month: counts, the issues found, and whether it may be loaded.

    ``raw`` has ``_execution_date`` and ``_source_file`` beside the delivered
    columns; those two are not counted as columns of the file.
    """
    delivered = [name for name in raw.columns if name not in schemas.AUDIT.names]
    counts = raw_month_counts(raw, months)
    return counts.select(
        "_execution_date",
        "row_count",
        F.lit(len(delivered)).cast("long").alias("column_count"),
        "month_share",
        _issues(delivered).alias("issues"),
    ).withColumn("valid", F.size("issues") == 0)


def require_valid(report: DataFrame) -> None:
    """Raise if a month of a validation report is not valid (a row per month)."""
    bad = report.where(~F.col("valid")).collect()
    if bad:
        found = "; ".join(f"{row['_execution_date']}: {row['issues']}" for row in bad)
        raise ValidationError(f"raw data validation failed: {found}")
