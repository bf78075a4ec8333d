"""Data-quality checks: all checks of a layer in one pass over its table.

Each check adds two aggregates to a single grouping by month; status, rate and
text are computed from them in the same plan, one row per month and check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.labels import valid_zone
from fareloom.functions.measures import percent_text
from fareloom.functions.months import Months, in_months, month_list, month_text
from fareloom.operators.daily import gold_month_stats, stamp
from fareloom.operators.trips import LONGEST_MINUTES, SHORTEST_MINUTES

PASSED, WARNING, FAILED = "PASSED", "WARNING", "FAILED"
LAYERS = ("bronze", "silver", "gold")

MIN_BRONZE_ROWS = 1_000
MIN_DAYS = 25
MIN_MONTH_TRIPS = 1_000

RESULT_COLUMNS = (
    "execution_date",
    "check_name",
    "layer",
    "table_name",
    "status",
    "rows_tested",
    "rows_failed",
    "failure_rate",
    "threshold",
    "details",
)


class QualityGateError(RuntimeError):
    """A check failed, or a month has too few trips."""


@dataclass(frozen=True)
class Check:
    """A check of a layer table.

    ``bad`` says which rows fail, given the time of the check. More than
    ``threshold`` of them gives the status ``severity``. With ``minimum`` set
    the check instead fails when ``tested`` falls short of it.
    """

    name: str
    layer: str
    table: str
    details: str
    bad: Callable[[Column], Column] | None = None
    threshold: float = 0.0
    severity: str = FAILED
    minimum: int | None = None
    tested: Callable[[], Column] = lambda: F.count(F.lit(1))

    def aggregates(self, now: Column) -> list[Column]:
        failed = F.lit(0).cast("long") if self.bad is None else F.count_if(self.bad(now))
        return [self.tested().alias(f"tested_{self.name}"), failed.alias(f"bad_{self.name}")]

    def result(self, table_name: str) -> Column:
        """Struct of the result, from the aggregates of a month."""
        tested = F.coalesce(f"tested_{self.name}", F.lit(0))
        failed = F.coalesce(f"bad_{self.name}", F.lit(0))
        if self.minimum is None:
            rate = F.when(tested > 0, failed / tested).otherwise(0.0)
            passed = rate <= self.threshold
        else:
            rate = F.lit(0.0)
            passed = tested >= self.minimum
            failed = F.when(passed, 0).otherwise(1).cast("long")
        values = {
            "{failed}": failed.cast("string"),
            "{tested}": tested.cast("string"),
            "{tested:,}": F.format_number(tested, 0),
            "{rate}": percent_text(rate),
            "{month}": F.col("execution_date"),
        }
        return F.struct(
            F.lit(self.name).alias("check_name"),
            F.lit(self.layer).alias("layer"),
            F.lit(table_name).alias("table_name"),
            F.when(passed, PASSED).otherwise(self.severity).alias("status"),
            tested.alias("rows_tested"),
            failed.alias("rows_failed"),
            rate.alias("failure_rate"),
            F.lit(self.threshold).alias("threshold"),
            fill_text(self.details, values).alias("details"),
        )


def fill_text(text: str, values: dict[str, Column]) -> Column:
    """Put columns in the places of a text."""
    parts = []
    for before, name, form, _ in Formatter().parse(text):
        if before:
            parts.append(F.lit(before))
        if name is not None:
            parts.append(values["{" + name + (f":{form}" if form else "") + "}"])
    return F.concat(*parts)


def _outside_range(_: Column) -> Column:
    return ~F.col("trip_duration_min").between(SHORTEST_MINUTES, LONGEST_MINUTES)


def _negative_amount(_: Column) -> Column:
    return (F.col("total_amount") < 0) | (F.col("fare_amount") < 0)


def _invalid_zone(_: Column) -> Column:
    return ~valid_zone(F.col("pickup_location_id")) | ~valid_zone(F.col("dropoff_location_id"))


# Names, limits and texts of the checks, in the order they are run.
CHECKS = (
    Check(
        name="not_null_pickup_datetime",
        layer="bronze",
        table="trips",
        bad=lambda _: F.col("tpep_pickup_datetime").isNull(),
        details="{failed} NULL pickup datetimes out of {tested} rows",
    ),
    Check(
        name="minimum_row_count",
        layer="bronze",
        table="trips",
        minimum=MIN_BRONZE_ROWS,
        details=f"Row count: {{tested:,}}. Minimum expected: {MIN_BRONZE_ROWS:,}",
    ),
    Check(
        name="no_future_pickup_dates",
        layer="bronze",
        table="trips",
        bad=lambda now: F.col("tpep_pickup_datetime") > now,
        severity=WARNING,
        details="{failed} rows with future pickup datetime",
    ),
    Check(
        name="valid_location_ids",
        layer="silver",
        table="trips",
        bad=_invalid_zone,
        threshold=0.001,
        details="{failed} rows with invalid TLC zone IDs (allowed range: 1-265)",
    ),
    Check(
        name="non_negative_amounts",
        layer="silver",
        table="trips",
        bad=_negative_amount,
        details="{failed} rows with negative total_amount or fare_amount",
    ),
    Check(
        name="trip_duration_range_1_to_300_min",
        layer="silver",
        table="trips",
        bad=_outside_range,
        threshold=0.005,
        severity=WARNING,
        details="{failed} trips with duration outside [1, 300] minutes ({rate})",
    ),
    Check(
        name="daily_revenue_completeness",
        layer="gold",
        table="kpi_daily_revenue",
        minimum=MIN_DAYS,
        tested=lambda: F.count_distinct("pickup_date"),
        details=f"{{tested}} days found in kpi_daily_revenue for {{month}}. Minimum: {MIN_DAYS}",
    ),
    Check(
        name="positive_daily_revenue",
        layer="gold",
        table="kpi_daily_revenue",
        bad=lambda _: F.col("total_revenue") <= 0,
        details="{failed} days with zero or negative total_revenue",
    ),
)


def checks_of(layer: str, *names: str) -> list[Check]:
    """The checks of a layer, or those of them that are named."""
    return [c for c in CHECKS if c.layer == layer and (not names or c.name in names)]


def run_layer_checks(
    table: DataFrame,
    layer: str,
    months: Months = None,
    as_of: dt.datetime | None = None,
    checks: Iterable[Check] | None = None,
    table_name: Callable[[str, str], str] = "{}.{}".format,
) -> DataFrame:
    """Results of a layer's checks, one row per month and check.

    Months asked for without a row in the table are tested as empty; without
    months given, those in the table are tested.
    """
    chosen = list(checks_of(layer) if checks is None else checks)
    month = F.col("_execution_date")
    if layer == "gold":
        month = month_text(F.col("pickup_date"))
    aggregates = [column for check in chosen for column in check.aggregates(stamp(as_of))]
    counts = (
        table.where(in_months(month, months))
        .groupBy(month.alias("execution_date"))
        .agg(*aggregates)
    )
    wanted = month_list(months)
    if wanted is not None:
        spine = table.sparkSession.createDataFrame([(m,) for m in wanted], "execution_date string")
        counts = spine.join(counts, "execution_date", "left")
    results = [check.result(table_name(layer, check.table)) for check in chosen]
    return counts.select("execution_date", F.inline(F.array(*results)))


def run_all_checks(
    bronze: DataFrame,
    silver: DataFrame,
    daily: DataFrame,
    months: Months = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """The results of all layers as one frame, each layer read once."""
    results = None
    for layer, table in zip(LAYERS, (bronze, silver, daily), strict=True):
        rows = run_layer_checks(table, layer, months, as_of)
        results = rows if results is None else results.unionByName(rows)
    return results


def check_bronze_inline(
    bronze: DataFrame, months: Months = None, table_name: str = "bronze.trips"
) -> DataFrame:
    """The one check of the short pipeline; its rate is NULL when there are no rows."""
    pickup = F.col("tpep_pickup_datetime")
    counts = (
        bronze.where(in_months(F.col("_execution_date"), months))
        .groupBy(F.col("_execution_date").alias("execution_date"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(pickup.isNull()).alias("missing"))
    )
    wanted = month_list(months)
    if wanted is not None:
        spine = bronze.sparkSession.createDataFrame(
            [(m,) for m in wanted], "execution_date string"
        )
        counts = spine.join(counts, "execution_date", "left").fillna(0)
    result = F.struct(
        F.lit("not_null_pickup_datetime").alias("check_name"),
        F.lit("bronze").alias("layer"),
        F.lit(table_name).alias("table_name"),
        F.when(F.col("missing") == 0, PASSED).otherwise(FAILED).alias("status"),
        F.col("rows").alias("rows_tested"),
        F.col("missing").alias("rows_failed"),
        F.try_divide("missing", "rows").alias("failure_rate"),
        F.lit(0.0).alias("threshold"),
        F.lit("NULL pickup datetimes").alias("details"),
    )
    return counts.select("execution_date", F.inline(F.array(result)))


def gate_summary(results: DataFrame) -> DataFrame:
    """Results by status per month. A failed check closes the gate, a warning does not."""
    failed = F.count_if(F.col("status") == FAILED)
    return results.groupBy("execution_date").agg(
        F.count_if(F.col("status") == PASSED).alias("passed"),
        F.count_if(F.col("status") == WARNING).alias("warnings"),
        failed.alias("failed"),
        F.when(failed > 0, "FAIL").otherwise("PASS").alias("verdict"),
    )


def require_gate(results: DataFrame) -> None:
    """Raise if a check of the results failed (eight rows a month at most)."""
    failed = results.where(F.col("status") == FAILED).select("execution_date", "check_name")
    rows = failed.collect()
    if rows:
        names = ", ".join(f"{row[1]} ({row[0]})" for row in rows)
        raise QualityGateError(f"{len(rows)} check(s) failed: {names}")


def min_trips_gate(
    daily: DataFrame, months: Months = None, minimum: int = MIN_MONTH_TRIPS
) -> DataFrame:
    """Month totals with ``enough_trips``; a month with no day at all is not listed."""
    enough = F.coalesce(F.col("total_trips") >= minimum, F.lit(False))
    return gold_month_stats(daily, months).withColumn("enough_trips", enough)


def with_failure_text(results: DataFrame) -> DataFrame:
    """Add ``failure_pct``, the rate as text such as 0.05%."""
    return results.withColumn("failure_pct", percent_text(F.col("failure_rate")))
