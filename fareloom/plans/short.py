"""The short monthly job: merge into bronze, one check, short silver and KPIs, a gate.

It shares bronze with the full job and has silver and gold tables of its own. Trips
are not made distinct in silver, as the merge lets each key into bronze once.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.months import Months, at, in_months, month_list
from fareloom.operators import checks, lite, runs
from fareloom.plans.monthly import Job, Progress, delivered_schemas, merge_into_bronze, scan_delivered
from fareloom.session import size_shuffle, size_tasks, stored_bytes
from fareloom.sources import landing as files
from fareloom.sources.tables import Warehouse, stage_lite


def staged_trips(job: Job, progress: Progress) -> DataFrame:
    """The delivered files of the months as bronze rows; months without a file fail."""
    frames = scan_delivered(job, delivered_schemas(job, progress))
    month, source, when = F.col("_execution_date"), F.col("_source_file"), at(job.now())
    rows = [files.conform_bronze_schema(files.add_audit_columns(frame, month, source, when)) for frame in frames]
    if not rows:
        return job.warehouse.spark.createDataFrame([], schemas.BRONZE_TRIPS)
    return reduce(DataFrame.unionByName, rows)


def month_rows(warehouse: Warehouse, months: list[str]) -> dict[str, int]:
    """Rows of bronze by month, a count of footers."""
    counted = warehouse.bronze_trips(months).groupBy("_execution_date").count().collect()
    return {row[0]: row[1] for row in counted}


def build_silver_lite(job: Job, months: list[str], rows: int = 0) -> None:
    warehouse = job.warehouse
    path = f"{warehouse.path('bronze', 'trips')}/_execution_date={{{','.join(months)}}}"
    size_shuffle(warehouse.spark, stored_bytes(warehouse.spark, path))
    size_tasks(warehouse.spark, rows)
    trips = lite.clean_trips_lite(warehouse.bronze_trips(months), months)
    warehouse.publish(stage_lite(warehouse, "silver", "trips_lite", trips, months, job.full_replace))


def build_gold_lite(job: Job, months: list[str]) -> None:
    """Write the three short KPI tables at the same time and publish them in one step."""
    warehouse = job.warehouse
    trips = warehouse.read("silver", "trips_lite").where(in_months(F.col("_execution_date"), months))
    zones = warehouse.read("silver", "dim_zones")
    tables = {
        "kpi_daily_revenue_lite": lite.kpi_daily_revenue_lite(trips, months, job.as_of),
        "kpi_zone_performance_lite": lite.kpi_zone_performance_lite(trips, zones, months, job.as_of),
        "kpi_hourly_patterns_lite": lite.kpi_hourly_patterns_lite(trips, months, job.as_of),
    }
    with ThreadPoolExecutor(len(tables)) as pool:
        done = [
            pool.submit(stage_lite, warehouse, "gold", table, rows, months, job.full_replace)
            for table, rows in tables.items()
        ]
    warehouse.publish(*[staged.result() for staged in done])


def apply_gate(job: Job, progress: Progress) -> None:
    """Note trips and revenue of the pickups in each month; fail months with too few."""
    daily = job.warehouse.read("gold", "kpi_daily_revenue_lite")
    stats = {row["_execution_date"]: row for row in checks.min_trips_gate(daily, progress.open).collect()}
    for month in progress.open:
        row = stats.get(month)
        if row is not None:
            progress.note(month, total_trips=row["total_trips"], total_revenue=row["total_revenue"])
        if row is None or not row["enough_trips"]:
            progress.fail(month, "gold quality gate failed: too few trips")


def run_months_lite(
    job: Job, months: Months, run_id: str | None = None, null_safe: bool = False
) -> list[dict]:
    """Run the short job for some months in one pass; returns a summary row per month.

    The check of bronze is recorded and stops nothing; the gate fails months with too
    few trips. A month run again inserts nothing new and rewrites its tables. With
    ``null_safe`` this holds for trips without a key part too. Errors are logged for
    the months under way and raised.
    """
    progress = Progress(month_list(months) or [])
    run_id = run_id or str(uuid.uuid4())
    started = job.now()
    warehouse = job.warehouse
    runs.log_run_start(warehouse, run_id, progress.months, started)
    try:
        staging = staged_trips(job, progress)
        if progress.open:
            before = month_rows(warehouse, progress.open)
            merge_into_bronze(warehouse, staging, progress.open, null_safe)
            counted = month_rows(warehouse, progress.open)
            for month, rows in counted.items():
                progress.note(month, rows_ingested=rows - before.get(month, 0), rows_bronze=rows)
            bronze = warehouse.bronze_trips(progress.open)
            checked = checks.check_bronze_inline(bronze, progress.open, warehouse.name("bronze", "trips"))
            runs.log_quality_results(warehouse, run_id, [row.asDict() for row in checked.collect()], job.now())
            build_silver_lite(job, progress.open, sum(counted.values()))
            build_gold_lite(job, progress.open)
            apply_gate(job, progress)
    except Exception as error:
        for month in progress.open:
            progress.fail(month, f"{type(error).__name__}: {error}")
        raise
    finally:
        summary = progress.summary(run_id)
        names = set(schemas.PIPELINE_RUNS.names)
        outcomes = [{k: v for k, v in row.items() if k in names} for row in summary]
        runs.log_run_end(warehouse, run_id, outcomes, started, job.now())
    return summary
