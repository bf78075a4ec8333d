"""The monthly job: raw files to bronze, silver and gold, checked and logged.

Any number of months is one pass: month is a partition and a group key, not a
loop. Each layer is read back from its table, so a lost executor costs the tasks
of one layer at most and the three KPI tables do not repeat the cleaning.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schemas
from fareloom.functions.months import Months, at, in_months, month_list, previous_month
from fareloom.operators import checks, runs
from fareloom.operators.daily import kpi_daily_revenue
from fareloom.operators.hourly import kpi_hourly_patterns
from fareloom.operators.merge import merge_insert_new_trips
from fareloom.operators.trips import clean_trips_by_day
from fareloom.operators.validation import validation_report
from fareloom.operators.zones import dim_zones, kpi_zone_performance
from fareloom.plans.quality import run_quality_checks
from fareloom.session import size_shuffle, size_tasks, stored_bytes
from fareloom.sources import landing as files
from fareloom.sources import ledger
from fareloom.sources.tables import (
    BRONZE_ORDER,
    GOLD_TABLES,
    Warehouse,
    append_bronze,
    stage_gold,
    write_silver_trips,
)

SUMMARY = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_trips", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("rows_ingested", T.LongType()),
        T.StructField("rows_bronze", T.LongType()),
        T.StructField("rows_silver", T.LongType()),
        T.StructField("rows_gold", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


class RunFailedError(RuntimeError):
    """A month did not get through; its tables may be missing or old."""


@dataclass
class Progress:
    """What is known of each month of a run."""

    months: list[str]
    known: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.known = {month: {} for month in self.months}

    @property
    def open(self) -> list[str]:
        return [month for month in self.months if "error_message" not in self.known[month]]

    def note(self, month: str, **values) -> None:
        self.known[month].update(values)

    def fail(self, month: str, message: str) -> None:
        self.known[month].setdefault("error_message", message)

    def summary(self, run_id: str) -> list[dict]:
        rows = []
        for month in self.months:
            known = self.known[month]
            status = runs.FAILED if "error_message" in known else runs.COMPLETED
            rows.append({"run_id": run_id, "execution_date": month, "status": status, **known})
        return rows


@dataclass(frozen=True)
class Job:
    """Where raw files come from, where tables go, and how strict the run is.

    With ``enforce`` a month that fails a check goes no further; without it the
    tables are built all the same and the checks are only recorded. ``skip_loaded``
    leaves out files the ledger names, before they are opened. ``full_replace`` drops
    the silver and gold rows of all months that are not part of the run.
    """

    warehouse: Warehouse
    landing: str
    pattern: str = files.FILE_PATTERN
    as_of: dt.datetime | None = None
    enforce: bool = True
    skip_loaded: bool = False
    full_replace: bool = False

    def now(self) -> dt.datetime:
        return self.as_of or dt.datetime.now(dt.UTC).replace(tzinfo=None)


def delivered_schemas(job: Job, progress: Progress) -> list[tuple[T.StructType, list[str]]]:
    """Months grouped by the schema of their files, read from one footer each.

    Deliveries of different years differ in types and columns and cannot be read
    by one scan. A month without a file fails.
    """

    def schema_of(month: str) -> T.StructType | None:
        path = files.landing_glob(job.landing, month, job.pattern)
        try:
            return job.warehouse.spark.read.parquet(path).schema
        except AnalysisException as error:
            progress.fail(month, f"no raw file: {error.getCondition()}")
            return None

    groups: list[tuple[T.StructType, list[str]]] = []
    with ThreadPoolExecutor(8) as pool:
        delivered = list(pool.map(schema_of, progress.months))
    for month, schema in zip(progress.months, delivered, strict=True):
        if schema is None:
            continue
        same = [months for known, months in groups if known == schema]
        if same:
            same[0].append(month)
        else:
            groups.append((schema, [month]))
    return groups


def scan_delivered(job: Job, groups: list[tuple[T.StructType, list[str]]]) -> list[DataFrame]:
    spark = job.warehouse.spark
    return [
        files.normalize_column_names(
            files.scan_raw_trips(spark, job.landing, months, job.pattern, schema)
        )
        for schema, months in groups
    ]


def validate_months(raw: list[DataFrame], groups, progress: Progress) -> list[DataFrame]:
    """Count every month's rows and fail the months that may not be loaded.

    Returns the frames in which a month is still under way.
    """
    reports = [
        validation_report(frame, months)
        for frame, (_, months) in zip(raw, groups, strict=True)
    ]
    if not reports:
        return []
    for row in reduce(DataFrame.unionByName, reports).collect():
        progress.note(row["_execution_date"], rows_ingested=row["row_count"])
        if not row["valid"]:
            issues = "; ".join(row["issues"])
            progress.fail(row["_execution_date"], f"raw data validation failed: {issues}")
    return [
        frame
        for frame, (_, months) in zip(raw, groups, strict=True)
        if set(months) & set(progress.open)
    ]


def load_bronze(
    job: Job, raw: list[DataFrame], progress: Progress, months: list[str] | None = None
) -> None:
    """Append the valid months' files, optionally only those not loaded before.

    Files to be skipped are found in the ledger and never enter the scan. What was
    loaded is entered after it was appended: a run that fails between the two loads
    the files again, and deduplication hides the copies.
    """
    warehouse = job.warehouse
    months = progress.open if months is None else months
    if not months:
        return
    delivered = ledger.delivered_files(warehouse.spark, job.landing, months, job.pattern)
    if job.skip_loaded:
        delivered = ledger.new_files(warehouse, delivered)
    found = [row.asDict() for row in delivered.collect()]
    when = at(job.now())
    month, source = F.col("_execution_date"), F.col("_source_file")
    if job.skip_loaded:
        # A condition on the path of the file: Spark drops files by it when it plans.
        raw = [frame.where(source.isin([row["_source_file"] for row in found])) for frame in raw]
    loaded: dict[str, int] = {}
    if found and raw:
        rows = reduce(
            DataFrame.unionByName,
            [
                files.conform_bronze_schema(files.add_audit_columns(frame, month, source, when))
                for frame in raw
            ],
        ).where(in_months(month, months))
        loaded = append_bronze(warehouse, rows, months)
        enter_landed(job, found)
    for month_name in months:
        progress.note(month_name, rows_ingested=loaded.get(month_name, 0))


def enter_landed(job: Job, found: list[dict]) -> None:
    """Enter files that were appended, with the rows their footers tell."""
    warehouse = job.warehouse
    spark = warehouse.spark
    known = spark.createDataFrame(found, "path string, _source_file string, _execution_date string, bytes long")
    rows = ledger.rows_of_files(spark, job.landing, [row["path"] for row in found])
    ledger.record_landed(warehouse, known.join(rows, "_source_file", "left"), job.now())


def merge_into_bronze(
    warehouse: Warehouse, staging: DataFrame, months: Months = None, null_safe: bool = False
) -> int:
    """Append the staged trips bronze lacks; returns how many.

    Of bronze only files are opened that hold a day of the staged trips; which these
    are is known from an index that is brought up to date first. Safe for one writer
    at a time: Parquet tables have no transactions. The rows are counted by the
    footers before and after, not by joining a second time. Tasks are sized by the
    staged rows, a count of footers too.
    """
    before = warehouse.bronze_trips(months).count()
    size_tasks(warehouse.spark, staging.where(in_months(F.col("_execution_date"), months)).count())
    new = merge_insert_new_trips(staging, overlapping_bronze(warehouse, staging, months), months, null_safe)
    path = warehouse.path("bronze", "trips")
    ordered = new.sortWithinPartitions("_execution_date", *BRONZE_ORDER)
    ordered.write.mode("append").partitionBy("_execution_date").parquet(path)
    return warehouse.bronze_trips(months).count() - before


def overlapping_bronze(warehouse: Warehouse, staging: DataFrame, months: Months = None) -> DataFrame:
    """The files of bronze that may hold a key of the staged trips.

    A trip with the same key was picked up on the same day, so files without a day of
    the staged trips, of whatever month, cannot match.
    """
    ledger.index_bronze(warehouse)
    staged = staging.where(in_months(F.col("_execution_date"), months))
    paths = ledger.files_of_days(warehouse, staged)
    if not paths:
        return warehouse.spark.createDataFrame([], schemas.BRONZE_TRIPS)
    reader = warehouse.spark.read.option("basePath", warehouse.path("bronze", "trips"))
    return reader.schema(schemas.BRONZE_TRIPS).parquet(*paths).select(*schemas.BRONZE_TRIPS.names)


def build_dim_zones(
    warehouse: Warehouse, lookup: DataFrame, as_of: dt.datetime | None = None
) -> None:
    """Write the zone dimension; done once, not every month."""
    zones = dim_zones(lookup, as_of).hint("rebalance")
    zones.write.mode("overwrite").parquet(warehouse.path("silver", "dim_zones"))


def build_silver(
    warehouse: Warehouse, months: Months = None, full_replace: bool = False
) -> None:
    """Rewrite the silver days of the months from bronze."""
    wanted = month_list(months)
    path = warehouse.path("bronze", "trips")
    if wanted is not None:
        path += "/_execution_date={" + ",".join(wanted) + "}"
    size_shuffle(warehouse.spark, stored_bytes(warehouse.spark, path))
    trips = clean_trips_by_day(warehouse.bronze_trips(months), months)
    write_silver_trips(warehouse, trips, months, full_replace, dealt=True)


def kpi_tables(
    trips: DataFrame, zones: DataFrame, months: Months = None, as_of: dt.datetime | None = None
) -> dict[str, DataFrame]:
    return {
        "kpi_daily_revenue": kpi_daily_revenue(trips, months, as_of),
        "kpi_zone_performance": kpi_zone_performance(trips, zones, months, as_of),
        "kpi_hourly_patterns": kpi_hourly_patterns(trips, months, as_of),
    }


def build_gold(
    warehouse: Warehouse,
    months: Months = None,
    as_of: dt.datetime | None = None,
    full_replace: bool = False,
) -> None:
    """Rewrite the months of the three KPI tables from silver.

    The tables do not depend on each other; their jobs are submitted together, so
    that one fills the cores another leaves idle at the end of its stages. When all
    three are written they are published in one step.
    """
    trips = warehouse.silver_trips(months)
    zones = warehouse.read("silver", "dim_zones")
    tables = kpi_tables(trips, zones, months, as_of)
    with ThreadPoolExecutor(len(tables)) as pool:
        done = [
            pool.submit(stage_gold, warehouse, table, rows, full_replace, months)
            for table, rows in tables.items()
        ]
    warehouse.publish(*[staged.result() for staged in done])


def gold_rows(warehouse: Warehouse, months: list[str]) -> dict[str, int]:
    """Rows of the KPI tables by month, a count of footers."""
    counts: dict[str, int] = {}
    for table, (partition, _) in GOLD_TABLES.items():
        month = F.substring(F.col(partition).cast("string"), 1, 7)
        by_month = warehouse.read("gold", table).groupBy(month.alias("m")).count()
        for row in by_month.where(F.col("m").isin(months)).collect():
            counts[row["m"]] = counts.get(row["m"], 0) + row["count"]
    return counts


def apply_gate(job: Job, results: list[dict], progress: Progress, layers: tuple[str, ...]) -> None:
    """Note the rows tested and, if enforced, fail months with a failed check."""
    tested_by = {"minimum_row_count": "rows_bronze", "valid_location_ids": "rows_silver"}
    for row in results:
        if row["check_name"] in tested_by:
            progress.note(
                row["execution_date"], **{tested_by[row["check_name"]]: row["rows_tested"]}
            )
    if not job.enforce:
        return
    failed = [row for row in results if row["status"] == checks.FAILED]
    for month in {row["execution_date"] for row in failed}:
        names = [row["check_name"] for row in failed if row["execution_date"] == month]
        progress.fail(month, f"{' and '.join(layers)} checks failed: {', '.join(names)}")


def apply_trips_gate(job: Job, progress: Progress) -> None:
    """Note trips and revenue; fail months with too few trips or no day at all."""
    daily = job.warehouse.read("gold", "kpi_daily_revenue")
    daily = daily.where(in_months(F.col("_execution_date"), progress.open))
    stats = {row["_execution_date"]: row for row in checks.min_trips_gate(daily).collect()}
    for month in progress.open:
        row = stats.get(month)
        if row is not None:
            progress.note(
                month, total_trips=row["total_trips"], total_revenue=row["total_revenue"]
            )
        if row is None or not row["enough_trips"]:
            progress.fail(month, "gold quality gate failed: too few trips")


def _build_layers(job: Job, raw: list[DataFrame], progress: Progress, run_id: str) -> None:
    """Bronze, silver, gold, with the checks between; stops when no month is left.

    A layer that the run has finished for a month before, as the steps tell, is not
    built again: a run that failed goes on where it stopped when it gets its id again.
    A layer is entered when it is whole, so one that was cut off is built anew.
    """
    warehouse, done = job.warehouse, runs.finished_steps(job.warehouse, run_id)

    def left(layer: str) -> list[str]:
        return [month for month in progress.open if month not in done.get(layer, {})]

    def enter(layer: str, rows: dict[str, int | None]) -> None:
        if rows:
            runs.log_steps(warehouse, run_id, layer, rows, job.now())

    todo = left("bronze")
    load_bronze(job, raw, progress, todo)
    enter("bronze", {month: progress.known[month].get("rows_ingested") for month in todo})
    for month in set(progress.open) - set(todo):
        progress.note(month, rows_ingested=done["bronze"][month])
    results = run_quality_checks(job.warehouse, progress.open, ("bronze",), job.as_of)
    runs.log_quality_results(job.warehouse, run_id, results, job.now())
    apply_gate(job, results, progress, ("bronze",))
    if not progress.open:
        return
    if todo := left("silver"):
        build_silver(warehouse, todo, job.full_replace)
        enter("silver", dict.fromkeys(todo))
    if todo := left("gold"):
        build_gold(warehouse, todo, job.as_of, job.full_replace)
        enter("gold", dict.fromkeys(todo))
    results = run_quality_checks(job.warehouse, progress.open, ("silver", "gold"), job.as_of)
    runs.log_quality_results(job.warehouse, run_id, results, job.now())
    for month, rows in gold_rows(job.warehouse, progress.open).items():
        progress.note(month, rows_gold=rows)
    apply_gate(job, results, progress, ("silver", "gold"))
    if progress.open:
        apply_trips_gate(job, progress)


def run_months(
    job: Job, months: Months, run_id: str | None = None, dry_run: bool = False
) -> list[dict]:
    """Process months in one pass; returns a summary row per month.

    A month that fails validation, a check or the trips gate is left out of the
    later steps and does not hold up the others. Any other error is logged for
    the months still under way and raised. ``dry_run`` stops after the validation
    and writes nothing.
    """
    progress = Progress(month_list(months) or [])
    run_id = run_id or str(uuid.uuid4())
    started = job.now()
    if not dry_run:
        runs.log_run_start(job.warehouse, run_id, progress.months, started)
    try:
        groups = delivered_schemas(job, progress)
        raw = scan_delivered(job, groups)
        raw = validate_months(raw, groups, progress)
        if not dry_run and progress.open:
            _build_layers(job, raw, progress, run_id)
    except Exception as error:
        for month in progress.open:
            progress.fail(month, f"{type(error).__name__}: {error}")
        raise
    finally:
        summary = progress.summary(run_id)
        if not dry_run:
            names = set(schemas.PIPELINE_RUNS.names)
            outcomes = [{k: v for k, v in row.items() if k in names} for row in summary]
            runs.log_run_end(job.warehouse, run_id, outcomes, started, job.now())
    return summary


def run_month(
    job: Job, month: str | None = None, run_id: str | None = None, dry_run: bool = False
) -> dict:
    """Process one month, by default the previous one; raises if it fails."""
    month = month or previous_month(job.now().date())
    (summary,) = run_months(job, month, run_id, dry_run)
    if summary["status"] == runs.FAILED:
        raise RunFailedError(f"{month}: {summary['error_message']}")
    return summary


def summary_frame(job: Job, summary: list[dict]) -> DataFrame:
    rows = [tuple(row.get(name) for name in SUMMARY.names) for row in summary]
    return job.warehouse.spark.createDataFrame(rows, SUMMARY)
