"""Every registered query: the operator applied to the whole of its inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.months import at, day_name, day_type, time_of_day_segment
from fareloom.operators import checks, layout, lite, merge, runs, trips, validation, zones
from fareloom.operators.daily import gold_month_stats, kpi_daily_revenue
from fareloom.operators.hourly import demand_index, hourly_metrics, kpi_hourly_patterns
from fareloom.plans import monthly, short
from fareloom.session import ROWS_PER_TASK
from fareloom.sources import landing, ledger, tables
from fareloom.sources.zones import scan_zone_lookup
from suite.inputs import (
    AS_OF,
    bronze,
    event_trips,
    raw_trips,
    run_events,
    scratch,
    trip_rows,
    zone_lookup,
)
from suite.inputs import zones as zone_table

Query = Callable[[SparkSession, str], DataFrame]

# What identifies a bronze row in the results of single-column operators.
KEYS = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.clean_trips(bronze(spark, sf_dir))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, written once: tables made from it do not repeat the cleaning."""
    path = scratch(spark, "silver")
    silver(spark, sf_dir).write.parquet(path)
    return spark.read.schema(schemas.SILVER_TRIPS).parquet(path)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_daily_revenue(silver(spark, sf_dir), as_of=AS_OF)


def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_all_checks(
        bronze(spark, sf_dir), silver(spark, sf_dir), daily(spark, sf_dir), as_of=AS_OF
    )


# Sources and sinks


def scan_raw_trips(spark, sf_dir):
    root = scratch(spark, "landing")
    raw = raw_trips(spark, sf_dir).withColumn("delivery", F.col("_execution_date"))
    raw.drop("_execution_date").write.partitionBy("delivery").parquet(root)
    return landing.scan_raw_trips(spark, root, pattern="delivery={month}").drop("_source_file")


def conform_bronze_schema(spark, sf_dir):
    delivered = bronze(spark, sf_dir).withColumn("ride_id", F.lit(1)).drop("airport_fee")
    lower = delivered.toDF(*[name.lower() for name in delivered.columns])
    narrow = lower.withColumn("vendorid", F.col("vendorid").cast("int"))
    return landing.conform_bronze_schema(narrow)


def add_audit_columns(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    source = F.concat(F.lit("trips/"), F.col("_execution_date"), F.lit(".parquet"))
    return landing.add_audit_columns(raw, F.col("_execution_date"), source, AS_OF)


def normalize_column_names(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return landing.normalize_column_names(raw.toDF(*[f" {name} " for name in raw.columns]))


def append_bronze(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "bronze"))
    rows = bronze(spark, sf_dir)
    first = F.col("_ingested_at") == at(AS_OF.replace(year=2002))
    tables.append_bronze(warehouse, rows.where(first))
    tables.append_bronze(warehouse, rows.where(~first))
    return warehouse.bronze_trips()


def skip_loaded_files(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    warehouse = tables.Warehouse(spark, scratch(spark, "ledger"))
    delivered = rows.groupBy("_source_file", "_execution_date").agg(
        F.count(F.lit(1)).alias("rows_delivered")
    )
    loaded = delivered.where("rows_delivered % 2 = 0").withColumn("bytes", F.lit(None).cast("long"))
    ledger.record_landed(warehouse, loaded.withColumn("rows", F.col("rows_delivered")), AS_OF)
    return landing.skip_loaded_files(delivered, ledger.landed_files(warehouse))


def write_silver_partitioned(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "silver"))
    rows = trips.clean_trips_by_day(bronze(spark, sf_dir))
    tables.write_silver_trips(warehouse, rows, dealt=True)
    return warehouse.silver_trips()


def republished_silver(spark, sf_dir):
    """All months, then every odd month again without its airport trips, in one step."""
    warehouse = tables.Warehouse(spark, scratch(spark, "silver"))
    rows = bronze(spark, sf_dir)
    tables.write_silver_trips(warehouse, trips.clean_trips_by_day(rows), dealt=True)
    odd = F.substring("_execution_date", 6, 2).cast("int") % 2 == 1
    fewer = trips.clean_trips_by_day(rows.where(odd)).where("not is_airport_trip")
    asked = [row[0] for row in rows.where(odd).select("_execution_date").distinct().collect()]
    staged = tables.stage_silver_trips(warehouse, fewer, asked, dealt=True)
    warehouse.publish(staged)
    warehouse.vacuum("silver", "trips")
    return warehouse.silver_trips()


def write_gold_tables(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "gold"))
    made = monthly.kpi_tables(stored_silver(spark, sf_dir), zone_table(spark, sf_dir), as_of=AS_OF)
    for table, rows in made.items():
        tables.write_gold(warehouse, table, rows)
    parts = [
        warehouse.read("gold", table)
        .groupBy(F.substring(F.col(partition).cast("string"), 1, 7).alias("month"))
        .agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("rows_written"),
            F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        )
        for table, (partition, _) in tables.GOLD_TABLES.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gold_in_order(spark, sf_dir):
    """The rows of the written KPI tables, numbered as their reader returns them."""
    warehouse = tables.Warehouse(spark, scratch(spark, "gold"))
    made = monthly.kpi_tables(stored_silver(spark, sf_dir), zone_table(spark, sf_dir), as_of=AS_OF)
    named = {
        "kpi_daily_revenue": F.col("pickup_date").cast("string"),
        "kpi_zone_performance": F.col("location_id").cast("string"),
        "kpi_hourly_patterns": F.concat_ws("/", "pickup_dow", "pickup_hour"),
    }
    parts = []
    for table, rows in made.items():
        tables.write_gold(warehouse, table, rows)
        month = F.substring(F.col(tables.GOLD_TABLES[table][0]).cast("string"), 1, 7)
        read = warehouse.gold_in_order(table).select(
            F.lit(table).alias("table_name"), month.alias("month"), named[table].alias("row_name")
        )
        parts.append(layout.number_as_read(read, scratch(spark, "numbered")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def scan_zones(spark, sf_dir):
    path = scratch(spark, "lookup") + "/zones.csv"
    zone_lookup(spark, sf_dir).write.option("header", "true").csv(path)
    return scan_zone_lookup(spark, path)


def _month_counts(spark, sf_dir) -> dict[str, int]:
    counts = validation.raw_month_counts(raw_trips(spark, sf_dir))
    return {row["_execution_date"]: row["row_count"] for row in counts.collect()}


def append_metadata_rows(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "metadata"))
    rows = [
        {
            "run_id": f"run-{month}",
            "execution_date": month,
            "env": "dev",
            "status": "COMPLETED",
            "run_date": AS_OF,
            "rows_ingested": count,
        }
        for month, count in _month_counts(spark, sf_dir).items()
    ]
    tables.append_metadata(warehouse, "pipeline_runs", rows)
    return tables.read_metadata(warehouse, "pipeline_runs")


# Validation


def validate_not_empty(spark, sf_dir):
    counts = validation.raw_month_counts(raw_trips(spark, sf_dir))
    return counts.select(
        "_execution_date", "row_count", (F.col("row_count") == 0).alias("is_empty")
    )


def validate_required_columns(spark, sf_dir):
    raw = raw_trips(spark, sf_dir).drop("total_amount")
    report = validation.validation_report(raw)
    return report.select("_execution_date", F.array_join("issues", "; ").alias("issues"))


def validate_month_ratio(spark, sf_dir):
    return validation.raw_month_counts(raw_trips(spark, sf_dir)).withColumn(
        "too_few", F.col("month_share") < validation.SMALLEST_MONTH_SHARE
    )


def validation_report(spark, sf_dir):
    report = validation.validation_report(raw_trips(spark, sf_dir))
    return report.withColumn("issues", F.array_join("issues", "; "))


# Silver


def dedup_latest_trip(spark, sf_dir):
    return trips.latest_trips(bronze(spark, sf_dir))


def _derived(*columns: Callable) -> Query:
    """Columns of the silver select beside the trip key, for all bronze rows."""

    def query(spark, sf_dir):
        made = [column() for column in columns]
        made = [c for part in made for c in (part if isinstance(part, list) else [part])]
        return bronze(spark, sf_dir).select(
            *[F.col(name).alias(f"key_{name}") for name in KEYS], *made
        )

    return query


def filter_valid_trips(spark, sf_dir):
    cleaned = bronze(spark, sf_dir).select(*trips.clean_columns())
    return trips.filter_valid_trips(cleaned)


def rejected_trips_by_reason(spark, sf_dir):
    return trips.rejected_trips_by_reason(bronze(spark, sf_dir))


def rejected_trips(spark, sf_dir):
    rejected = trips.rejected_trips(bronze(spark, sf_dir))
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


def clean_trips_lite(spark, sf_dir):
    return lite.clean_trips_lite(bronze(spark, sf_dir))


# Zones


def borough_group(spark, sf_dir):
    return zone_table(spark, sf_dir).select("location_id", "borough", "borough_group")


def zone_is_airport(spark, sf_dir):
    return zone_table(spark, sf_dir).select("location_id", "is_airport")


def join_trips_zones(spark, sf_dir):
    joined = zones.join_trips_zones(silver(spark, sf_dir), zone_table(spark, sf_dir))
    return joined.select(
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_location_id",
        "total_amount",
        "zone",
        "borough",
        "borough_group",
        "is_airport",
        "service_zone",
    )


def merge_insert_new_trips(spark, sf_dir):
    rows = trip_rows(spark, sf_dir)
    target = rows.where(F.col("line_status") == "F").select(*schemas.BRONZE_TRIPS.names)
    return merge.merge_insert_new_trips(rows.select(*schemas.BRONZE_TRIPS.names), target)


def merge_null_safe(spark, sf_dir):
    rows = trip_rows(spark, sf_dir)
    target = rows.where(F.col("line_status") == "F").select(*schemas.BRONZE_TRIPS.names)
    return merge.merge_insert_new_trips(
        rows.select(*schemas.BRONZE_TRIPS.names), target, null_safe=True
    )


def merge_indexed(spark, sf_dir):
    """The upsert against written bronze, of which only files of the staged days are read."""
    warehouse = tables.Warehouse(spark, scratch(spark, "merge"))
    rows = trip_rows(spark, sf_dir)
    tables.append_bronze(warehouse, rows.where(F.col("line_status") == "F").select(*schemas.BRONZE_TRIPS.names))
    staging = rows.select(*schemas.BRONZE_TRIPS.names)
    return merge.merge_insert_new_trips(staging, monthly.overlapping_bronze(warehouse, staging))


# Gold


def zone_performance(spark, sf_dir):
    return zones.kpi_zone_performance(
        silver(spark, sf_dir), zone_table(spark, sf_dir), as_of=AS_OF
    )


def _zone_window(column: Callable) -> Query:
    def query(spark, sf_dir):
        metrics = zones.zone_metrics(silver(spark, sf_dir), zone_table(spark, sf_dir))
        return metrics.select(
            "month", "borough", "location_id", "total_revenue", "total_pickups", column()
        )

    return query


def hourly_patterns(spark, sf_dir):
    return kpi_hourly_patterns(silver(spark, sf_dir), as_of=AS_OF)


def hourly_demand_index(spark, sf_dir):
    return hourly_metrics(silver(spark, sf_dir)).select(
        "month", "pickup_dow", "pickup_hour", "avg_trips_per_day", demand_index()
    )


def day_name_and_type(spark, sf_dir):
    day = F.col("pickup_dow")
    return silver(spark, sf_dir).select(
        "pickup_datetime",
        "pickup_dow",
        day_name(day).alias("day_of_week"),
        day_type(day).alias("day_type"),
    )


def hour_segments(spark, sf_dir):
    return silver(spark, sf_dir).select(
        "pickup_datetime",
        "pickup_hour",
        time_of_day_segment(F.col("pickup_hour")).alias("time_of_day_segment"),
    )


def daily_lite(spark, sf_dir):
    return lite.kpi_daily_revenue_lite(clean_trips_lite(spark, sf_dir), as_of=AS_OF)


def zones_lite(spark, sf_dir):
    return lite.kpi_zone_performance_lite(
        clean_trips_lite(spark, sf_dir), zone_table(spark, sf_dir), as_of=AS_OF
    )


def hourly_lite(spark, sf_dir):
    return lite.kpi_hourly_patterns_lite(clean_trips_lite(spark, sf_dir), as_of=AS_OF)


def month_stats(spark, sf_dir):
    return gold_month_stats(daily(spark, sf_dir))


# Quality checks


def _one_check(name: str) -> Query:
    (check,) = [c for c in checks.CHECKS if c.name == name]
    source = {"bronze": bronze, "silver": silver, "gold": daily}[check.layer]

    def query(spark, sf_dir):
        table = source(spark, sf_dir)
        return checks.run_layer_checks(table, check.layer, as_of=AS_OF, checks=[check])

    return query


def _raw_check(name: str) -> Query:
    """A silver check on cleaned rows before the filters, where rows do fail."""
    (check,) = [c for c in checks.CHECKS if c.name == name]

    def query(spark, sf_dir):
        cleaned = bronze(spark, sf_dir).select(*trips.clean_columns())
        return checks.run_layer_checks(cleaned, "silver", as_of=AS_OF, checks=[check])

    return query


def rows_from_structs(spark, sf_dir):
    """An array of check structs per month to one row per struct."""
    cleaned = bronze(spark, sf_dir).select(*trips.clean_columns())
    return checks.run_layer_checks(cleaned, "silver", as_of=AS_OF)


def dq_bronze_inline(spark, sf_dir):
    return checks.check_bronze_inline(bronze(spark, sf_dir))


def dq_gate_summary(spark, sf_dir):
    return checks.gate_summary(check_results(spark, sf_dir))


def gold_min_trips_gate(spark, sf_dir):
    return checks.min_trips_gate(daily(spark, sf_dir))


def failure_pct(spark, sf_dir):
    results = checks.run_layer_checks(bronze(spark, sf_dir), "bronze", as_of=AS_OF)
    return checks.with_failure_text(results).select(
        "execution_date", "check_name", "failure_rate", "failure_pct"
    )


# Run metadata


def log_run_start(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "metadata"))
    runs.log_run_start(warehouse, "run-1", sorted(_month_counts(spark, sf_dir)), AS_OF)
    return tables.read_metadata(warehouse, "pipeline_runs")


def log_run_end(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "metadata"))
    outcomes = [
        {"execution_date": month, "status": "COMPLETED", "rows_ingested": count}
        for month, count in _month_counts(spark, sf_dir).items()
    ]
    runs.log_run_end(warehouse, "run-1", outcomes, AS_OF.replace(year=2025), AS_OF)
    return tables.read_metadata(warehouse, "pipeline_runs")


def log_quality_results(spark, sf_dir):
    warehouse = tables.Warehouse(spark, scratch(spark, "metadata"))
    results = checks.run_layer_checks(bronze(spark, sf_dir), "bronze", as_of=AS_OF)
    rows = [row.asDict() for row in results.collect()]
    runs.log_quality_results(warehouse, "run-1", rows, AS_OF)
    return tables.read_metadata(warehouse, "quality_checks")


def recent_runs(spark, sf_dir):
    return runs.recent_runs(run_events(spark, sf_dir))


def run_history(spark, sf_dir):
    return runs.run_history(run_events(spark, sf_dir))


def latest_run_status(spark, sf_dir):
    return runs.latest_run_status(run_events(spark, sf_dir))


def quality_trend(spark, sf_dir):
    next_month = F.add_months(F.to_date(F.col("execution_date"), "yyyy-MM"), 1)
    results = check_results(spark, sf_dir).withColumn(
        "check_timestamp", next_month.cast("timestamp_ntz")
    )
    return runs.quality_trend(results)


# Jobs


def run_month(spark, sf_dir):
    """The one month of ``events`` from raw file to summary, with the gates on."""
    root = scratch(spark, "month")
    raw = event_trips(spark, sf_dir)
    (month,) = raw.agg(F.date_format(F.max("tpep_pickup_datetime"), "yyyy-MM")).first()
    raw.write.parquet(f"{root}/landing/{landing.file_name(month)}")
    return _run(spark, sf_dir, root, month, landing.FILE_PATTERN, enforce=True)


def _land(spark, sf_dir, root) -> list[str]:
    """Deliver the trips of ``lineitem``, a folder for each month; returns the months.

    Rows are dealt by month and, where a month has many, by slices of it: a task sorts
    the rows of a few files by month, however large the table is.
    """
    counts = _month_counts(spark, sf_dir)
    raw = raw_trips(spark, sf_dir).withColumnRenamed("_execution_date", "delivery")
    slices = -(-max(counts.values(), default=1) // ROWS_PER_TASK)
    part = F.pmod(F.xxhash64(*schemas.TRIP_KEY), F.lit(slices))
    dealt = raw.repartition(max(len(counts), 1) * slices, "delivery", part)
    dealt.write.partitionBy("delivery").parquet(f"{root}/landing")
    return sorted(counts)


def run_months(spark, sf_dir):
    """All months of ``lineitem`` in one pass; its planted defects are only recorded."""
    root = scratch(spark, "months")
    months = _land(spark, sf_dir, root)
    return _run(spark, sf_dir, root, months, "delivery={month}", enforce=False)


def _run(spark, sf_dir, root, months, pattern, enforce) -> DataFrame:
    warehouse = tables.Warehouse(spark, f"{root}/tables")
    monthly.build_dim_zones(warehouse, zone_lookup(spark, sf_dir), AS_OF)
    job = monthly.Job(warehouse, f"{root}/landing", pattern, AS_OF, enforce)
    return monthly.summary_frame(job, monthly.run_months(job, months, "run-1"))


def run_months_lite(spark, sf_dir):
    """The short job on all months of ``lineitem``: the trips of its daily table."""
    root = scratch(spark, "short")
    months = _land(spark, sf_dir, root)
    warehouse = tables.Warehouse(spark, f"{root}/tables")
    monthly.build_dim_zones(warehouse, zone_lookup(spark, sf_dir), AS_OF)
    job = monthly.Job(warehouse, f"{root}/landing", "delivery={month}", AS_OF)
    summary = short.run_months_lite(job, months, "run-1")
    frame = monthly.summary_frame(job, summary)
    return frame.select("execution_date", "status", "total_trips", "total_revenue", "rows_ingested", "rows_bronze")


QUERIES: dict[str, Query] = {
    "kpi_daily_revenue": daily,
    "kpi_zone_performance": zone_performance,
    "kpi_hourly_patterns": hourly_patterns,
    "scan_raw_trips": scan_raw_trips,
    "conform_bronze_schema": conform_bronze_schema,
    "add_audit_columns": add_audit_columns,
    "normalize_column_names": normalize_column_names,
    "append_bronze": append_bronze,
    "skip_loaded_files": skip_loaded_files,
    "write_silver_partitioned": write_silver_partitioned,
    "republished_silver": republished_silver,
    "write_gold_tables": write_gold_tables,
    "gold_in_order": gold_in_order,
    "scan_zone_lookup": scan_zones,
    "append_metadata_rows": append_metadata_rows,
    "validate_not_empty": validate_not_empty,
    "validate_required_columns": validate_required_columns,
    "validate_month_ratio": validate_month_ratio,
    "validation_report": validation_report,
    "dedup_latest_trip": dedup_latest_trip,
    "rename_and_type": _derived(trips.identity_columns),
    "extract_calendar_parts": _derived(trips.calendar_columns),
    "default_and_floor_measures": _derived(
        trips.passenger_column, trips.distance_column, trips.amount_columns
    ),
    "trip_duration_minutes": _derived(trips.duration_column),
    "tip_rate": _derived(trips.tip_rate_column),
    "revenue_per_minute": _derived(trips.revenue_per_minute_column),
    "decode_payment_type": _derived(trips.payment_type_column),
    "decode_rate_code": _derived(trips.rate_code_column),
    "store_and_forward_flag": _derived(trips.store_and_forward_column),
    "airport_trip_flag": _derived(trips.airport_trip_column),
    "filter_valid_trips": filter_valid_trips,
    "clean_trips": silver,
    "rejected_trips": rejected_trips,
    "rejected_trips_by_reason": rejected_trips_by_reason,
    "clean_trips_lite": clean_trips_lite,
    "dim_zones": zone_table,
    "borough_group": borough_group,
    "zone_is_airport": zone_is_airport,
    "join_trips_zones": join_trips_zones,
    "merge_insert_new_trips": merge_insert_new_trips,
    "merge_insert_new_trips_null_safe": merge_null_safe,
    "merge_indexed": merge_indexed,
    "kpi_daily_revenue_lite": daily_lite,
    "kpi_zone_performance_lite": zones_lite,
    "kpi_hourly_patterns_lite": hourly_lite,
    "gold_month_stats": month_stats,
    "rank_zones_in_borough": _zone_window(zones.rank_zones_in_borough),
    "rank_zones_overall": _zone_window(zones.rank_zones_overall),
    "revenue_share_in_borough": _zone_window(zones.revenue_share_in_borough),
    "demand_index": hourly_demand_index,
    "day_name_and_type": day_name_and_type,
    "time_of_day_segment": hour_segments,
    "recent_runs": recent_runs,
    "rows_from_structs": rows_from_structs,
    "dq_not_null_pickup": _one_check("not_null_pickup_datetime"),
    "dq_min_row_count": _one_check("minimum_row_count"),
    "dq_no_future_pickup": _one_check("no_future_pickup_dates"),
    "dq_valid_location_ids": _raw_check("valid_location_ids"),
    "dq_non_negative_amounts": _one_check("non_negative_amounts"),
    "dq_trip_duration_range": _raw_check("trip_duration_range_1_to_300_min"),
    "dq_daily_completeness": _one_check("daily_revenue_completeness"),
    "dq_positive_daily_revenue": _one_check("positive_daily_revenue"),
    "dq_run_all": check_results,
    "dq_bronze_inline": dq_bronze_inline,
    "dq_gate_summary": dq_gate_summary,
    "gold_min_trips_gate": gold_min_trips_gate,
    "failure_pct": failure_pct,
    "log_run_start": log_run_start,
    "log_run_end": log_run_end,
    "log_quality_results": log_quality_results,
    "run_history": run_history,
    "quality_trend": quality_trend,
    "latest_run_status": latest_run_status,
    "run_month": run_month,
    "run_months": run_months,
    "run_months_lite": run_months_lite,
}
