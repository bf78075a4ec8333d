import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.months import at, month_start
from fareloom.operators import trips
from fareloom.operators.daily import kpi_daily_revenue
from fareloom.operators.hourly import kpi_hourly_patterns
from fareloom.operators.zones import dim_zones, kpi_zone_performance
from fareloom.plans import monthly
from fareloom.sources import landing, tables

from .conftest import SF, plan_of

AS_OF = dt.datetime(2024, 6, 1)
GOLD = tuple(tables.GOLD_TABLES)


def month_of_trips(spark, month, rows=1500, days=28):
    """Valid raw trips spread over the days of a month."""
    n = F.col("id")
    start = at(dt.datetime.combine(month_start(month), dt.time()))
    pickup = F.timestamp_add("SECOND", n % days * 86400 + n * 53 % 86000, start)
    values = {
        "VendorID": n % 2 + 1,
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": F.timestamp_add("MINUTE", n % 50 + 1, pickup),
        "passenger_count": n % 5,
        "trip_distance": n % 30 / 4,
        "RatecodeID": n % 7,
        "store_and_fwd_flag": F.lit("N"),
        "PULocationID": n % 265 + 1,
        "DOLocationID": n * 7 % 265 + 1,
        "payment_type": n % 6,
        "fare_amount": n % 90 / 2 + 3,
        "total_amount": n % 90 / 2 + 5.25,
        "tip_amount": n % 4 / 2,
    }
    return spark.range(rows).select(
        *[
            values.get(f.name, F.lit(0.5)).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_TRIPS.fields
        ]
    )


def deliver(job, month, raw):
    raw.write.mode("overwrite").parquet(f"{job.landing}/{landing.file_name(month)}")


@pytest.fixture
def job(spark, warehouse, lookup, tmp_path):
    monthly.build_dim_zones(warehouse, lookup, AS_OF)
    return monthly.Job(warehouse, str(tmp_path / "landing"), as_of=AS_OF)


def contents(warehouse):
    """All rows of silver and gold, without the column that tells when they were made."""
    rows = {"trips": warehouse.silver_trips().drop("_ingested_at")}
    rows |= {table: warehouse.read("gold", table) for table in GOLD}
    return {name: sorted(map(str, frame.collect())) for name, frame in rows.items()}


def test_a_month_end_to_end(spark, job, lookup):
    raw = month_of_trips(spark, "2024-01")
    deliver(job, "2024-01", raw)
    summary = monthly.run_month(job, "2024-01", "run-1")
    assert summary["status"] == "COMPLETED"
    assert summary["rows_ingested"] == summary["rows_bronze"] == 1500
    warehouse = job.warehouse

    silver = warehouse.silver_trips()
    assert summary["total_trips"] == summary["rows_silver"] == silver.count() > 1000
    expected = {
        "kpi_daily_revenue": kpi_daily_revenue(silver, "2024-01", AS_OF),
        "kpi_zone_performance": kpi_zone_performance(
            silver, dim_zones(lookup, AS_OF), "2024-01", AS_OF
        ),
        "kpi_hourly_patterns": kpi_hourly_patterns(silver, "2024-01", AS_OF),
    }
    for table, rows in expected.items():
        written = warehouse.read("gold", table).select(*rows.columns)
        assert written.exceptAll(rows).count() == 0 and written.count() == rows.count()
    assert summary["rows_gold"] == sum(rows.count() for rows in expected.values())

    events = tables.read_metadata(warehouse, "pipeline_runs")
    assert sorted(r["status"] for r in events.collect()) == ["COMPLETED", "STARTED"]
    results = tables.read_metadata(warehouse, "quality_checks")
    assert results.count() == 8 and results.where("status <> 'PASSED'").count() == 0
    assert results.where("table_name = 'dev_silver.trips'").count() == 3

    # Again: bronze keeps both deliveries, silver and gold do not change.
    before = contents(warehouse)
    again = monthly.run_month(job, "2024-01", "run-2")
    assert warehouse.bronze_trips().count() == 3000
    assert contents(warehouse) == before
    assert again["total_revenue"] == summary["total_revenue"]

    # With loaded files skipped bronze does not change either.
    skipping = monthly.Job(warehouse, job.landing, as_of=AS_OF, skip_loaded=True)
    progress = monthly.Progress(["2024-01"])
    delivered = monthly.scan_delivered(skipping, monthly.delivered_schemas(skipping, progress))
    monthly.load_bronze(skipping, delivered, progress)
    assert progress.known["2024-01"]["rows_ingested"] == 0
    assert warehouse.bronze_trips().count() == 3000


def test_months_together_equal_months_alone(spark, job, tmp_path, lookup):
    months = ["2023-12", "2024-01"]
    for i, month in enumerate(months):
        deliver(job, month, month_of_trips(spark, month, 1400 + 200 * i))
    alone = [monthly.run_month(job, month, "run") for month in months]
    other = tables.Warehouse(spark, str(tmp_path / "together"))
    monthly.build_dim_zones(other, lookup, AS_OF)
    together = monthly.run_months(
        monthly.Job(other, job.landing, as_of=AS_OF), months, "run"
    )
    assert together == alone
    assert contents(other) == contents(job.warehouse)


def test_a_bad_month_does_not_hold_up_a_good_one(spark, job):
    good = month_of_trips(spark, "2024-01")
    deliver(job, "2024-01", good)
    deliver(job, "2024-02", good)
    deliver(job, "2024-03", month_of_trips(spark, "2024-03", 500))
    deliver(job, "2024-04", month_of_trips(spark, "2024-04").drop("total_amount"))
    months = ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]
    summary = {row["execution_date"]: row for row in monthly.run_months(job, months, "run")}
    assert summary["2024-01"]["status"] == "COMPLETED"
    messages = {month: summary[month].get("error_message", "") for month in months}
    assert "within expected month 2024-02" in messages["2024-02"]
    assert "minimum_row_count" in messages["2024-03"]
    assert "Missing required column: total_amount" in messages["2024-04"]
    assert "no raw file" in messages["2024-05"]
    assert job.warehouse.silver_trips().count() == summary["2024-01"]["rows_silver"]
    assert job.warehouse.bronze_trips("2024-02").count() == 0
    events = tables.read_metadata(job.warehouse, "pipeline_runs")
    assert events.where("status = 'FAILED'").count() == 4
    assert monthly.summary_frame(job, list(summary.values())).count() == 5
    with pytest.raises(monthly.RunFailedError, match="2024-05"):
        monthly.run_month(job, "2024-05")


def test_files_of_different_types_are_loaded_together(spark, job):
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    newer = month_of_trips(spark, "2024-02").withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("long"),
            "VendorID": F.col("VendorID").cast("int"),
        }
    )
    renamed = newer.withColumnRenamed("airport_fee", "Airport_fee ")
    deliver(job, "2024-02", renamed.withColumn("new_fee", F.lit(1)))
    summary = monthly.run_months(job, ["2024-01", "2024-02"], "run")
    assert [row["status"] for row in summary] == ["COMPLETED", "COMPLETED"]
    assert job.warehouse.bronze_trips("2024-02").where("airport_fee = 0.5").count() == 1500


def test_dry_run_writes_nothing(spark, job):
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    (summary,) = monthly.run_months(job, "2024-01", dry_run=True)
    assert summary["rows_ingested"] == 1500 and summary["status"] == "COMPLETED"
    assert job.warehouse.bronze_trips().count() == 0
    assert tables.read_metadata(job.warehouse, "pipeline_runs").count() == 0


def test_an_error_is_logged_and_raised(spark, warehouse, tmp_path):
    """Without a zone dimension the KPI tables cannot be built."""
    job = monthly.Job(warehouse, str(tmp_path / "landing"), as_of=AS_OF)
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    with pytest.raises(Exception, match="dim_zones"):
        monthly.run_month(job, "2024-01", "run")
    last = tables.read_metadata(warehouse, "pipeline_runs").where("status = 'FAILED'").first()
    assert "dim_zones" in last["error_message"]


def test_default_month_is_the_previous_one(job):
    with pytest.raises(monthly.RunFailedError, match="2024-05"):
        monthly.run_month(job)


# The plans of the heavy steps


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from suite.inputs import bronze

    warehouse = tables.Warehouse(spark, str(tmp_path_factory.mktemp("stored")))
    tables.append_bronze(warehouse, bronze(spark, SF))
    return warehouse


def test_silver_is_one_shuffle_with_the_month_pushed_down(stored):
    plan = plan_of(trips.clean_trips(stored.bronze_trips("1996-12"), "1996-12"))
    tree = plan.split("\n\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1996-12-01T00:00)" in plan
    assert "LessThan(tpep_pickup_datetime,1997-01-01T00:00)" in plan
    assert "Python" not in plan and "BatchEval" not in plan


def test_daily_reads_only_its_columns(spark, stored):
    path = stored.path("silver", "plain")
    trips.clean_trips(stored.bronze_trips()).write.mode("overwrite").parquet(path)
    silver = spark.read.parquet(path)
    plan = plan_of(kpi_daily_revenue(silver, "1996-12"))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "pickup_datetime" not in schema and "rate_code" not in schema
    assert "GreaterThanOrEqual(pickup_date,1996-12-01)" in plan
    assert plan.split("\n\n\n")[0].count("Exchange") == 1
    hourly = plan_of(kpi_hourly_patterns(silver, "1996-12"))
    assert "SinglePartition" not in hourly


def test_no_plan_uses_python_or_a_cross_join(spark):
    import __spark_entry__

    heavy = (
        "kpi_daily_revenue",
        "kpi_zone_performance",
        "kpi_hourly_patterns",
        "kpi_zone_performance_lite",
        "dedup_latest_trip",
        "rejected_trips_by_reason",
        "join_trips_zones",
        "merge_insert_new_trips",
        "merge_insert_new_trips_null_safe",
        "skip_loaded_files",
        "validation_report",
        "dq_run_all",
        "latest_run_status",
        "quality_trend",
    )
    queries = __spark_entry__.queries()
    for name in heavy:
        plan = plan_of(queries[name](spark, SF))
        for word in ("ArrowEval", "BatchEvalPython", "CartesianProduct", "NestedLoopJoin"):
            assert word not in plan, (name, word)
        assert "SinglePartition" not in plan, name
