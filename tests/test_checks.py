import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.operators import checks, runs, trips, validation
from fareloom.operators.daily import kpi_daily_revenue
from fareloom.plans.quality import collect_layer_checks
from fareloom.sources import tables

from .conftest import INGESTED, trip

AS_OF = dt.datetime(2024, 6, 1)


def repeated(spark, values, numbers):
    """A frame with one row per value, each repeated."""
    parts = [
        spark.range(n).select(*[F.lit(v).alias(k) for k, v in row.items()])
        for row, n in zip(values, numbers, strict=True)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("_execution_date", F.lit("2024-01"))


def result(table, layer, name, months="2024-01"):
    chosen = checks.checks_of(layer, name)
    frame = checks.run_layer_checks(table, layer, months, AS_OF, chosen)
    return frame.first()


PICKUP = dt.datetime(2024, 1, 15, 8)


@pytest.mark.parametrize(
    ("nulls", "status", "rate"), [(0, "PASSED", 0.0), (5, "FAILED", 0.005)]
)
def test_missing_pickups(spark, nulls, status, rate):
    column = "tpep_pickup_datetime"
    table = repeated(spark, [{column: PICKUP}, {column: None}], [1000 - nulls, nulls])
    row = result(table, "bronze", "not_null_pickup_datetime")
    assert (row["status"], row["failure_rate"], row["rows_tested"]) == (status, rate, 1000)
    assert row["details"] == f"{nulls} NULL pickup datetimes out of 1000 rows"


@pytest.mark.parametrize(("rows", "status"), [(999, "FAILED"), (1000, "PASSED"), (0, "FAILED")])
def test_row_count(spark, rows, status):
    table = repeated(spark, [{"tpep_pickup_datetime": PICKUP}], [rows])
    row = result(table, "bronze", "minimum_row_count")
    assert row["status"] == status
    assert row["rows_failed"] == (status == "FAILED")
    assert row["details"] == f"Row count: {rows:,}. Minimum expected: 1,000"


def test_future_pickups_only_warn(spark):
    later = AS_OF + dt.timedelta(seconds=1)
    values = [{"tpep_pickup_datetime": AS_OF}, {"tpep_pickup_datetime": later}]
    row = result(repeated(spark, values, [997, 3]), "bronze", "no_future_pickup_dates")
    assert (row["status"], row["rows_failed"]) == ("WARNING", 3)
    row = result(repeated(spark, values, [1000, 0]), "bronze", "no_future_pickup_dates")
    assert row["status"] == "PASSED"


@pytest.mark.parametrize(
    ("bad", "rows", "status"),
    [(5, 1_000_000, "PASSED"), (100, 100_000, "PASSED"), (101, 100_000, "FAILED")],
)
def test_zones(spark, bad, rows, status):
    values = [
        {"pickup_location_id": 5, "dropoff_location_id": 265},
        {"pickup_location_id": 5, "dropoff_location_id": 266},
    ]
    row = result(repeated(spark, values, [rows - bad, bad]), "silver", "valid_location_ids")
    assert (row["status"], row["rows_failed"]) == (status, bad)


def test_missing_zones_are_not_counted(spark):
    values = [{"pickup_location_id": None, "dropoff_location_id": 5}]
    table = repeated(spark, values, [10]).withColumn(
        "pickup_location_id", F.col("pickup_location_id").cast("long")
    )
    assert result(table, "silver", "valid_location_ids")["status"] == "PASSED"


def test_negative_amounts(spark):
    values = [
        {"total_amount": 1.0, "fare_amount": 0.0},
        {"total_amount": 1.0, "fare_amount": -0.01},
    ]
    for bad, status in ((0, "PASSED"), (1, "FAILED")):
        row = result(repeated(spark, values, [500, bad]), "silver", "non_negative_amounts")
        assert row["status"] == status


@pytest.mark.parametrize(
    ("bad", "status", "percent"),
    [(2_000, "PASSED", "0.20%"), (5_000, "PASSED", "0.50%"), (5_001, "WARNING", "0.50%")],
)
def test_durations(spark, bad, status, percent):
    values = [{"trip_duration_min": 300}, {"trip_duration_min": 301}]
    row = result(
        repeated(spark, values, [1_000_000 - bad, bad]),
        "silver",
        "trip_duration_range_1_to_300_min",
    )
    assert row["status"] == status
    assert row["details"].endswith(f"[1, 300] minutes ({percent})")


@pytest.mark.parametrize(("days", "status"), [(31, "PASSED"), (25, "PASSED"), (24, "FAILED")])
def test_days(spark, days, status):
    first = dt.date(2024, 1, 1)
    rows = [(first + dt.timedelta(days=i), 5.0) for i in range(days)]
    table = spark.createDataFrame(rows, "pickup_date date, total_revenue double")
    row = result(table, "gold", "daily_revenue_completeness")
    assert (row["status"], row["rows_tested"]) == (status, days)
    assert row["details"].startswith(f"{days} days found in kpi_daily_revenue for 2024-01.")


@pytest.mark.parametrize(("revenue", "status"), [(0.01, "PASSED"), (0.0, "FAILED")])
def test_daily_revenue(spark, revenue, status):
    rows = [(dt.date(2024, 1, 1), revenue)]
    table = spark.createDataFrame(rows, "pickup_date date, total_revenue double")
    assert result(table, "gold", "positive_daily_revenue")["status"] == status


def test_all_checks_of_the_sample(sample):
    silver = trips.clean_trips(sample, "2024-01")
    daily = kpi_daily_revenue(silver, "2024-01")
    results = checks.run_all_checks(sample, silver, daily, "2024-01", AS_OF)
    rows = results.collect()
    assert [row["check_name"] for row in rows] == [check.name for check in checks.CHECKS]
    failed = {row["check_name"] for row in rows if row["status"] != "PASSED"}
    assert failed == {"minimum_row_count", "daily_revenue_completeness"}
    (gate,) = checks.gate_summary(results).collect()
    assert (gate["passed"], gate["warnings"], gate["failed"]) == (6, 0, 2)
    assert gate["verdict"] == "FAIL"
    with pytest.raises(checks.QualityGateError, match="2 check"):
        checks.require_gate(results)
    checks.require_gate(results.where("status <> 'FAILED'"))


def test_months_without_rows_are_tested(sample):
    rows = checks.run_layer_checks(sample, "bronze", ["2024-01", "2024-02"], AS_OF).collect()
    empty = [row for row in rows if row["execution_date"] == "2024-02"]
    assert [row["status"] for row in empty] == ["PASSED", "FAILED", "PASSED"]
    assert {row["rows_tested"] for row in empty} == {0}


def test_inline_check(frame):
    rows = frame([trip(), trip(pickup=None)])
    results = checks.check_bronze_inline(rows, ["2024-01", "2024-02"]).collect()
    found = {row["execution_date"]: row for row in results}
    assert found["2024-01"]["status"] == "FAILED"
    assert found["2024-01"]["failure_rate"] == 0.5
    assert found["2024-02"]["status"] == "PASSED"
    assert found["2024-02"]["failure_rate"] is None


def test_one_broken_check_does_not_stop_the_others(spark):
    """Without fare amounts one silver check cannot run; the other two still do."""
    values = [{"pickup_location_id": 1, "dropoff_location_id": 1, "trip_duration_min": 5}]
    table = repeated(spark, values, [3])
    rows = collect_layer_checks("silver", ["2024-01"], lambda: table)
    assert [row["status"] for row in rows] == ["PASSED", "FAILED", "PASSED"]
    assert rows[1]["layer"] == "unknown"
    assert rows[1]["details"].startswith("Check raised exception: ")


def test_min_trips_gate(spark):
    rows = [(dt.date(2024, m, 1), n, 1.0) for m, n in ((1, 999), (2, 1000))]
    daily = spark.createDataFrame(rows, "pickup_date date, total_trips long, total_revenue double")
    results = checks.min_trips_gate(daily).collect()
    found = {row["_execution_date"]: row["enough_trips"] for row in results}
    assert found == {"2024-01": False, "2024-02": True}


# Validation before loading


def report(frame, rows, months=None, drop=()):
    raw = frame(rows).drop("_ingested_at", *drop)
    rows = validation.validation_report(raw, months).collect()
    return {row["_execution_date"]: row for row in rows}


def test_valid_sample(frame, sample):
    raw = sample.drop("_ingested_at")
    (row,) = validation.validation_report(raw, "2024-01").collect()
    assert (row["valid"], row["row_count"], row["column_count"], row["issues"]) == (True, 5, 19, [])


@pytest.mark.parametrize(("inside", "valid"), [(8, True), (7, False), (1, False)])
def test_share_of_the_month(frame, inside, valid):
    outside = [trip(pickup="2023-06-01 08:00:00")] * (9 - inside)
    rows = [trip()] * inside + outside + [trip(pickup=None)]
    row = report(frame, rows)["2024-01"]
    assert row["valid"] == valid
    if not valid:
        assert row["issues"] == [
            f"Only {inside * 10}.0% of rows are within expected month 2024-01"
        ]


def test_empty_and_missing(frame):
    rows = report(frame, [trip()], ["2024-01", "2024-02"], drop=["total_amount"])
    assert rows["2024-01"]["issues"] == ["Missing required column: total_amount"]
    assert rows["2024-02"]["issues"][0].startswith("DataFrame is empty")
    rows = report(frame, [trip()], drop=["tpep_pickup_datetime"])
    assert rows["2024-01"]["issues"] == ["Missing required column: tpep_pickup_datetime"]


def test_require_valid(frame):
    good = validation.validation_report(frame([trip()]))
    validation.require_valid(good)
    with pytest.raises(validation.ValidationError, match="2024-01"):
        validation.require_valid(validation.validation_report(frame([trip(pickup=None)])))


# Run metadata


def test_run_events(warehouse):
    end = INGESTED + dt.timedelta(seconds=90)
    runs.log_run_start(warehouse, "a", ["2024-01", "2024-02"], INGESTED)
    outcomes = [
        {"execution_date": "2024-01", "status": "COMPLETED", "rows_ingested": 5},
        {"execution_date": "2024-02", "status": "FAILED", "error_message": "no file"},
    ]
    runs.log_run_end(warehouse, "a", outcomes, INGESTED, end)
    runs.log_run_start(warehouse, "b", ["2024-01"], end)
    events = tables.read_metadata(warehouse, "pipeline_runs")
    assert events.count() == 5
    latest = {
        (r["run_id"], r["execution_date"]): r["status"]
        for r in runs.latest_run_status(events).collect()
    }
    assert latest == {
        ("a", "2024-01"): "COMPLETED",
        ("a", "2024-02"): "FAILED",
        ("b", "2024-01"): "STARTED",
    }
    assert runs.recent_runs(events, 2).count() == 2
    newest = runs.run_history(events, 1).first()
    assert newest["run_id"] == "b"
    done = events.where("status = 'COMPLETED'").first()
    assert done["duration_seconds"] == 90.0


def test_metadata_rejects_unknown_columns(warehouse):
    with pytest.raises(ValueError, match="colour"):
        tables.append_metadata(warehouse, "pipeline_runs", [{"run_id": "a", "colour": 1}])
    assert tables.read_metadata(warehouse, "pipeline_runs").count() == 0


def test_metadata_requires_its_columns(warehouse):
    with pytest.raises(Exception, match="execution_date"):
        tables.append_metadata(warehouse, "pipeline_runs", [{"run_id": "a"}])
