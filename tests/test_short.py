"""The short job, the quality run as one action, and runs that go on after a failure."""

import pytest
from pyspark.sql import functions as F

from fareloom.operators import checks, lite, runs
from fareloom.plans import monthly, short
from fareloom.plans.quality import run_quality
from fareloom.sources import tables

from .conftest import trip
from .test_pipeline import AS_OF, contents, deliver, job, month_of_trips  # noqa: F401


def test_short_job(spark, job):  # noqa: F811
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    deliver(job, "2024-02", month_of_trips(spark, "2024-02", 400))
    months = ["2024-01", "2024-02", "2024-03"]
    first = {row["execution_date"]: row for row in short.run_months_lite(job, months, "run-1", null_safe=True)}
    assert [first[m]["status"] for m in months] == ["COMPLETED", "FAILED", "FAILED"]
    assert "too few trips" in first["2024-02"]["error_message"] and "no raw file" in first["2024-03"]["error_message"]
    warehouse = job.warehouse
    bronze = warehouse.bronze_trips()
    assert bronze.select(*tables.schemas.TRIP_KEY).distinct().count() == bronze.count()

    silver = warehouse.read("silver", "trips_lite")
    expected = lite.clean_trips_lite(bronze)
    assert sorted(map(str, silver.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    daily = warehouse.read("gold", "kpi_daily_revenue_lite")
    made = lite.kpi_daily_revenue_lite(expected, as_of=AS_OF)
    assert sorted(map(str, daily.select(*made.columns).collect())) == sorted(map(str, made.collect()))
    assert first["2024-01"]["total_trips"] == silver.where("_execution_date = '2024-01'").count()
    for table in ("kpi_zone_performance_lite", "kpi_hourly_patterns_lite"):
        assert warehouse.read("gold", table).where("_execution_date = '2024-01'").count() > 0
    logged = tables.read_metadata(warehouse, "quality_checks").collect()
    assert {(r["execution_date"], r["status"]) for r in logged} == {("2024-01", "PASSED"), ("2024-02", "PASSED")}

    # Again: no key is inserted twice, the tables do not change.
    before = sorted(map(str, daily.collect()))
    again = short.run_months_lite(job, "2024-01", "run-2", null_safe=True)
    assert again[0]["rows_ingested"] == 0 and again[0]["total_trips"] == first["2024-01"]["total_trips"]
    assert sorted(map(str, warehouse.read("gold", "kpi_daily_revenue_lite").collect())) == before
    status = runs.latest_run_status(tables.read_metadata(warehouse, "pipeline_runs")).collect()
    assert {(r["run_id"], r["execution_date"]): r["status"] for r in status}["run-2", "2024-01"] == "COMPLETED"


def test_quality_run_logs_sums_up_and_stops(spark, job, frame):  # noqa: F811
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    monthly.run_month(job, "2024-01", "run-1")
    summary = run_quality(job.warehouse, "quality-1", "2024-01", as_of=AS_OF)
    assert summary == {"2024-01": {"passed": 8, "warnings": 0, "failed": 0, "verdict": "PASS"}}
    late = trip("2031-01-01 00:00:00", "2031-01-01 00:10:00", _execution_date="2024-01")
    tables.append_bronze(job.warehouse, frame([trip(None), late]))
    with pytest.raises(checks.QualityGateError, match="not_null_pickup_datetime \\(2024-01\\)"):
        run_quality(job.warehouse, "quality-2", ["2024-01"], as_of=AS_OF)
    logged = tables.read_metadata(job.warehouse, "quality_checks").where("run_id = 'quality-2'")
    assert {r["status"]: r["count"] for r in logged.groupBy("status").count().collect()} == {
        "PASSED": 6, "WARNING": 1, "FAILED": 1,
    }
    told = run_quality(job.warehouse, "quality-3", "2024-01", ("bronze",), AS_OF, enforce=False)
    assert told["2024-01"] == {"passed": 1, "warnings": 1, "failed": 1, "verdict": "FAIL"}


def test_a_failed_run_goes_on_after_its_last_layer(spark, job, monkeypatch):  # noqa: F811
    for month in ("2023-12", "2024-01"):
        deliver(job, month, month_of_trips(spark, month))
    months = ["2023-12", "2024-01"]

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(monthly, "build_gold", lost)
        with pytest.raises(RuntimeError, match="lost"):
            monthly.run_months(job, months, "run-1")
    files = set(job.warehouse.silver_trips().inputFiles())
    summary = monthly.run_months(job, months, "run-1")
    assert [row["status"] for row in summary] == ["COMPLETED"] * 2
    assert [row["rows_ingested"] for row in summary] == [1500, 1500]
    assert set(job.warehouse.silver_trips().inputFiles()) == files
    assert job.warehouse.bronze_trips().count() == 3000

    resumed = contents(job.warehouse)
    monthly.run_months(job, months, "run-2")  # another run builds all layers
    assert job.warehouse.bronze_trips().count() == 6000
    assert contents(job.warehouse) == resumed
    assert not set(job.warehouse.silver_trips().inputFiles()) & files
    assert job.warehouse.silver_trips().agg(F.count_distinct("pickup_month")).first()[0] == 2
