"""Rewrites that are published in one step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.operators.trips import clean_trips
from fareloom.plans import monthly
from fareloom.sources import tables, versions

from .conftest import SAMPLE, trip
from .test_pipeline import AS_OF, GOLD, contents, deliver, job, month_of_trips  # noqa: F401

FEBRUARY = trip("2024-02-03 08:00:00", "2024-02-03 08:20:00", _execution_date="2024-02")


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def failing(rows):
    """Trips the write of which fails after some rows."""
    return rows.withColumn(
        "vendor_id", F.when(F.col("pickup_location_id") == 20, F.raise_error(F.lit("lost"))).otherwise(F.col("vendor_id"))
    )


def test_a_rewrite_that_fails_changes_nothing(warehouse, frame):
    silver = clean_trips(frame([*SAMPLE, FEBRUARY]))
    tables.write_silver_trips(warehouse, silver)
    before = rows_of(warehouse.silver_trips())
    # While it is written ...
    with pytest.raises(Exception, match="lost"):
        tables.write_silver_trips(warehouse, failing(clean_trips(frame(SAMPLE))), "2024-01")
    assert rows_of(warehouse.silver_trips()) == before
    # ... and between staging and publishing.
    staged = tables.stage_silver_trips(warehouse, clean_trips(frame(SAMPLE[:1])), "2024-01")
    assert rows_of(warehouse.silver_trips()) == before
    assert rows_of(warehouse.silver_trips("2024-01")) == rows_of(silver.where("pickup_month = 1"))
    warehouse.publish(staged)
    assert warehouse.silver_trips("2024-01").count() == 1 and warehouse.silver_trips().count() == 2
    assert rows_of(warehouse.silver_trips("2024-02")) == rows_of(silver.where("pickup_month = 2"))


def test_gold_tables_are_published_together(spark, job, monkeypatch):  # noqa: F811
    deliver(job, "2024-01", month_of_trips(spark, "2024-01"))
    monthly.run_month(job, "2024-01", "run-1")
    before = contents(job.warehouse)
    fewer = job.warehouse.silver_trips().where("pickup_location_id < 100")
    tables.write_silver_trips(job.warehouse, fewer, "2024-01")

    def stopped(self, *staged):
        assert len(staged) == 3
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables.Warehouse, "publish", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            monthly.build_gold(job.warehouse, "2024-01", AS_OF)
    after = contents(job.warehouse)
    assert [after[table] for table in GOLD] == [before[table] for table in GOLD]
    assert after["trips"] != before["trips"]
    monthly.build_gold(job.warehouse, "2024-01", AS_OF)
    assert all(contents(job.warehouse)[table] != before[table] for table in GOLD)


def test_months_come_from_the_last_version_that_held_them(warehouse, frame):
    march = trip("2024-03-03 08:00:00", "2024-03-03 08:20:00", _execution_date="2024-03")
    tables.write_silver_trips(warehouse, clean_trips(frame([*SAMPLE, FEBRUARY, march])))
    tables.write_silver_trips(warehouse, clean_trips(frame([])), ["2024-01", "2024-04"])
    assert warehouse.silver_trips("2024-01").count() == 0
    assert warehouse.silver_trips(["2024-02", "2024-03"]).count() == 2 == warehouse.silver_trips().count()
    tables.write_silver_trips(warehouse, clean_trips(frame(SAMPLE[:2])), full_replace=True)
    assert warehouse.silver_trips().count() == 2 and warehouse.silver_trips("2024-02").count() == 0
    log = versions.publications(warehouse.spark, warehouse.publications)
    assert [row["sequence"] for row in log] == [1, 2, 3] and log[2]["whole"]


def test_vacuum_deletes_what_no_reader_sees(warehouse, frame):
    tables.write_silver_trips(warehouse, clean_trips(frame([*SAMPLE, FEBRUARY])))
    tables.write_silver_trips(warehouse, clean_trips(frame(SAMPLE[:2])), "2024-01")
    assert warehouse.vacuum("silver", "trips") == []  # February is still read from the first
    tables.write_silver_trips(warehouse, clean_trips(frame([FEBRUARY])), "2024-02")
    before = rows_of(warehouse.silver_trips())
    assert len(warehouse.vacuum("silver", "trips")) == 1
    assert rows_of(warehouse.silver_trips()) == before and warehouse.vacuum("gold", "kpi_daily_revenue") == []


def test_only_published_folders_are_opened(warehouse, frame):
    tables.write_silver_trips(warehouse, clean_trips(frame([*SAMPLE, FEBRUARY])))
    tables.write_silver_trips(warehouse, clean_trips(frame(SAMPLE[:2])), "2024-01")
    files = warehouse.silver_trips().inputFiles()
    assert len({f.split("version=")[1].split("/")[0] for f in files}) == 2
    assert not any("pickup_date=2024-02" in f for f in warehouse.silver_trips("2024-01").inputFiles())


def test_a_table_that_was_never_written(warehouse):
    assert warehouse.silver_trips().count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.read("gold", "kpi_daily_revenue")


def test_full_replace_of_a_job_drops_other_months(spark, job):  # noqa: F811
    for month in ("2023-12", "2024-01"):
        deliver(job, month, month_of_trips(spark, month))
    monthly.run_months(job, ["2023-12", "2024-01"], "run")
    whole = monthly.Job(job.warehouse, job.landing, as_of=AS_OF, full_replace=True)
    monthly.run_months(whole, "2024-01", "again")
    assert job.warehouse.silver_trips("2023-12").count() == 0 < job.warehouse.silver_trips("2024-01").count()
    daily = job.warehouse.read("gold", "kpi_daily_revenue")
    assert {row[0] for row in daily.select("_execution_date").distinct().collect()} == {"2024-01"}
    assert daily.agg(F.min("pickup_date")).first()[0] == dt.date(2024, 1, 1)
