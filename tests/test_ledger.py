"""Files known before they are read: landed ones, and the days bronze holds."""

import os

import pytest
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.operators.merge import merge_insert_new_trips
from fareloom.plans import monthly
from fareloom.sources import landing, ledger, tables

from .conftest import SAMPLE, plan_of, trip
from .test_pipeline import AS_OF, deliver, job, month_of_trips  # noqa: F401


def files_read(frame) -> int:
    """Files that the scans of a collected frame opened."""
    total, frame_plan = 0, frame._jdf.queryExecution().executedPlan()
    frame.collect()
    todo = [frame_plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_loaded_files_never_enter_the_scan(spark, job):  # noqa: F811
    for month in ("2023-12", "2024-01"):
        deliver(job, month, month_of_trips(spark, month))
    monthly.run_month(job, "2023-12", "run-1")
    entered = ledger.landed_files(job.warehouse).collect()
    assert {row["_execution_date"] for row in entered} == {"2023-12"}
    assert sum(row["rows"] for row in entered) == 1500 and all(row["bytes"] > 0 for row in entered)

    delivered = ledger.delivered_files(spark, job.landing)
    new = ledger.new_files(job.warehouse, delivered).collect()
    assert {row["_execution_date"] for row in new} == {"2024-01"}
    (raw,) = monthly.scan_delivered(
        job, monthly.delivered_schemas(job, monthly.Progress(["2023-12", "2024-01"]))
    )
    kept = raw.where(F.col("_source_file").isin([row["_source_file"] for row in new]))
    assert files_read(kept) == len(new) < len(raw.inputFiles())
    assert "Join" not in plan_of(kept)

    skipping = monthly.Job(job.warehouse, job.landing, as_of=AS_OF, skip_loaded=True)
    summary = monthly.run_months(skipping, ["2023-12", "2024-01"], "run-2")
    assert [row["rows_ingested"] for row in summary] == [0, 1500]
    assert job.warehouse.bronze_trips().count() == 3000
    again = monthly.run_months(skipping, ["2023-12", "2024-01"], "run-3")
    assert [row["rows_ingested"] for row in again] == [0, 0]
    assert job.warehouse.bronze_trips().count() == 3000


def test_files_loaded_before_there_was_a_ledger(warehouse, frame):
    tables.append_bronze(warehouse, frame([*SAMPLE, trip(_source_file="b"), trip(_source_file=None)]))
    ledger.enter_bronze_files(warehouse, AS_OF)
    ledger.enter_bronze_files(warehouse, AS_OF)
    rows = {row["_source_file"]: row["rows"] for row in ledger.landed_files(warehouse).collect()}
    assert rows == {SAMPLE[0]["_source_file"]: 5, "b": 1}
    files = frame([trip(_source_file=name) for name in ("b", "c")]).select("_source_file", "_execution_date")
    left = landing.skip_loaded_files(files, ledger.landed_files(warehouse)).collect()
    assert [row["_source_file"] for row in left] == ["c"]


def test_counts_of_an_append_need_no_second_pass(warehouse, frame, spark):
    seen = spark.sparkContext.accumulator(0)
    other = trip(_execution_date="2024-02", _source_file="b")
    rows = frame([*SAMPLE, other])

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counts = tables.append_bronze(
        warehouse, rows.mapInArrow(counted, rows.schema), ["2024-01", "2024-02", "2024-03"]
    )
    assert counts == {"2024-01": 5, "2024-02": 1} and seen.value == 6


def test_row_groups_are_in_order_of_vendor_and_payment(warehouse, spark):
    import pyarrow.parquet as pq

    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    rows = month_of_trips(spark, "2024-01", 40_000).coalesce(1)
    rows = landing.add_audit_columns(rows, "2024-01", "a", AS_OF).withColumn("VendorID", F.xxhash64("trip_distance") % 4)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2000")
    try:
        tables.append_bronze(warehouse, rows, "2024-01")
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    bounds = []
    for file in warehouse.bronze_trips().inputFiles():
        footer = pq.ParquetFile(file.removeprefix("file://")).metadata
        names = [footer.schema.column(i).name for i in range(footer.num_columns)]
        for group in (footer.row_group(i) for i in range(footer.num_row_groups)):
            stats = [group.column(names.index(n)).statistics for n in tables.BRONZE_ORDER]
            bounds.append([(s.min, s.max) for s in stats])
    assert len(bounds) >= 20
    for vendor, payment in ((1, 2), (-1, 4), (3, 0)):
        opened = sum(v[0] <= vendor <= v[1] and p[0] <= payment <= p[1] for v, p in bounds)
        assert opened <= len(bounds) / 4


@pytest.fixture(scope="module")
def year(spark, tmp_path_factory):
    """A year of bronze, a file a month, with a stray row and rows without a time."""
    warehouse = tables.Warehouse(spark, str(tmp_path_factory.mktemp("year")))
    for number in range(1, 13):
        month = f"2024-{number:02d}"
        raw = month_of_trips(spark, month, 3000).coalesce(1)
        raw = raw.withColumn("tpep_pickup_datetime", F.when(F.col("VendorID") + F.col("fare_amount") != 5, F.col(
            "tpep_pickup_datetime")))
        tables.append_bronze(warehouse, landing.add_audit_columns(raw, month, month, AS_OF), month)
    return warehouse


def test_a_late_month_reads_only_its_files(spark, year):
    late = year.bronze_trips("2024-05").where("VendorID is not null and tpep_pickup_datetime is not null")
    changed = late.limit(500).withColumn("VendorID", F.col("VendorID") + 7)
    stray = late.limit(1).withColumn("tpep_pickup_datetime", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    staging = late.unionByName(changed).unionByName(stray).cache()
    assert ledger.index_bronze(year) == 12 and ledger.index_bronze(year) == 0
    target = monthly.overlapping_bronze(year, staging)
    size = {f: os.path.getsize(f.removeprefix("file://")) for f in year.bronze_trips().inputFiles()}
    assert sum(size[f] for f in target.inputFiles()) < 0.1 * sum(size.values())
    for null_safe in (False, True):
        pruned = merge_insert_new_trips(staging, target, null_safe=null_safe)
        whole = merge_insert_new_trips(staging, year.bronze_trips(), null_safe=null_safe)
        assert sorted(map(str, pruned.collect())) == sorted(map(str, whole.collect()))
        assert pruned.count() == 501


def test_rows_without_a_time_open_the_files_that_have_such(spark, year):
    missing = year.bronze_trips("2024-05").where("tpep_pickup_datetime is null")
    assert missing.count() > 0
    ledger.index_bronze(year)
    held = {os.path.basename(f) for f in ledger.files_of_days(year, missing)}
    everywhere = year.bronze_trips().where("tpep_pickup_datetime is null")
    assert held == {r[0].split("/")[-1] for r in everywhere.select("_metadata.file_path").distinct().collect()}
    target = monthly.overlapping_bronze(year, missing)
    assert merge_insert_new_trips(missing, target, null_safe=True).count() == 0


def test_merges_keep_the_index_up_to_date(warehouse, frame):
    assert monthly.merge_into_bronze(warehouse, frame(SAMPLE)) == 5
    assert monthly.merge_into_bronze(warehouse, frame(SAMPLE)) == 0
    late = trip("2023-03-01 08:00:00", "2023-03-01 08:30:00", _execution_date="2024-01")
    assert monthly.merge_into_bronze(warehouse, frame([*SAMPLE, late])) == 1
    assert monthly.merge_into_bronze(warehouse, frame([*SAMPLE, late])) == 0
    days = ledger.file_days(warehouse).agg(F.sum("rows")).first()[0]
    assert days == warehouse.bronze_trips().count() == 6
    assert schemas.BRONZE_TRIPS.names == warehouse.bronze_trips().columns
