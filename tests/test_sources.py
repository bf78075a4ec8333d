import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.operators.trips import clean_trips
from fareloom.plans import monthly
from fareloom.session import size_shuffle, stored_bytes
from fareloom.sources import landing, tables
from fareloom.sources.zones import scan_zone_lookup

from .conftest import SAMPLE, plan_of, trip


def deliver(frame, root, month, rows):
    path = f"{root}/{landing.file_name(month)}"
    frame(rows, schemas.RAW_TRIPS).write.parquet(path)


def test_scan_takes_month_and_file_from_the_path(spark, frame, tmp_path):
    root = str(tmp_path / "2019-01" / "landing")
    deliver(frame, root, "2024-01", SAMPLE)
    deliver(frame, root, "2024-02", SAMPLE[:2])
    rows = landing.scan_raw_trips(spark, root)
    by_month = rows.groupBy("_execution_date").count().collect()
    counts = {row["_execution_date"]: row["count"] for row in by_month}
    assert counts == {"2024-01": 5, "2024-02": 2}
    source = landing.scan_raw_trips(spark, root, "2024-02").first()["_source_file"]
    assert source.startswith("yellow/2024-02/yellow_tripdata_2024-02.parquet")
    assert landing.scan_raw_trips(spark, root, ["2024-01", "2024-02"]).count() == 7


def test_audit_columns_leave_the_input_alone(sample):
    raw = sample.select(*schemas.RAW_TRIPS.names)
    when = dt.datetime(2024, 2, 1, 12)
    rows = landing.add_audit_columns(raw, "2024-01", "file", when)
    assert rows.count() == 5 and raw.columns == schemas.RAW_TRIPS.names
    assert rows.columns == schemas.BRONZE_TRIPS.names
    row = rows.first()
    assert (row["_ingested_at"], row["_source_file"], row["_execution_date"]) == (
        when,
        "file",
        "2024-01",
    )
    assert landing.add_audit_columns(raw, "2024-01", "file").first()["_ingested_at"] is not None


def test_names_are_trimmed_but_keep_their_case(spark):
    assert landing.normalize_column_names(spark.range(1).toDF(" VendorID ")).columns == ["VendorID"]


def test_conform(spark):
    delivered = spark.createDataFrame(
        [("2024-01-15 08:00:00", 5, "x")],
        "TPEP_pickup_datetime string, total_amount int, more string",
    )
    rows = landing.conform_bronze_schema(delivered)
    assert rows.schema.names == schemas.BRONZE_TRIPS.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.BRONZE_TRIPS]
    row = rows.first()
    assert row["total_amount"] == 5.0 and row["VendorID"] is None
    assert row["tpep_pickup_datetime"] == dt.datetime(2024, 1, 15, 8)
    with pytest.raises(landing.MissingColumnsError, match="total_amount"):
        landing.conform_bronze_schema(delivered.drop("total_amount"))


def test_zone_lookup_from_csv_and_parquet(spark, lookup, tmp_path):
    lookup.write.option("header", "true").csv(str(tmp_path / "zones.csv"))
    lookup.write.parquet(str(tmp_path / "zones"))
    csv = scan_zone_lookup(spark, str(tmp_path / "zones.csv"))
    parquet = scan_zone_lookup(spark, str(tmp_path / "zones"))
    assert csv.exceptAll(parquet).count() == 0 and csv.count() == 264


def test_append_counts_and_prunes(warehouse, frame):
    other = trip(_execution_date="2024-02", _source_file="b")
    counts = tables.append_bronze(warehouse, frame([*SAMPLE, other]))
    assert counts == {"2024-01": 5, "2024-02": 1}
    tables.append_bronze(warehouse, frame([other]))
    assert warehouse.bronze_trips().count() == 7
    assert warehouse.bronze_trips("2024-02").count() == 2
    assert warehouse.bronze_trips("2024-03").count() == 0
    pruned = plan_of(warehouse.bronze_trips().where("_execution_date = '2024-02'"))
    assert "PartitionFilters: [isnotnull(_execution_date" in pruned


def test_merge_into_bronze(warehouse, frame):
    assert monthly.merge_into_bronze(warehouse, frame(SAMPLE)) == 5
    staging = frame([{**SAMPLE[0], "total_amount": 1.0}, trip(VendorID=9)])
    assert monthly.merge_into_bronze(warehouse, staging, "2024-01") == 1
    assert warehouse.bronze_trips().where("total_amount = 1").count() == 0
    # A key with a missing part is inserted by every run, unless it may match.
    unknown = frame([trip(VendorID=None)])
    assert [monthly.merge_into_bronze(warehouse, unknown) for _ in range(2)] == [1, 1]
    assert monthly.merge_into_bronze(warehouse, unknown, null_safe=True) == 0


def test_skip_loaded_files(frame):
    files = frame([trip(_source_file="a"), trip(_source_file="b")]).select(
        "_source_file", "_execution_date"
    )
    left = landing.skip_loaded_files(files, frame([trip(_source_file="a")] * 3)).collect()
    assert [row["_source_file"] for row in left] == ["b"]


def days(warehouse):
    found = warehouse.silver_trips().groupBy("pickup_date").count().collect()
    return {str(row["pickup_date"]): row["count"] for row in found}


def test_rewriting_a_month_replaces_all_its_days_and_no_other(warehouse, frame):
    february = trip(
        "2024-02-03 08:00:00", "2024-02-03 08:20:00", _execution_date="2024-02"
    )
    bronze = frame([*SAMPLE, february])
    tables.write_silver_trips(warehouse, clean_trips(bronze))
    assert days(warehouse) == {
        "2024-01-04": 2,
        "2024-01-12": 1,
        "2024-01-21": 1,
        "2024-01-31": 1,
        "2024-02-03": 1,
    }
    fewer = frame(SAMPLE[1:4])
    tables.write_silver_trips(warehouse, clean_trips(fewer, "2024-01"), "2024-01")
    assert days(warehouse) == {
        "2024-01-04": 1,
        "2024-01-12": 1,
        "2024-01-21": 1,
        "2024-02-03": 1,
    }
    again = clean_trips(fewer, "2024-01")
    tables.write_silver_trips(warehouse, again, "2024-01")
    assert days(warehouse) == {
        "2024-01-04": 1,
        "2024-01-12": 1,
        "2024-01-21": 1,
        "2024-02-03": 1,
    }
    assert warehouse.silver_trips().schema.names == schemas.SILVER_TRIPS.names
    tables.write_silver_trips(warehouse, clean_trips(fewer), full_replace=True)
    assert "2024-02-03" not in days(warehouse)


def test_a_day_with_most_rows_is_written_by_several_tasks(warehouse, spark):
    """AQE splits the one shuffle partition of a hot day."""
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.files.maxRecordsPerFile": "0",
    }
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(200_000, numPartitions=8).select(
            F.to_date(F.lit("2024-01-15")).alias("pickup_date"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
            (F.col("id") % 7).alias("zone"),
        )
        tables.overwrite_partitions(warehouse, "silver", "hot", rows, "pickup_date", ("zone",))
        written = warehouse.read("silver", "hot")
        assert written.count() == 200_000
        assert len(written.inputFiles()) > 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_environments_are_kept_apart(spark, tmp_path):
    dev = tables.Warehouse(spark, str(tmp_path))
    prod = tables.Warehouse(spark, str(tmp_path), "prod")
    assert dev.path("gold", "x") != prod.path("gold", "x")
    assert prod.name("gold", "x") == "prod_gold.x"
    with pytest.raises(ValueError):
        tables.Warehouse(spark, str(tmp_path), "test")


def test_shuffle_size_follows_the_input(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    size = stored_bytes(spark, str(tmp_path / "t"))
    assert size > 1000
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffle(spark, size) == 8
        assert size_shuffle(spark, 10**12) == 14902
        assert size_shuffle(spark, 10**16) == 50_000
    finally:
        spark.conf.unset(key)


def test_a_rewritten_month_leaves_no_old_gold(warehouse, spark):
    kind = "pickup_date date, total_trips long, _execution_date string"
    rows = [(dt.date(2024, m, 1), 5, f"2024-0{m}") for m in (1, 2)]
    table = "kpi_daily_revenue"
    tables.write_gold(warehouse, table, spark.createDataFrame(rows, kind), months=["2024-01", "2024-02"])
    tables.write_gold(warehouse, table, spark.createDataFrame([], kind), months="2024-01")
    left = warehouse.read("gold", table).collect()
    assert [row["_execution_date"] for row in left] == ["2024-02"]
