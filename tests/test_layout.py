"""Silver written in one shuffle, whatever the size of its days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.operators import layout, trips
from fareloom.sources import tables
from suite.inputs import bronze

from .conftest import SAMPLE, SF, plan_of, trip


def arranged(rows):
    partition, order = tables.SILVER_TRIPS
    return tables._in_files(partition, order, True, rows)


@pytest.fixture(scope="module")
def copies(spark, frame):
    """Trips of a hot day, one of which holds a third of all rows."""
    rows = frame([trip(VendorID=i % 2, PULocationID=i % 265 + 1, _ingested_at=dt.datetime(2024, 2, 1 + i % 9))
                  for i in range(60)])
    many = rows.withColumns({
        "n": F.explode(F.sequence(F.lit(1), F.lit(100))),
        "tpep_pickup_datetime": F.timestamp_add("SECOND", F.col("n") % 50, F.col("tpep_pickup_datetime")),
    })
    hot = frame([trip(VendorID=9, total_amount=float(i)) for i in range(50)])
    hot = hot.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(60))))
    return many.unionByName(hot).unionByName(frame(SAMPLE).withColumn("n", F.lit(0))).drop("n").repartition(6).cache()


@pytest.mark.parametrize("rows_per_slice", [10**9, 2000, 200, 7])
def test_slices_change_no_row(copies, rows_per_slice):
    expected = sorted(map(str, trips.clean_trips(copies).collect()))
    found = trips.clean_trips_by_day(copies, rows_per_slice=rows_per_slice)
    assert sorted(map(str, found.collect())) == expected
    month = trips.clean_trips_by_day(copies, "2024-01", rows_per_slice)
    assert sorted(map(str, month.collect())) == expected


def test_a_hot_day_and_its_heavy_key_are_found(copies):
    rows = copies.where("tpep_pickup_datetime is not null")
    plan = layout.plan_days(rows, schemas.TRIP_KEY[0], rows_per_slice=1000)
    assert plan.slices == {dt.date(2024, 1, 15): 9}
    heavy = rows.where("VendorID = 9").select(layout.key_hash(schemas.TRIP_KEY)).distinct().collect()
    assert plan.heavy == tuple(row[0] for row in heavy) and len(heavy) == 1
    assert layout.plan_days(rows, schemas.TRIP_KEY[0]) == layout.DayLayout()


def test_the_written_query_has_one_shuffle(spark, warehouse):
    tables.append_bronze(warehouse, bronze(spark, SF))
    rows = arranged(trips.clean_trips_by_day(warehouse.bronze_trips("1996-12"), "1996-12"))
    tree = plan_of(rows).split("\n\n\n")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree
    # Many slices add the numbers of slices by broadcast, and no other shuffle.
    small = arranged(trips.clean_trips_by_day(warehouse.bronze_trips("1996-12"), "1996-12", rows_per_slice=3))
    tree = plan_of(small).split("\n\n\n")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1


def test_a_hot_day_becomes_several_files(warehouse, copies):
    rows = trips.clean_trips_by_day(copies, rows_per_slice=500)
    tables.write_silver_trips(warehouse, rows, dealt=True)
    silver = warehouse.silver_trips()
    files = silver.where("pickup_date = '2024-01-15'").select("_metadata.file_path").distinct().count()
    assert files > 3
    assert sorted(map(str, silver.collect())) == sorted(map(str, trips.clean_trips(copies).collect()))


def test_copies_of_a_heavy_key_are_cut_before_the_shuffle(copies):
    rows = copies.where("tpep_pickup_datetime is not null")
    newest = trips.newest_first(rows, schemas.TRIP_KEY)
    plan = layout.plan_days(rows, schemas.TRIP_KEY[0], rows_per_slice=1000)
    spread, by = layout.dealt(rows, plan, schemas.TRIP_KEY[0], schemas.TRIP_KEY, newest)
    assert by == (layout.DAY, layout.SLICE)
    assert spread.where("VendorID = 9").count() == 1 and spread.count() == rows.count() - 2999
    slices = spread.where(f"{layout.DAY} = '2024-01-15'").groupBy(layout.SLICE).count().collect()
    assert len(slices) > 5


def test_tasks_follow_the_rows(copies):
    rows = copies.where("tpep_pickup_datetime is not null and VendorID != 9")
    newest = trips.newest_first(rows, schemas.TRIP_KEY)
    plan = layout.plan_days(rows, schemas.TRIP_KEY[0], rows_per_slice=100)
    assert plan.rows == rows.count()
    spread, _ = layout.dealt(rows, plan, schemas.TRIP_KEY[0], schemas.TRIP_KEY, newest, rows_per_task=200)
    by_task = [row["count"] for row in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == plan.rows and len(by_task) > 16 and max(by_task) < 1000
    assert plan.tasks(rows.sparkSession, plan.rows) is None


def test_no_rows(frame, copies):
    assert trips.clean_trips_by_day(copies.limit(0)).count() == 0


def hours(spark, n=4000):
    """Hourly KPIs, nine tenths of them in one month, in no order."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 > 0, "2024-02").otherwise("2024-01").alias("month"),
        (F.xxhash64("id") % 7 + 7).cast("int").alias("pickup_dow"),
        F.col("id").cast("int").alias("pickup_hour"),
    )
    return rows.orderBy(F.xxhash64(F.col("pickup_hour") + 1)).repartition(5)


def test_gold_files_follow_the_final_order(spark, tmp_path):
    warehouse = tables.Warehouse(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.write_gold(warehouse, "kpi_hourly_patterns", hours(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted(tmp_path.rglob("*.parquet"), key=lambda f: f.name)
    files = [f for f in files if "kpi_hourly_patterns" in str(f)]
    hot = [f for f in files if "month=2024-02" in str(f)]
    assert len(hot) > 1
    found = [
        (f.parent.name, row.pickup_dow, row.pickup_hour)
        for f in files
        for row in spark.read.parquet(str(f)).collect()
    ]
    assert len(found) == 4000 and found == sorted(found)


def test_gold_reader_returns_the_final_order(spark, tmp_path):
    warehouse = tables.Warehouse(spark, f"{tmp_path}/w")
    tables.write_gold(warehouse, "kpi_hourly_patterns", hours(spark))
    read = warehouse.gold_in_order("kpi_hourly_patterns")
    expected = sorted((str(r.month)[:7], r.pickup_dow, r.pickup_hour) for r in hours(spark).collect())
    assert [(str(r.month)[:7], r.pickup_dow, r.pickup_hour) for r in read.collect()] == expected
    numbered = layout.number_as_read(read, f"{tmp_path}/n").collect()
    placed = {r.position: (str(r.month)[:7], r.pickup_dow, r.pickup_hour) for r in numbered}
    assert len(numbered) == 4000 and [placed[i + 1] for i in range(4000)] == expected
    some = warehouse.gold_in_order("kpi_hourly_patterns", "2024-01").collect()
    assert len(some) == 400
    empty = layout.number_as_read(read.where("pickup_hour < 0"), f"{tmp_path}/e")
    assert empty.count() == 0 and empty.columns == [*read.columns, "position"]
