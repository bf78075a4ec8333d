"""The layer tables as Parquet directories, and how each is written."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schemas
from fareloom.functions.months import Months, month_list
from fareloom.sources import versions

ENVIRONMENTS = ("dev", "staging", "prod")

# Partition column and order within files of each rewritten table.
SILVER_TRIPS = ("pickup_date", ("pickup_location_id", "payment_type"))
GOLD_TABLES = {
    "kpi_daily_revenue": ("_execution_date", ("pickup_date",)),
    "kpi_zone_performance": ("month", ("borough", "rank_in_borough_by_revenue", "location_id")),
    "kpi_hourly_patterns": ("month", ("pickup_dow", "pickup_hour")),
}
# Order of the rows of a whole KPI table, the last columns breaking ties of the first.
GOLD_ORDER = {
    "kpi_daily_revenue": ("pickup_date", "_execution_date"),
    "kpi_zone_performance": ("month", "borough", "rank_in_borough_by_revenue", "location_id"),
    "kpi_hourly_patterns": ("month", "pickup_dow", "pickup_hour"),
}
# Tables of the short job. It takes months by the month of the file throughout.
LITE_TABLES = {
    "trips_lite": ("_execution_date", ("pickup_date", "pickup_location_id")),
    "kpi_daily_revenue_lite": ("_execution_date", ("pickup_date",)),
    "kpi_zone_performance_lite": ("_execution_date", ("month", "zone_id")),
    "kpi_hourly_patterns_lite": ("_execution_date", ("month", "pickup_dow", "pickup_hour")),
}
# Order within files of bronze: row groups can be skipped by either column.
BRONZE_ORDER = ("VendorID", "payment_type")
METADATA_TABLES = {
    "pipeline_runs": schemas.PIPELINE_RUNS,
    "pipeline_steps": schemas.PIPELINE_STEPS,
    "quality_checks": schemas.QUALITY_CHECKS,
}


@dataclass(frozen=True)
class Warehouse:
    """Layer tables of one environment under a root all executors can reach."""

    spark: SparkSession
    root: str
    env: str = "dev"

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.env!r}, expected one of {ENVIRONMENTS}")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.env}_{layer}/{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.env}_{layer}.{table}"

    def read(
        self,
        layer: str,
        table: str,
        schema: T.StructType | None = None,
        partitions: str = "",
    ) -> DataFrame:
        """The table, or the partitions a glob names, without listing the others.

        With a schema given, what is not written yet is empty.
        """
        if partition := versioned(layer, table):
            return self._read_current(layer, table, partition, schema)
        path = self.path(layer, table)
        reader = self.spark.read.option("basePath", path)
        try:
            if schema is None:
                return reader.parquet(f"{path}/{partitions}")
            return reader.schema(schema).parquet(f"{path}/{partitions}").select(*schema.names)
        except AnalysisException as error:
            if schema is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    @property
    def publications(self) -> str:
        return self.path("metadata", "publications")

    def _read_current(
        self, layer: str, table: str, partition: str, schema: T.StructType | None, months: Months = None
    ) -> DataFrame:
        """The published versions of a rewritten table, without opening the others."""
        path = self.path(layer, table)
        current = versions.current(self.spark, self.publications, layer, table)
        reader = self.spark.read.option("basePath", path)
        paths = versions.paths(path, partition, current or {}, months)
        if schema is not None:
            if not paths:
                return self.spark.createDataFrame([], schema)
            return reader.schema(schema).parquet(*paths).select(*schema.names)
        if paths:
            return reader.parquet(*paths).drop("version")
        return reader.parquet(path).drop("version").where(F.lit(False))

    def gold_in_order(self, table: str, months: Months = None) -> DataFrame:
        """A KPI table in its final order, over all its months or some."""
        rows = self._read_current("gold", table, GOLD_TABLES[table][0], None, months)
        return rows.orderBy(*GOLD_ORDER[table])

    def publish(self, *staged: versions.Staged) -> None:
        """Make written versions current, all in one step."""
        versions.publish(self.spark, self.publications, staged)

    def vacuum(self, layer: str, table: str) -> list[str]:
        """Delete versions that were replaced by later ones; returns their names."""
        return versions.vacuum(self.spark, self.publications, self.path(layer, table), layer, table)

    def bronze_trips(self, months: Months = None) -> DataFrame:
        months = _choice(months)
        partitions = f"_execution_date={months}" if months else ""
        return self.read("bronze", "trips", schemas.BRONZE_TRIPS, partitions)

    def silver_trips(self, months: Months = None) -> DataFrame:
        return self._read_current("silver", "trips", SILVER_TRIPS[0], schemas.SILVER_TRIPS, months)


def versioned(layer: str, table: str) -> str | None:
    """Partition column of a table that is rewritten in versions."""
    if (layer, table) == ("silver", "trips"):
        return SILVER_TRIPS[0]
    if layer == "gold" and table in GOLD_TABLES:
        return GOLD_TABLES[table][0]
    return LITE_TABLES[table][0] if table in LITE_TABLES else None


def _choice(months: Months) -> str:
    """Glob for one of the months; empty for all."""
    wanted = month_list(months)
    return "" if wanted is None else "{" + ",".join(wanted) + "}"


def append_bronze(warehouse: Warehouse, rows: DataFrame, months: Months = None) -> dict[str, int]:
    """Append conformed rows by month of the file; returns the rows of each month.

    The rows of a file belong to one month, so each task writes what it scanned
    and nothing is shuffled; a task sorts its rows, so that row groups can be skipped
    by vendor and payment type.

    With the ``months`` given, the rows are counted while they are written: as the
    write follows the scan in one stage, Spark counts the results of each task once,
    also if it is retried. Rows of other months are not counted. Without them the
    source is evaluated a second time to count it.
    """
    path = warehouse.path("bronze", "trips")
    month = F.col("_execution_date")
    wanted = month_list(months)
    if wanted is None:
        counts = {row[0]: row[1] for row in rows.groupBy(month).count().collect()}
    else:
        seen = Observation()
        counters = [F.count_if(month == m).alias(m) for m in wanted]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counters)
    sorted_rows = rows.sortWithinPartitions(month, *BRONZE_ORDER)
    sorted_rows.write.mode("append").partitionBy("_execution_date").parquet(path)
    if wanted is not None:
        counts = {m: seen.get[m] for m in wanted if seen.get[m]}
    return counts


def by_partition(rows: DataFrame, partition: str, order: tuple[str, ...]) -> DataFrame:
    """Bring each partition's rows together in files of even size, sorted within.

    REBALANCE lets AQE split a partition value that holds a large part of the
    rows over several tasks; a repartition by the column would not.
    """
    return rows.hint("rebalance", partition).sortWithinPartitions(partition, *order)


def overwrite_partitions(
    warehouse: Warehouse,
    layer: str,
    table: str,
    rows: DataFrame,
    partition: str,
    order: tuple[str, ...],
    full_replace: bool = False,
) -> None:
    """Replace the partitions the rows fall in, or with ``full_replace`` the table."""
    (
        by_partition(rows, partition, order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if full_replace else "dynamic")
        .partitionBy(partition)
        .parquet(warehouse.path(layer, table))
    )


def _in_files(partition: str, order: tuple[str, ...], dealt: bool, rows: DataFrame) -> DataFrame:
    if dealt:
        return rows.sortWithinPartitions(partition, *order)
    return by_partition(rows, partition, order)


def _in_ranges(order: tuple[str, ...], rows: DataFrame) -> DataFrame:
    """Deal rows to tasks by ranges of their order: file after file holds what comes next.

    A month of any size is split where its rows say, and AQE joins small neighbours.
    """
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def stage_silver_trips(
    warehouse: Warehouse,
    trips: DataFrame,
    months: Months = None,
    full_replace: bool = False,
    dealt: bool = False,
) -> versions.Staged:
    """Write cleaned trips by day as a version that is still to be published.

    Files are sorted by pickup zone and payment type. Trips that are ``dealt`` by day
    and slice already are not shuffled again.
    """
    partition, order = SILVER_TRIPS
    arrange = partial(_in_files, partition, order, dealt)
    path = warehouse.path("silver", "trips")
    return versions.stage(path, "silver", "trips", trips, partition, arrange, months, full_replace)


def write_silver_trips(
    warehouse: Warehouse,
    trips: DataFrame,
    months: Months = None,
    full_replace: bool = False,
    dealt: bool = False,
) -> None:
    """Rewrite months of the silver trips, all in one step.

    A month is replaced whole: days it held before and no longer has are gone with
    the version that held them. Without ``months`` those the trips fall in are.
    """
    warehouse.publish(stage_silver_trips(warehouse, trips, months, full_replace, dealt))


def stage_gold(
    warehouse: Warehouse,
    table: str,
    rows: DataFrame,
    full_replace: bool = False,
    months: Months = None,
) -> versions.Staged:
    """Write a KPI table by month, in its final order, as a version still to be published."""
    partition, order = GOLD_TABLES[table]
    arrange = partial(_in_ranges, (partition, *order))
    return versions.stage(
        warehouse.path("gold", table), "gold", table, rows, partition, arrange, months, full_replace
    )


def stage_lite(
    warehouse: Warehouse, layer: str, table: str, rows: DataFrame, months: Months, full_replace: bool = False
) -> versions.Staged:
    """Write a table of the short job as a version that is still to be published."""
    partition, order = LITE_TABLES[table]
    arrange = partial(_in_files, partition, order, False)
    return versions.stage(
        warehouse.path(layer, table), layer, table, rows, partition, arrange, months, full_replace
    )


def write_gold(
    warehouse: Warehouse,
    table: str,
    rows: DataFrame,
    full_replace: bool = False,
    months: Months = None,
) -> None:
    """Rewrite months of a KPI table in one step.

    Months asked for that have no rows now hold none afterwards: no old KPIs stay
    behind a month that lost its trips.
    """
    warehouse.publish(stage_gold(warehouse, table, rows, full_replace, months))


def append_metadata(warehouse: Warehouse, table: str, rows: list[dict]) -> None:
    """Append a few rows to a metadata table; fields left out are NULL."""
    schema = METADATA_TABLES[table]
    unknown = {key for row in rows for key in row} - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in {table}: {', '.join(sorted(unknown))}")
    values = [tuple(row.get(name) for name in schema.names) for row in rows]
    frame = warehouse.spark.createDataFrame(values, schema).coalesce(1)
    frame.write.mode("append").parquet(warehouse.path("metadata", table))


def read_metadata(warehouse: Warehouse, table: str) -> DataFrame:
    return warehouse.read("metadata", table, METADATA_TABLES[table])
