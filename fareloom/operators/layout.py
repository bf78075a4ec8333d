"""One distribution of trips for both their deduplication and their day files.

A day's trips are dealt into as many slices as its size asks for, by a hash of the
trip key. All copies of a trip meet in one slice, so the rows of a slice can be made
distinct and written as one file without being shuffled again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.session import ROWS_PER_TASK

#: Rows of a slice, which becomes one file of its day.
ROWS_PER_SLICE = 2_000_000
#: Heavy keys looked for in a day, and entries of the sketch that finds them. A key
#: with more than one in ``TRACKED`` of a day's rows is always found.
HEAVY_KEYS, TRACKED = 16, 256
#: Days whose numbers of slices are sent to all executors: 12 bytes each.
MOST_DAYS = 100_000

DAY, SLICE = "_day", "_slice"


def key_hash(key: tuple[str, ...]) -> Column:
    return F.xxhash64(*key)


@dataclass(frozen=True)
class DayLayout:
    """Slices of the days that have more than one, hashes of heavy keys, and all rows."""

    slices: dict[dt.date, int] = field(default_factory=dict)
    heavy: tuple[int, ...] = ()
    rows: int = field(default=0, compare=False)

    def tasks(self, spark: SparkSession, rows_per_task: int) -> int | None:
        """Tasks that the rows ask for; none if they are few, which AQE deals with."""
        if self.rows <= rows_per_task:
            return None
        return max(-(-self.rows // rows_per_task), int(spark.conf.get("spark.sql.shuffle.partitions")))


def plan_days(
    rows: DataFrame, time: str, key: tuple[str, ...] = schemas.TRIP_KEY, rows_per_slice: int = ROWS_PER_SLICE
) -> DayLayout:
    """Count the days, reading the key columns alone, and look for heavy keys.

    What comes to the driver is an entry for each day of more than one slice, and the
    number of all rows. A heavy key is one whose copies would fill a slice.
    """
    sketch = F.expr(f"approx_top_k(_hash, {HEAVY_KEYS}, {TRACKED})")
    days = (
        rows.select(F.to_date(time).alias(DAY), key_hash(key).alias("_hash"))
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("rows"), sketch.alias("keys"))
    )
    heavy = F.filter("keys", lambda x: x["count"] >= rows_per_slice).alias("keys")
    large = F.when(F.col("rows") > rows_per_slice, F.struct(DAY, "rows", heavy))
    total, found = days.agg(F.sum("rows"), F.collect_list(large)).first()
    if len(found) > MOST_DAYS:
        raise ValueError(f"more than {MOST_DAYS} days of over {rows_per_slice} rows")
    return DayLayout(
        {row[DAY]: -(-row["rows"] // rows_per_slice) for row in found},
        tuple(sorted({entry["item"] for row in found for entry in row["keys"]})),
        total or 0,
    )


def dealt(
    rows: DataFrame,
    layout: DayLayout,
    time: str,
    key: tuple[str, ...],
    newest: list[Column],
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, tuple[str, ...]]:
    """The rows, shuffled once by day and slice, and the columns added for these.

    If no day has more than one slice the day alone is added. The number of tasks
    follows the number of rows.

    Copies of heavy keys are cut to one a task before (``newest`` first), as all of
    them go to one slice; there is no such step if there is no heavy key.
    """
    if layout.heavy:
        heavy = key_hash(key).isin(*layout.heavy)
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*newest))
        few = rows.where(heavy).withColumn("_rank", rank).where("_rank = 1").drop("_rank")
        rows = rows.where(~heavy).unionByName(few)
    tasks = layout.tasks(rows.sparkSession, rows_per_task)
    number_of = () if tasks is None else (tasks,)
    rows = rows.withColumn(DAY, F.to_date(time))
    if not layout.slices:
        return rows.repartition(*number_of, DAY), (DAY,)
    known = rows.sparkSession.createDataFrame(list(layout.slices.items()), f"{DAY} date, _slices int")
    number = F.pmod(key_hash(key), F.coalesce("_slices", F.lit(1))).cast("int")
    rows = rows.join(F.broadcast(known), DAY, "left").withColumn(SLICE, number).drop("_slices")
    return rows.repartition(*number_of, DAY, SLICE), (DAY, SLICE)


def number_as_read(rows: DataFrame, path: str, name: str = "position") -> DataFrame:
    """Number rows from 1 in the order in which the frame returns them.

    The rows are written to ``path`` with their task and place in it, so that counting
    and numbering see the same tasks; only one count per task is summed up in order.
    """
    spark = rows.sparkSession
    rows.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path).withColumns({
        "_task": F.shiftright("_at", 33),
        "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = stored.join(starts, "_task").withColumn(name, F.col("_start") + F.col("_place") + 1)
    return numbered.drop("_at", "_task", "_place", "_start")
