"""Trip records, zones and run events derived from the given test tables.

Amounts are whole cents and times are integer offsets, so Spark and the oracle
agree exactly. The rules plant missing values, negative amounts, invalid zones,
durations out of range and re-ingested copies. The same rules are written as SQL
in ``suite.oracle``.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.months import at
from fareloom.operators.zones import dim_zones

AS_OF = dt.datetime(2026, 1, 1)
EVENT_CODES = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name for tables a query writes and reads back.

    It lies in the shared folder the session names. Without one, a temporary
    folder serves in local mode; on a cluster there is none that executors share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not shared and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="fareloom-")
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _cents(value: Column) -> Column:
    """A value of at least zero, rounded half up to a whole number, as cents."""
    return F.floor(value + 0.5) / 100


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows from ``lineitem``, plus ``line_status``.

    Every tenth order is delivered a second time, a day later, with a total one
    higher. Both deliveries come from one scan of the table.
    """
    items = table(spark, sf_dir, "lineitem").withColumns(
        {
            "batch": F.explode(
                F.sequence(F.lit(0), F.when(F.col("l_orderkey") % 10 == 0, 1).otherwise(0))
            )
        }
    )
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    offset = (order * 7 + line * 131) % 1440 * 60 + order % 60
    started = F.timestamp_add("SECOND", offset, F.col("l_shipdate"))
    ride = ((part * 13 + supplier) % 330 - 10) * 60 + part % 60
    sign = F.when(order % 31 == 0, -1.0).otherwise(1.0)
    month = F.date_format("l_shipdate", "yyyy-MM")
    zone = part % 268
    values = {
        "VendorID": _null_when(supplier % 50 == 0, supplier % 2 + 1),
        "tpep_pickup_datetime": _null_when(part % 97 == 0, started),
        "tpep_dropoff_datetime": F.timestamp_add("SECOND", ride, started),
        "passenger_count": _null_when(order % 20 == 0, F.col("l_quantity") % 10),
        "trip_distance": F.when(order % 89 == 0, 250.0).otherwise(F.col("l_quantity") / 2 - 1),
        "RatecodeID": line,
        "store_and_fwd_flag": F.when(F.col("l_returnflag") == "A", "Y").when(
            F.col("l_returnflag") == "N", "N"
        ),
        "PULocationID": zone,
        "DOLocationID": supplier * 37 % 266 + 1,
        "payment_type": _null_when(order % 20 == 0, order % 6 + 1),
        "fare_amount": _cents(price) * sign,
        "extra": line % 3 / 2,
        "mta_tax": F.lit(0.5),
        "tip_amount": F.when(order % 6 == 0, _cents(price * F.col("l_discount"))).otherwise(0.0),
        "tolls_amount": F.when(line == 7, 6.55).otherwise(0.0),
        "improvement_surcharge": F.lit(1.0),
        "total_amount": _cents(price * (1 + F.col("l_tax"))) * sign + F.col("batch"),
        "congestion_surcharge": F.when(order % 2 == 0, 2.5),
        "airport_fee": F.when(zone.isin(132, 138, 1), 1.25).otherwise(0.0),
        "_ingested_at": F.timestamp_add(
            "DAY", F.col("batch"), at(dt.datetime(2002, 1, 1))
        ),
        "_source_file": F.concat(F.lit("trips/"), month, F.lit(".parquet")),
        "_execution_date": month,
    }
    return items.select(
        *[
            values[field.name].cast(field.dataType).alias(field.name)
            for field in schemas.BRONZE_TRIPS.fields
        ],
        F.col("l_linestatus").alias("line_status"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(spark, sf_dir).select(*schemas.BRONZE_TRIPS.names)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered columns with the month of the delivery."""
    return bronze(spark, sf_dir).select(*schemas.RAW_TRIPS.names, "_execution_date")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of a single month from ``events``."""
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    code = F.lit(None).cast("long")
    for name, number in EVENT_CODES.items():
        code = F.when(F.col("event_type") == name, number).otherwise(code)
    values = {
        "VendorID": user % 2 + 1,
        "tpep_pickup_datetime": F.col("ts"),
        "tpep_dropoff_datetime": F.timestamp_add(
            "SECOND", (event % 290 + 1) * 60 + event % 60, F.col("ts")
        ),
        "passenger_count": event % 7,
        "trip_distance": event % 400 / 10,
        "RatecodeID": event % 8,
        "store_and_fwd_flag": F.when(user % 3 == 0, "Y").when(user % 3 == 1, "N"),
        "PULocationID": user % 266 + 1,
        "DOLocationID": event * 13 % 265 + 1,
        "payment_type": code,
        "fare_amount": _cents(value * 80),
        "extra": F.lit(0.5),
        "mta_tax": F.lit(0.5),
        "tip_amount": F.when(code == 1, _cents(value * 12)).otherwise(0.0),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(1.0),
        "total_amount": _cents(value * 100),
        "congestion_surcharge": F.when(event % 2 == 0, 2.5),
        "airport_fee": F.lit(0.0),
    }
    return table(spark, sf_dir, "events").select(
        *[
            values[field.name].cast(field.dataType).alias(field.name)
            for field in schemas.RAW_TRIPS.fields
        ]
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone per row of ``part``; smaller tables leave some zones out."""
    part = table(spark, sf_dir, "part")
    borough = F.lit(None).cast("string")
    names = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown")
    for remainder, name in enumerate(names):
        borough = F.when(F.col("p_partkey") % 8 == remainder, name).otherwise(borough)
    return part.select(
        F.col("p_partkey").alias("LocationID"),
        borough.alias("Borough"),
        F.col("p_name").alias("Zone"),
        F.col("p_brand").alias("service_zone"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(zone_lookup(spark, sf_dir), AS_OF)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events from ``orders``: a start for each order, an end for most."""
    order, day = F.col("o_orderkey"), F.col("o_orderdate")
    started = F.timestamp_add("SECOND", order % 86400, day)
    ended = F.timestamp_add("SECOND", F.col("o_custkey") % 3600 + 1, started)
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(
        F.col("o_orderstatus") == "P", "FAILED"
    )
    both = F.explode(
        F.when(status.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    )
    end = F.col("is_end") == 1
    rows = table(spark, sf_dir, "orders").select("*", both.alias("is_end"))
    ingested = F.when(end & (status == "COMPLETED"), F.col("o_custkey") * 100)
    failed = end & (status == "FAILED")
    return rows.select(
        order.cast("string").alias("run_id"),
        F.date_format(day, "yyyy-MM").alias("execution_date"),
        F.lit("dev").alias("env"),
        F.when(end, status).otherwise("STARTED").alias("status"),
        F.when(end, ended).otherwise(started).alias("run_date"),
        F.when(end, F.timestamp_add("SECOND", order % 7, ended)).alias("completed_at"),
        ingested.alias("rows_ingested"),
        F.when(end, (F.col("o_custkey") % 3600 + 1).cast("double")).alias("duration_seconds"),
        F.when(failed, F.col("o_orderpriority")).alias("error_message"),
    )
