import datetime as dt
import itertools

import pytest

from fareloom import schemas
from fareloom.session import session
from fareloom.sources.tables import Warehouse

SF = "/root/testdata/sf0.001"
INGESTED = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def trip(pickup="2024-01-15 08:00:00", dropoff="2024-01-15 08:25:00", **values):
    """A raw trip as a dict; everything can be replaced."""
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": dt.datetime.fromisoformat(pickup) if pickup else None,
        "tpep_dropoff_datetime": dt.datetime.fromisoformat(dropoff) if dropoff else None,
        "passenger_count": 1.0,
        "trip_distance": 2.5,
        "RatecodeID": 1.0,
        "store_and_fwd_flag": "N",
        "PULocationID": 161,
        "DOLocationID": 236,
        "payment_type": 1,
        "fare_amount": 12.0,
        "extra": 0.5,
        "mta_tax": 0.5,
        "tip_amount": 3.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 17.0,
        "congestion_surcharge": 2.5,
        "airport_fee": 0.0,
        "_ingested_at": INGESTED,
        "_source_file": "yellow/2024-01/yellow_tripdata_2024-01.parquet",
        "_execution_date": "2024-01",
    }
    return {**row, **values}


def ride(pickup, dropoff, vendor, people, miles, zones, paid, amounts, **values):
    """A trip by its main values: zones from and to; fare, tip and total."""
    fare, tip, total = amounts
    return trip(
        pickup,
        dropoff,
        VendorID=vendor,
        passenger_count=people,
        trip_distance=miles,
        PULocationID=zones[0],
        DOLocationID=zones[1],
        payment_type=paid,
        fare_amount=fare,
        tip_amount=tip,
        total_amount=total,
        **values,
    )


#: An airport on one side only, a ride from midnight on without a surcharge, a
#: zone that is not listed, and a ride into the next month.
SAMPLE = [
    ride("2024-01-04 06:10:00", "2024-01-04 06:40:00", 2, 2.0, 4.0, (100, 50), 1, (20.0, 6.0, 30.0)),
    ride("2024-01-04 19:05:00", "2024-01-04 19:25:00", 1, 4.0, 6.0, (230, 132), 2, (24.0, 0.0, 26.0)),
    ride(
        "2024-01-12 00:00:00",
        "2024-01-12 00:48:00",
        2,
        3.0,
        12.0,
        (138, 132),
        1,
        (60.0, 15.0, 90.25),
        RatecodeID=2.0,
        store_and_fwd_flag="Y",
        congestion_surcharge=None,
        airport_fee=1.75,
    ),
    ride("2024-01-21 16:20:00", "2024-01-21 16:35:00", 1, 5.0, 1.5, (79, 60), 3, (9.0, 0.0, 12.0)),
    ride("2024-01-31 23:50:00", "2024-02-01 00:02:00", 2, 1.0, 2.0, (20, 21), 1, (10.0, 2.0, 15.0)),
]


@pytest.fixture(scope="session")
def frame(spark):
    """Bronze frame of dicts."""

    def make(rows, schema=schemas.BRONZE_TRIPS):
        values = [tuple(row[name] for name in schema.names) for row in rows]
        return spark.createDataFrame(values, schema)

    return make


@pytest.fixture(scope="session")
def sample(frame):
    return frame(SAMPLE)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"))


@pytest.fixture(scope="session")
def lookup(spark):
    boroughs = itertools.cycle(["Manhattan", "Queens", "EWR", None])
    rows = [(i, next(boroughs), f"zone {i}", "Yellow") for i in range(1, 266) if i != 79]
    return spark.createDataFrame(rows, schemas.ZONE_LOOKUP)


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
