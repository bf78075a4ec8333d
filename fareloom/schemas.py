"""Declared table schemas. Nothing is inferred from files."""

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _schema(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    fields = [line.split() for line in text.strip().splitlines()]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in required) for name, kind in fields]
    )


# Columns delivered in a raw monthly file.
RAW_TRIPS = _schema("""
    VendorID long
    tpep_pickup_datetime timestamp
    tpep_dropoff_datetime timestamp
    passenger_count double
    trip_distance double
    RatecodeID double
    store_and_fwd_flag string
    PULocationID long
    DOLocationID long
    payment_type long
    fare_amount double
    extra double
    mta_tax double
    tip_amount double
    tolls_amount double
    improvement_surcharge double
    total_amount double
    congestion_surcharge double
    airport_fee double
""")

AUDIT = _schema("""
    _ingested_at timestamp
    _source_file string
    _execution_date string
""")

BRONZE_TRIPS = T.StructType(RAW_TRIPS.fields + AUDIT.fields)

SILVER_TRIPS = T.StructType(
    _schema("""
        vendor_id long
        pickup_location_id long
        dropoff_location_id long
        pickup_datetime timestamp
        dropoff_datetime timestamp
        pickup_date date
        pickup_hour long
        pickup_dow long
        pickup_month long
        pickup_year long
        passenger_count long
        trip_distance_miles double
        trip_duration_min long
        fare_amount double
        tip_amount double
        tolls_amount double
        extra_amount double
        mta_tax double
        improvement_surcharge double
        congestion_surcharge double
        airport_fee double
        total_amount double
        tip_rate double
        revenue_per_minute double
        payment_type string
        rate_code string
        is_store_and_forward boolean
        is_airport_trip boolean
    """).fields
    + AUDIT.fields
)

ZONE_LOOKUP = _schema("""
    LocationID long
    Borough string
    Zone string
    service_zone string
""")

PIPELINE_RUNS = _schema(
    """
    run_id string
    execution_date string
    env string
    status string
    run_date timestamp
    completed_at timestamp
    rows_ingested long
    rows_bronze long
    rows_silver long
    rows_gold long
    duration_seconds double
    error_message string
    """,
    required=("run_id", "execution_date", "env", "status", "run_date"),
)

# Layers a run has finished for a month, so that it can go on after them.
PIPELINE_STEPS = _schema(
    """
    run_id string
    execution_date string
    layer string
    rows long
    finished_at timestamp
    """,
    required=("run_id", "execution_date", "layer", "finished_at"),
)

QUALITY_CHECKS = _schema(
    """
    run_id string
    execution_date string
    layer string
    check_name string
    table_name string
    status string
    rows_tested long
    rows_failed long
    failure_rate double
    threshold double
    check_timestamp timestamp
    details string
    """,
    required=(
        "run_id",
        "execution_date",
        "layer",
        "check_name",
        "table_name",
        "status",
        "check_timestamp",
    ),
)

# What identifies one trip in a raw file. The pickup comes first because sorts
# compare the first column most cheaply, and it tells most trips apart.
TRIP_KEY = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID")

# A raw file without these is refused.
REQUIRED_RAW_COLUMNS = ("tpep_pickup_datetime", "total_amount")
