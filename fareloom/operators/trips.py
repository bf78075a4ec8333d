"""Bronze rows to clean trips: deduplication, typing, enrichment, filters.

All cleaned columns are computed from the bronze columns in a single select.
Ratios use the amounts as delivered, not the floored ones next to them, so the
expressions must not be chained through columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions import labels
from fareloom.functions.measures import at_least, safe_divide
from fareloom.functions.months import (
    Months,
    in_months,
    minutes_between,
    same_month,
    within_months,
)
from fareloom.operators.layout import ROWS_PER_SLICE, dealt, plan_days

SHORTEST_MINUTES, LONGEST_MINUTES = 1, 300
LONGEST_MILES = 200

# Cleaned amount columns and the bronze columns they come from.
AMOUNTS = {
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "extra_amount": "extra",
    "mta_tax": "mta_tax",
    "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
    "total_amount": "total_amount",
}


def pickup() -> Column:
    return F.col("tpep_pickup_datetime")


def dropoff() -> Column:
    return F.col("tpep_dropoff_datetime")


def newest_first(frame: DataFrame, key: tuple[str, ...]) -> list[Column]:
    """Order in which the first row of a key is the one to keep.

    Rows of one load share their ingestion time, so all other columns follow as
    tie-breakers: rows still tied are equal, and a recomputed task keeps the same.
    """
    rest = [name for name in frame.columns if name not in key and name != "_ingested_at"]
    return [F.desc_nulls_last(name) for name in ("_ingested_at", *rest)]


def latest_per_key(frame: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The newest row of each key; missing key values count as equal.

    Spark limits each key to one row within every task before the shuffle, so a
    key holding a large part of the rows sends at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first(frame, key)))
    return frame.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_trips(bronze: DataFrame, months: Months = None) -> DataFrame:
    """Newest bronze row of every trip, within each ingested month."""
    rows = bronze.where(in_months(F.col("_execution_date"), months))
    return latest_per_key(rows, (*schemas.TRIP_KEY, "_execution_date"))


def identity_columns() -> list[Column]:
    return [
        F.coalesce("VendorID", F.lit(0)).cast("long").alias("vendor_id"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        pickup().alias("pickup_datetime"),
        dropoff().alias("dropoff_datetime"),
        F.to_date(pickup()).alias("pickup_date"),
    ]


def calendar_columns() -> list[Column]:
    parts = {"hour": F.hour, "dow": F.dayofweek, "month": F.month, "year": F.year}
    return [part(pickup()).cast("long").alias(f"pickup_{name}") for name, part in parts.items()]


def passenger_column() -> Column:
    whole = F.round("passenger_count").cast("long")
    return at_least(whole, 1, default=1).alias("passenger_count")


def distance_column() -> Column:
    return at_least(F.col("trip_distance"), 0.0, default=0.0).alias("trip_distance_miles")


def duration_column() -> Column:
    return minutes_between(pickup(), dropoff()).alias("trip_duration_min")


def amount_columns() -> list[Column]:
    return [at_least(F.col(raw), 0.0, default=0.0).alias(name) for name, raw in AMOUNTS.items()]


def tip_rate_column() -> Column:
    fare = F.nullif(F.col("fare_amount"), F.lit(0.0))
    return safe_divide(F.col("tip_amount"), fare).alias("tip_rate")


def revenue_per_minute_column() -> Column:
    minutes = F.nullif(minutes_between(pickup(), dropoff()), F.lit(0))
    return safe_divide(F.col("total_amount"), minutes).alias("revenue_per_minute")


def payment_type_column() -> Column:
    return labels.payment_label(F.col("payment_type")).alias("payment_type")


def rate_code_column() -> Column:
    return labels.rate_label(F.col("RatecodeID")).alias("rate_code")


def store_and_forward_column() -> Column:
    return (F.col("store_and_fwd_flag") == "Y").alias("is_store_and_forward")


def airport_trip_column() -> Column:
    """Unknown where one zone is missing and the other is not an airport."""
    start = labels.is_airport(F.col("PULocationID"))
    end = labels.is_airport(F.col("DOLocationID"))
    return (start | end).alias("is_airport_trip")


def clean_columns() -> list[Column]:
    """All columns of the silver fact, in order."""
    return [
        *identity_columns(),
        *calendar_columns(),
        passenger_column(),
        distance_column(),
        duration_column(),
        *amount_columns(),
        tip_rate_column(),
        revenue_per_minute_column(),
        payment_type_column(),
        rate_code_column(),
        store_and_forward_column(),
        airport_trip_column(),
        *[F.col(name) for name in schemas.AUDIT.names],
    ]


def valid_trip_rules(months: Months = None) -> dict[str, Column]:
    """What each cleaned trip must meet, by name. A NULL outcome fails the rule.

    Amounts are floored at zero before, so ``non_negative_amounts`` holds for
    every row; it is kept because it is part of the definition.
    """
    day = F.col("pickup_date")
    expected_month = same_month(day, F.col("_execution_date"))
    if months is not None:
        expected_month = within_months(day, months) & expected_month
    return {
        "pickup_present": F.col("pickup_datetime").isNotNull(),
        "dropoff_present": F.col("dropoff_datetime").isNotNull(),
        "dropoff_after_pickup": F.col("dropoff_datetime") > F.col("pickup_datetime"),
        "duration_in_range": F.col("trip_duration_min").between(SHORTEST_MINUTES, LONGEST_MINUTES),
        "distance_in_range": F.col("trip_distance_miles").between(0, LONGEST_MILES),
        "pickup_zone_valid": labels.valid_zone(F.col("pickup_location_id")),
        "dropoff_zone_valid": labels.valid_zone(F.col("dropoff_location_id")),
        "non_negative_amounts": (F.col("fare_amount") >= 0) & (F.col("total_amount") >= 0),
        "expected_month": expected_month,
    }


# Rules that depend on the trip key alone.
KEY_RULES = (
    "pickup_present",
    "dropoff_present",
    "dropoff_after_pickup",
    "duration_in_range",
    "expected_month",
)


def filter_valid_trips(
    cleaned: DataFrame, months: Months = None, met: tuple[str, ...] = ()
) -> DataFrame:
    """Cleaned trips that meet every rule; those named in ``met`` are known to hold."""
    for name, rule in valid_trip_rules(months).items():
        if name not in met:
            cleaned = cleaned.where(rule)
    return cleaned


def _key_rules(months: Months) -> Column:
    """``KEY_RULES`` on bronze columns.

    They keep or drop all copies of a trip together, so they may run before the
    deduplication. Rules on distance or zones may not: they could drop the copy
    that wins. Besides shrinking the shuffle, this takes out the rows without
    times, which would all share a key, and pushes the month into the scan.
    """
    minutes = minutes_between(pickup(), dropoff())
    return (
        within_months(pickup(), months)
        & dropoff().isNotNull()
        & (dropoff() > pickup())
        & minutes.between(SHORTEST_MINUTES, LONGEST_MINUTES)
        & same_month(pickup(), F.col("_execution_date"))
    )


def clean_trips(bronze: DataFrame, months: Months = None) -> DataFrame:
    """Bronze rows of some or all months to the silver fact."""
    rows = bronze.where(in_months(F.col("_execution_date"), months)).where(_key_rules(months))
    # The month of the pickup is now the ingested month: the trip key implies it.
    newest = latest_per_key(rows, schemas.TRIP_KEY)
    return filter_valid_trips(newest.select(*clean_columns()), months, met=KEY_RULES)


def clean_trips_by_day(
    bronze: DataFrame, months: Months = None, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """The silver fact as ``clean_trips`` gives it, dealt by day for its files.

    One shuffle by day and slice serves the deduplication and the day files alike. A
    day of many rows is dealt over several slices, found by a count of the key columns
    beforehand; a trip's copies share a slice, so its number changes no row.
    """
    rows = bronze.where(in_months(F.col("_execution_date"), months)).where(_key_rules(months))
    time, key = schemas.TRIP_KEY[0], schemas.TRIP_KEY
    newest = newest_first(rows, key)
    layout = plan_days(rows, time, key, rows_per_slice)
    spread, by = dealt(rows, layout, time, key, newest)
    rank = F.row_number().over(Window.partitionBy(*by, *key).orderBy(*newest))
    kept = spread.withColumn("_rank", rank).where("_rank = 1")
    return filter_valid_trips(kept.select(*clean_columns()), months, met=KEY_RULES)


def rejected_trips(bronze: DataFrame, months: Months = None) -> DataFrame:
    """Deduplicated trips kept out of silver, with the rules each one fails."""
    cleaned = latest_trips(bronze, months).select(*clean_columns())
    failed = [
        F.when(~F.coalesce(rule, F.lit(False)), name)
        for name, rule in valid_trip_rules(months).items()
    ]
    reasons = F.array_compact(F.array(*failed))
    return cleaned.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def rejected_trips_by_reason(bronze: DataFrame, months: Months = None) -> DataFrame:
    """Rows failing each rule, by month; a row failing several counts in each.

    ``negative_amount`` is for information: such amounts are floored, not rejected.
    One aggregation with a counter per rule, turned into rows afterwards, so the
    trips are never multiplied by their reasons.
    """
    newest = latest_trips(bronze, months)
    negative = (F.col("fare_amount") < 0) | (F.col("total_amount") < 0)
    marked = newest.select(*clean_columns(), negative.alias("negative"))
    rules = valid_trip_rules(months)
    counters = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    counters["negative_amount"] = F.col("negative")
    counts = marked.groupBy("_execution_date").agg(
        *[F.count_if(failed).alias(name) for name, failed in counters.items()]
    )
    return counts.unpivot("_execution_date", list(counters), "reason", "rows_rejected")
