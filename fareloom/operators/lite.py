"""The shorter variant of silver and gold: no deduplication, fewer rules and KPIs.

Months are taken by ``_execution_date``, not by pickup, so a month's tables can
hold days of other months. It is therefore a group key of every KPI table here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions import labels
from fareloom.functions.measures import at_least, avg_rate, exact_avg, exact_sum, safe_divide
from fareloom.functions.months import (
    Months,
    day_name,
    in_months,
    minutes_between,
    month_date,
    month_text,
)
from fareloom.operators.daily import stamp
from fareloom.operators.trips import dropoff, pickup


def clean_trips_lite(bronze: DataFrame, months: Months = None) -> DataFrame:
    """Bronze rows to the short silver fact.

    Amounts that are missing stay missing. ``avg_speed_mph`` is miles per minute;
    the name is kept for its readers.
    """
    minutes = minutes_between(pickup(), dropoff())
    kept = bronze.where(
        in_months(F.col("_execution_date"), months)
        & pickup().isNotNull()
        & dropoff().isNotNull()
        & (dropoff() > pickup())
        & (F.col("trip_distance") >= 0)
        & (F.col("total_amount") >= 0)
    )
    return kept.select(
        F.col("VendorID").alias("vendor_id"),
        pickup().alias("pickup_datetime"),
        dropoff().alias("dropoff_datetime"),
        F.to_date(pickup()).alias("pickup_date"),
        F.hour(pickup()).cast("long").alias("pickup_hour"),
        F.dayofweek(pickup()).cast("long").alias("pickup_dow"),
        minutes.alias("trip_duration_min"),
        F.coalesce("passenger_count", F.lit(1.0)).alias("passenger_count"),
        at_least(F.col("trip_distance"), 0.0).alias("trip_distance_miles"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        labels.payment_label_lite(F.col("payment_type")).alias("payment_type"),
        at_least(F.col("fare_amount"), 0.0).alias("fare_amount"),
        at_least(F.col("tip_amount"), 0.0).alias("tip_amount"),
        at_least(F.col("total_amount"), 0.0).alias("total_amount"),
        F.coalesce("congestion_surcharge", F.lit(0.0)).alias("congestion_surcharge"),
        F.coalesce("airport_fee", F.lit(0.0)).alias("airport_fee"),
        safe_divide(F.col("tip_amount"), F.col("fare_amount")).alias("tip_rate"),
        safe_divide(F.col("trip_distance"), F.nullif(minutes, F.lit(0))).alias("avg_speed_mph"),
        "_ingested_at",
        "_execution_date",
    )


def _of_months(trips: DataFrame, months: Months) -> DataFrame:
    return trips.where(in_months(F.col("_execution_date"), months))


def _averages() -> dict[str, Column]:
    return {
        "avg_revenue": F.round(exact_avg(F.col("total_amount")), 2),
        "avg_distance": F.round(exact_avg(F.col("trip_distance_miles")), 2),
        "avg_duration_min": F.round(F.avg("trip_duration_min"), 1),
    }


def kpi_daily_revenue_lite(trips: DataFrame, months: Months = None, as_of=None) -> DataFrame:
    averages = _averages()
    return (
        _of_months(trips, months)
        .groupBy("pickup_date", "_execution_date")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            exact_sum(F.col("passenger_count")).alias("total_passengers"),
            F.round(exact_sum(F.col("total_amount")), 2).alias("total_revenue"),
            averages["avg_revenue"].alias("avg_revenue_per_trip"),
            F.round(exact_sum(F.col("fare_amount")), 2).alias("total_fare"),
            F.round(exact_sum(F.col("tip_amount")), 2).alias("total_tips"),
            F.round(avg_rate(F.col("tip_rate")), 4).alias("avg_tip_rate"),
            averages["avg_distance"].alias("avg_trip_distance"),
            averages["avg_duration_min"].alias("avg_trip_duration_min"),
            F.count_if(F.col("payment_type") == "Credit Card").alias("credit_card_trips"),
            F.count_if(F.col("payment_type") == "Cash").alias("cash_trips"),
        )
        .withColumn("updated_at", stamp(as_of))
    )


def kpi_zone_performance_lite(
    trips: DataFrame, zones: DataFrame, months: Months = None, as_of=None
) -> DataFrame:
    """Reduced to zones first; the lookup is joined to the few rows left."""
    averages = _averages()
    by_zone = (
        _of_months(trips, months)
        .groupBy(
            month_date(F.col("pickup_date")).alias("month"),
            F.col("pickup_location_id").alias("zone_id"),
            "_execution_date",
        )
        .agg(
            F.count(F.lit(1)).alias("total_pickups"),
            exact_sum(F.col("total_amount")).alias("total_revenue"),
            averages["avg_revenue"].alias("avg_revenue_per_trip"),
            averages["avg_distance"].alias("avg_distance"),
            exact_sum(F.col("passenger_count")).alias("total_passengers"),
        )
    )
    names = zones.groupBy("location_id", "zone", "borough").agg(
        F.count(F.lit(1)).alias("copies")
    )
    copies = F.coalesce("copies", F.lit(1))
    return by_zone.join(names, by_zone["zone_id"] == names["location_id"], "left").select(
        "month",
        "zone_id",
        F.col("zone").alias("zone_name"),
        "borough",
        (F.col("total_pickups") * copies).alias("total_pickups"),
        F.round(F.col("total_revenue") * copies, 2).alias("total_revenue"),
        "avg_revenue_per_trip",
        "avg_distance",
        F.round(F.col("total_passengers") * copies).alias("total_passengers"),
        F.col("month").alias("_partition_date"),
        stamp(as_of).alias("updated_at"),
        "_execution_date",
    )


def kpi_hourly_patterns_lite(trips: DataFrame, months: Months = None, as_of=None) -> DataFrame:
    averages = _averages()
    return (
        _of_months(trips, months)
        .groupBy(
            month_date(F.col("pickup_date")).alias("month"),
            "pickup_dow",
            "pickup_hour",
            "_execution_date",
        )
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            *[value.alias(name) for name, value in averages.items()],
        )
        .select(
            month_text(F.col("month")).alias("month"),
            "pickup_dow",
            day_name(F.col("pickup_dow")).alias("day_of_week"),
            "pickup_hour",
            "total_trips",
            "avg_revenue",
            "avg_duration_min",
            "avg_distance",
            stamp(as_of).alias("updated_at"),
            "_execution_date",
        )
    )
