"""Demand and revenue by day of the week and hour of the day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.measures import (
    avg_rate,
    exact_avg,
    exact_sum,
    percentiles,
    safe_divide,
    share,
)
from fareloom.functions.months import (
    Months,
    day_name,
    day_type,
    month_date,
    month_text,
    time_of_day_segment,
    within_months,
)
from fareloom.operators.daily import stamp


def hourly_metrics(trips: DataFrame, months: Months = None) -> DataFrame:
    """Metrics per month, day of the week and hour.

    Trips per day are over the days that have trips in that hour. Spark groups
    by hour and day first to count the days, so no task sees a whole hour's rows.
    """
    total = F.col("total_amount")
    trips_per_day = F.count(F.lit(1)) / F.count_distinct("pickup_date")
    return (
        trips.where(within_months(F.col("pickup_date"), months))
        .groupBy(
            month_date(F.col("pickup_date")).alias("month"),
            "pickup_dow",
            "pickup_hour",
        )
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.round(trips_per_day, 1).alias("avg_trips_per_day"),
            F.round(exact_avg(total), 2).alias("avg_revenue"),
            F.round(exact_sum(total), 2).alias("total_revenue"),
            percentiles("total_amount", 0.5)[0].alias("median_revenue"),
            F.round(exact_avg(F.col("trip_distance_miles")), 2).alias("avg_distance_miles"),
            F.round(F.avg("trip_duration_min"), 1).alias("avg_duration_min"),
            F.round(F.avg("passenger_count"), 2).alias("avg_passengers"),
            F.round(avg_rate(F.col("tip_rate")), 4).alias("avg_tip_rate"),
            share(F.col("tip_amount") > 0).alias("tip_incidence_rate"),
            share(F.col("payment_type") == "Credit Card").alias("credit_card_rate"),
        )
        .withColumn("month", month_text(F.col("month")))
    )


def demand_index() -> Column:
    """Rounded trips per day over their mean of the month (168 hours at most).

    The mean is taken of decimals: it then has no rounding noise that could move
    the index to another thousandth.
    """
    month = Window.partitionBy("month")
    tenths = F.col("avg_trips_per_day").cast("decimal(18,1)")
    mean = F.sum(tenths).over(month).cast("double") / F.count(tenths).over(month)
    return F.round(safe_divide(F.col("avg_trips_per_day"), mean), 3).alias("demand_index")


def kpi_hourly_patterns(
    trips: DataFrame, months: Months = None, as_of: dt.datetime | None = None
) -> DataFrame:
    day, hour = F.col("pickup_dow"), F.col("pickup_hour")
    metrics = hourly_metrics(trips, months)
    return metrics.select(
        "month",
        "pickup_dow",
        day_name(day).alias("day_of_week"),
        day_type(day).alias("day_type"),
        "pickup_hour",
        *metrics.columns[3:],
        stamp(as_of).alias("updated_at"),
        time_of_day_segment(hour).alias("time_of_day_segment"),
        demand_index(),
    )
