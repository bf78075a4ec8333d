"""Daily revenue KPIs and the month totals made from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.measures import (
    avg_rate,
    exact_sum,
    percentiles,
    safe_divide,
    share,
)
from fareloom.functions.months import Months, at, month_text, within_months


def stamp(as_of: dt.datetime | None) -> Column:
    """A given time, or the time of the query."""
    return F.localtimestamp() if as_of is None else at(as_of)


def _paid_by(name: str) -> Column:
    return F.col("payment_type") == name


def kpi_daily_revenue(
    trips: DataFrame, months: Months = None, as_of: dt.datetime | None = None
) -> DataFrame:
    """One row per pickup day, from one grouping of the silver fact.

    Every aggregate has a partial form, so a day with most of the trips is
    reduced within the tasks that read it. Sums are kept unrounded beside the
    results because averages and ratios are made from them.
    """
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    miles, minutes = F.col("trip_distance_miles"), F.col("trip_duration_min")
    days = (
        trips.where(within_months(F.col("pickup_date"), months))
        .groupBy("pickup_date")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("passenger_count").alias("total_passengers"),
            F.avg("passenger_count").alias("passengers"),
            exact_sum(total).alias("revenue"),
            exact_sum(fare).alias("fare"),
            exact_sum(tip).alias("tips"),
            exact_sum(F.col("tolls_amount")).alias("tolls"),
            exact_sum(F.col("congestion_surcharge")).alias("congestion"),
            exact_sum(F.col("airport_fee")).alias("airport_fees"),
            exact_sum(miles).alias("miles"),
            F.sum(minutes).alias("minutes"),
            avg_rate(F.col("tip_rate")).alias("tip_rate"),
            F.count_if(tip > 0).alias("trips_with_tip"),
            share(tip > 0).alias("tip_incidence_rate"),
            F.count_if(_paid_by("Credit Card")).alias("credit_card_trips"),
            F.count_if(_paid_by("Cash")).alias("cash_trips"),
            F.count_if(_paid_by("No Charge")).alias("no_charge_trips"),
            share(_paid_by("Credit Card")).alias("credit_card_rate"),
            F.count_if("is_airport_trip").alias("airport_trips"),
            share(F.col("is_airport_trip")).alias("airport_trip_rate"),
            percentiles("total_amount", 0.5, 0.9, 0.99).alias("revenue_at"),
        )
    )
    count = F.col("total_trips")

    def per(amount: str, divisor: Column, digits: int) -> Column:
        return F.round(safe_divide(F.col(amount), divisor), digits)

    return days.select(
        "pickup_date",
        "total_trips",
        "total_passengers",
        F.round("passengers", 2).alias("avg_passengers_per_trip"),
        F.round("revenue", 2).alias("total_revenue"),
        per("revenue", count, 2).alias("avg_revenue_per_trip"),
        F.round("fare", 2).alias("total_fare"),
        F.round("tips", 2).alias("total_tips"),
        F.round("tolls", 2).alias("total_tolls"),
        F.round("congestion", 2).alias("total_congestion_surcharge"),
        F.round("airport_fees", 2).alias("total_airport_fees"),
        F.round("tip_rate", 4).alias("avg_tip_rate"),
        per("tips", F.col("fare"), 4).alias("overall_tip_rate"),
        "trips_with_tip",
        "tip_incidence_rate",
        per("miles", count, 2).alias("avg_trip_distance_miles"),
        per("minutes", count, 1).alias("avg_trip_duration_min"),
        per("miles", count, 2).alias("avg_distance_per_trip"),
        "credit_card_trips",
        "cash_trips",
        "no_charge_trips",
        "credit_card_rate",
        "airport_trips",
        "airport_trip_rate",
        per("revenue", F.col("miles"), 2).alias("revenue_per_mile"),
        per("revenue", F.col("minutes"), 4).alias("revenue_per_minute"),
        F.col("revenue_at")[0].alias("p50_revenue"),
        F.col("revenue_at")[1].alias("p90_revenue"),
        F.col("revenue_at")[2].alias("p99_revenue"),
        stamp(as_of).alias("updated_at"),
        month_text(F.col("pickup_date")).alias("_execution_date"),
    )


def gold_month_stats(daily: DataFrame, months: Months = None) -> DataFrame:
    """Days, trips, revenue and first and last day of each month of daily KPIs."""
    return (
        daily.where(within_months(F.col("pickup_date"), months))
        .groupBy(month_text(F.col("pickup_date")).alias("_execution_date"))
        .agg(
            F.count(F.lit(1)).alias("total_days"),
            F.sum("total_trips").alias("total_trips"),
            F.round(exact_sum(F.col("total_revenue")), 2).alias("total_revenue"),
            F.min("pickup_date").alias("min_date"),
            F.max("pickup_date").alias("max_date"),
        )
    )
