"""Zone dimension, its join to trips, and monthly KPIs per pickup zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions import labels
from fareloom.functions.measures import avg_rate, exact_avg, exact_sum, safe_divide, share
from fareloom.functions.months import Months, month_date, month_text, within_months
from fareloom.operators.daily import stamp

ZONE_COLUMNS = ("zone", "borough", "borough_group", "is_airport")


def dim_zones(lookup: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    return lookup.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
        labels.borough_group(F.col("Borough")).alias("borough_group"),
        labels.is_airport(F.col("LocationID")).alias("is_airport"),
        stamp(as_of).alias("loaded_at"),
    )


def join_trips_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Every trip with its pickup zone; trips of unknown zones keep NULLs.

    AQE broadcasts the zones if their measured bytes allow it, else it splits the
    partitions of busy zones.
    """
    names = zones.select("location_id", *ZONE_COLUMNS, "service_zone")
    matched = trips["pickup_location_id"] == names["location_id"]
    return trips.join(names, matched, "left").drop("location_id")


def zone_metrics(trips: DataFrame, zones: DataFrame, months: Months = None) -> DataFrame:
    """Totals per month and pickup zone, with the zone's attributes.

    Trips are reduced to months and zones before the join, which leaves only a
    few hundred rows per month to join. A zone listed more than once with the
    same attributes counts its trips that many times, as joining first would.
    """
    by_zone = (
        trips.where(within_months(F.col("pickup_date"), months))
        .groupBy(
            month_date(F.col("pickup_date")).alias("month"),
            F.col("pickup_location_id"),
        )
        .agg(
            F.count(F.lit(1)).alias("pickups"),
            F.sum("passenger_count").alias("passengers"),
            exact_sum(F.col("total_amount")).alias("revenue"),
            exact_sum(F.col("fare_amount")).alias("fare"),
            exact_sum(F.col("tip_amount")).alias("tips"),
            exact_avg(F.col("total_amount")).alias("avg_revenue"),
            exact_avg(F.col("trip_distance_miles")).alias("avg_miles"),
            F.avg("trip_duration_min").alias("avg_minutes"),
            avg_rate(F.col("tip_rate")).alias("avg_rate"),
            F.count_if(F.col("payment_type") == "Credit Card").alias("card_trips"),
            share(F.col("payment_type") == "Credit Card").alias("credit_card_rate"),
        )
    )
    attributes = zones.groupBy("location_id", *ZONE_COLUMNS).agg(
        F.count(F.lit(1)).alias("copies")
    )
    joined = by_zone.join(
        attributes, by_zone["pickup_location_id"] == attributes["location_id"], "left"
    )
    copies = F.coalesce("copies", F.lit(1))

    def total(name: str) -> Column:
        return F.col(name) * copies

    return joined.select(
        "month",
        F.col("pickup_location_id").alias("location_id"),
        F.col("zone").alias("zone_name"),
        "borough",
        "borough_group",
        "is_airport",
        total("pickups").alias("total_pickups"),
        total("passengers").alias("total_passengers"),
        F.round(total("revenue"), 2).alias("total_revenue"),
        F.round("avg_revenue", 2).alias("avg_revenue_per_trip"),
        F.round(total("fare"), 2).alias("total_fare"),
        F.round(total("tips"), 2).alias("total_tips"),
        F.round("avg_miles", 2).alias("avg_distance_miles"),
        F.round("avg_minutes", 1).alias("avg_duration_min"),
        F.round("avg_rate", 4).alias("avg_tip_rate"),
        total("card_trips").alias("credit_card_trips"),
        "credit_card_rate",
    )


def rank_zones_in_borough() -> Column:
    """By revenue; zones without a borough are ranked among themselves."""
    order = Window.partitionBy("month", "borough").orderBy(F.desc("total_revenue"))
    return F.rank().over(order).cast("long").alias("rank_in_borough_by_revenue")


def rank_zones_overall() -> Column:
    order = Window.partitionBy("month").orderBy(F.desc("total_pickups"))
    return F.rank().over(order).cast("long").alias("rank_overall_by_pickups")


def revenue_share_in_borough() -> Column:
    """Share of the rounded revenues of the month and borough."""
    borough = F.sum("total_revenue").over(Window.partitionBy("month", "borough"))
    return F.round(safe_divide(F.col("total_revenue"), borough), 4).alias(
        "revenue_share_in_borough"
    )


def kpi_zone_performance(
    trips: DataFrame,
    zones: DataFrame,
    months: Months = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Zone metrics with ranks and shares; a window holds one month's zones at most."""
    return zone_metrics(trips, zones, months).select(
        "*",
        rank_zones_in_borough(),
        rank_zones_overall(),
        revenue_share_in_borough(),
        stamp(as_of).alias("updated_at"),
        month_text(F.col("month")).alias("_execution_date"),
    )
