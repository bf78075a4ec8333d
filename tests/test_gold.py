import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fareloom.functions.measures import percentiles
from fareloom.operators import zones
from fareloom.operators.daily import gold_month_stats, kpi_daily_revenue
from fareloom.operators.hourly import kpi_hourly_patterns
from fareloom.operators.trips import clean_trips

from .conftest import trip


@pytest.fixture(scope="module")
def silver(sample):
    return clean_trips(sample, "2024-01")


def test_daily_values(silver):
    days = {r["pickup_date"]: r for r in kpi_daily_revenue(silver, "2024-01").collect()}
    assert len(days) == 4
    expected = {
        "total_trips": 2,
        "total_passengers": 6,
        "total_revenue": 56.0,
        "avg_revenue_per_trip": 28.0,
        "total_fare": 44.0,
        "total_tips": 6.0,
        "avg_tip_rate": 0.15,
        "overall_tip_rate": 0.1364,
        "trips_with_tip": 1,
        "tip_incidence_rate": 0.5,
        "avg_trip_distance_miles": 5.0,
        "avg_trip_duration_min": 25.0,
        "credit_card_trips": 1,
        "cash_trips": 1,
        "airport_trips": 1,
        "revenue_per_mile": 5.6,
        "revenue_per_minute": 1.12,
        "p50_revenue": 26.0,
        "p90_revenue": 30.0,
        "p99_revenue": 30.0,
        "_execution_date": "2024-01",
    }
    row = days[dt.date(2024, 1, 4)].asDict()
    assert {name: row[name] for name in expected} == expected
    assert len(row) == 31


def test_daily_takes_only_the_months(silver):
    assert kpi_daily_revenue(silver, "2024-02").count() == 0
    assert kpi_daily_revenue(silver).count() == 4


def test_month_stats(silver):
    (row,) = gold_month_stats(kpi_daily_revenue(silver)).collect()
    assert (row["total_days"], row["total_trips"], row["total_revenue"]) == (4, 5, 173.25)
    assert (row["min_date"], row["max_date"]) == (dt.date(2024, 1, 4), dt.date(2024, 1, 31))


def zone_rows(silver, lookup):
    result = zones.kpi_zone_performance(silver, zones.dim_zones(lookup), "2024-01")
    return {row["location_id"]: row for row in result.collect()}


def test_zone_values(silver, lookup):
    rows = zone_rows(silver, lookup)
    assert set(rows) == {100, 230, 138, 79, 20}
    assert rows[79]["zone_name"] is None and rows[79]["borough_group"] is None
    assert rows[138]["is_airport"] and rows[138]["total_revenue"] == 90.25
    assert {row["rank_overall_by_pickups"] for row in rows.values()} == {1}
    assert rows[79]["month"] == dt.date(2024, 1, 1)
    assert len(rows[79]) == 22


def test_ranks_share_ties_within_a_borough(frame, lookup):
    trips = [
        trip(f"2024-01-15 0{i}:00:00", f"2024-01-15 0{i}:20:00", PULocationID=z, total_amount=a)
        for i, (z, a) in enumerate([(1, 10.0), (5, 10.0), (9, 4.0), (13, 20.0)])
    ]
    places = lookup.withColumn("Borough", F.lit("Queens"))
    rows = zone_rows(clean_trips(frame(trips)), places)
    assert {z: r["rank_in_borough_by_revenue"] for z, r in rows.items()} == {
        13: 1,
        1: 2,
        5: 2,
        9: 4,
    }
    assert rows[13]["revenue_share_in_borough"] == 0.4545


def test_zones_listed_twice_count_as_in_a_join(silver, lookup):
    """As joining first and grouping after: equal rows add up, others stand apart."""
    twice = lookup.union(lookup.where("LocationID = 100"))
    other = lookup.where("LocationID = 230").withColumn("Zone", F.lit("other name"))
    dim = zones.dim_zones(twice.union(other))
    rows = zones.zone_metrics(silver, dim).collect()
    joined = silver.join(dim, silver["pickup_location_id"] == dim["location_id"], "left")
    expected = {
        (row["pickup_location_id"], row["zone"]): (row["n"], row["revenue"])
        for row in joined.groupBy("pickup_location_id", "zone")
        .agg(F.count("*").alias("n"), F.round(F.sum("total_amount"), 2).alias("revenue"))
        .collect()
    }
    found = {
        (r["location_id"], r["zone_name"]): (r["total_pickups"], r["total_revenue"]) for r in rows
    }
    assert found == expected
    assert found[100, "zone 100"] == (2, 60.0)


def test_join_keeps_trips_of_unknown_zones(silver, lookup):
    joined = zones.join_trips_zones(silver, zones.dim_zones(lookup))
    assert joined.count() == 5
    assert joined.where("zone IS NULL").count() == 1


def test_hourly_values(frame):
    def at(day, hour, number, amount=10.0):
        return [
            trip(
                f"2024-01-{day:02d} {hour:02d}:{i:02d}:00",
                f"2024-01-{day:02d} {hour:02d}:{i + 5:02d}:00",
                total_amount=amount + i,
            )
            for i in range(number)
        ]

    # Mondays the 1st and 8th with 3 and 2 trips at 8; Saturday the 6th with 1 at 23.
    silver = clean_trips(frame(at(1, 8, 3) + at(8, 8, 2) + at(6, 23, 1)))
    rows = {(r["pickup_dow"], r["pickup_hour"]): r for r in kpi_hourly_patterns(silver).collect()}
    assert set(rows) == {(2, 8), (7, 23)}
    monday, saturday = rows[2, 8], rows[7, 23]
    assert (monday["day_of_week"], monday["day_type"]) == ("Monday", "Weekday")
    assert (saturday["day_of_week"], saturday["day_type"]) == ("Saturday", "Weekend")
    assert monday["avg_trips_per_day"] == 2.5
    assert monday["median_revenue"] == 11.0
    assert monday["time_of_day_segment"] == "Morning Rush"
    assert saturday["time_of_day_segment"] == "Late Night"
    assert monday["demand_index"] == round(2.5 / 1.75, 3)
    assert len(monday) == 19


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_percentiles_are_exact_on_a_large_day(spark, partitions):
    rows = spark.range(110_000, numPartitions=partitions)
    cents = (F.col("id") * 7919 % 20_011) / 100
    found = rows.select(cents.alias("total_amount")).agg(percentiles("total_amount", 0.5, 0.9, 0.99))
    ordered = sorted(i * 7919 % 20_011 for i in range(110_000))
    wanted = [ordered[math.ceil(110_000 * p / 100) - 1] / 100 for p in (50, 90, 99)]
    assert found.first()[0] == wanted
