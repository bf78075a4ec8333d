"""The registered queries as DuckDB SQL over the given tables.

Named steps are kept once in ``STEPS``; a query is a body plus the steps it
names, directly or through other steps. Rounding is done on the decimal text of
a double, which is how Spark rounds doubles.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2026-01-01 00:00:00'"


def rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def total(column: str) -> str:
    """Sum of a column of hundredths, free of the noise of adding doubles."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(column: str) -> str:
    return f"({total(column)} / nullif(count({column}), 0))"


def mean_rate(column: str) -> str:
    """Mean of a ratio added in steps of 1e-12."""
    steps = f"sum(CAST(round_even({column} * 1000000000000, 0) AS HUGEINT))"
    return f"(CAST({steps} AS DOUBLE) / 1000000000000 / nullif(count({column}), 0))"


def portion(condition: str) -> str:
    return rounded(f"(count(*) FILTER ({condition}) / count(*))", 4)


def percent(rate: str, digits: int = 2) -> str:
    return f"format('{{:.{digits}f}}%', {rounded(rate, digits + 2)} * 100)"


def labelled(code: str, table: dict, otherwise: str) -> str:
    cases = " ".join(f"WHEN {key!r} THEN '{name}'" for key, name in table.items())
    return f"CASE {code} {cases} ELSE '{otherwise}' END"


PAYMENTS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
RATES = {
    1: "Standard Rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
}
BOROUGHS = {0: "Manhattan", 1: "Brooklyn", 2: "Queens", 3: "Bronx", 4: "Staten Island", 5: "EWR"}
GROUPS = {
    "Manhattan": "Core Manhattan",
    "Brooklyn": "Outer Borough",
    "Queens": "Outer Borough",
    "Bronx": "Outer Borough",
    "Staten Island": "Outer Borough",
    "EWR": "Airport",
}
DAYS = dict(enumerate("Sunday Monday Tuesday Wednesday Thursday Friday Saturday".split(), 1))

RAW = (
    '"VendorID" tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance '
    '"RatecodeID" store_and_fwd_flag "PULocationID" "DOLocationID" payment_type fare_amount extra '
    "mta_tax tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge "
    "airport_fee"
).split()
AUDIT = ["_ingested_at", "_source_file", "_execution_date"]
KEY = RAW[:3]
NEWEST = ", ".join(
    f"{name} DESC NULLS LAST" for name in ["_ingested_at", *RAW[3:], *AUDIT[1:]]
)

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

MINUTES = "date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)"

# Expressions of the silver columns on a bronze row.
IDENTITY = {
    "vendor_id": 'coalesce("VendorID", 0)',
    "pickup_location_id": '"PULocationID"',
    "dropoff_location_id": '"DOLocationID"',
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pickup_date": "CAST(tpep_pickup_datetime AS DATE)",
}
CALENDAR = {
    "pickup_hour": "CAST(hour(tpep_pickup_datetime) AS BIGINT)",
    "pickup_dow": "CAST(dayofweek(tpep_pickup_datetime) + 1 AS BIGINT)",
    "pickup_month": "CAST(month(tpep_pickup_datetime) AS BIGINT)",
    "pickup_year": "CAST(year(tpep_pickup_datetime) AS BIGINT)",
}
MEASURES = {
    "passenger_count": "greatest(coalesce(CAST(round(passenger_count) AS BIGINT), 1), 1)",
    "trip_distance_miles": "greatest(coalesce(trip_distance, 0.0), 0.0)",
    **{name: f"greatest(coalesce({raw}, 0.0), 0.0)" for name, raw in AMOUNTS.items()},
}
DURATION = {"trip_duration_min": MINUTES}
TIP_RATE = {"tip_rate": "tip_amount / nullif(fare_amount, 0)"}
PER_MINUTE = {"revenue_per_minute": f"total_amount / nullif({MINUTES}, 0)"}
PAYMENT = {"payment_type": labelled("payment_type", PAYMENTS, "Unknown")}
RATE = {
    "rate_code": labelled('coalesce(CAST(round("RatecodeID") AS BIGINT), 1)', RATES, "Unknown")
}
FORWARD = {"is_store_and_forward": "store_and_fwd_flag = 'Y'"}
AIRPORT = {
    "is_airport_trip": '"PULocationID" IN (1, 132, 138) OR "DOLocationID" IN (1, 132, 138)'
}
LINEAGE = {name: name for name in AUDIT}
SILVER = {
    **IDENTITY,
    **CALENDAR,
    **MEASURES,
    **DURATION,
    **TIP_RATE,
    **PER_MINUTE,
    **PAYMENT,
    **RATE,
    **FORWARD,
    **AIRPORT,
    **LINEAGE,
}

RULES = {
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "duration_in_range": "trip_duration_min BETWEEN 1 AND 300",
    "distance_in_range": "trip_distance_miles BETWEEN 0 AND 200",
    "pickup_zone_valid": "pickup_location_id BETWEEN 1 AND 265",
    "dropoff_zone_valid": "dropoff_location_id BETWEEN 1 AND 265",
    "non_negative_amounts": "fare_amount >= 0 AND total_amount >= 0",
    "expected_month": "strftime(pickup_date, '%Y-%m') = _execution_date",
}
ALL_RULES = " AND ".join(f"({rule})" for rule in RULES.values())


def select(columns: dict[str, str]) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in columns.items())


def newest(source: str, key: list[str]) -> str:
    order = f"row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {NEWEST})"
    return f"SELECT {', '.join(RAW + AUDIT)} FROM {source} QUALIFY {order} = 1"


STEPS: dict[str, str] = {}

STEPS["trip_rows"] = f"""
SELECT
  CASE WHEN l_suppkey % 50 <> 0 THEN CAST(l_suppkey % 2 + 1 AS BIGINT) END AS "VendorID",
  CASE WHEN l_partkey % 97 <> 0 THEN started END AS tpep_pickup_datetime,
  started + to_seconds(((l_partkey * 13 + l_suppkey) % 330 - 10) * 60 + l_partkey % 60)
    AS tpep_dropoff_datetime,
  CASE WHEN l_orderkey % 20 <> 0 THEN CAST(l_quantity % 10 AS DOUBLE) END AS passenger_count,
  CASE WHEN l_orderkey % 89 = 0 THEN 250.0::DOUBLE ELSE l_quantity / 2 - 1 END AS trip_distance,
  CAST(l_linenumber AS DOUBLE) AS "RatecodeID",
  CASE WHEN l_returnflag IN ('A', 'N') THEN replace(l_returnflag, 'A', 'Y') END
    AS store_and_fwd_flag,
  CAST(l_partkey % 268 AS BIGINT) AS "PULocationID",
  CAST(l_suppkey * 37 % 266 + 1 AS BIGINT) AS "DOLocationID",
  CASE WHEN l_orderkey % 20 <> 0 THEN CAST(l_orderkey % 6 + 1 AS BIGINT) END AS payment_type,
  (floor(l_extendedprice + 0.5) / 100) * sign AS fare_amount,
  CAST(l_linenumber % 3 AS DOUBLE) / 2 AS extra,
  0.5::DOUBLE AS mta_tax,
  CASE WHEN l_orderkey % 6 = 0 THEN floor(l_extendedprice * l_discount + 0.5) / 100
       ELSE 0.0::DOUBLE END AS tip_amount,
  CASE WHEN l_linenumber = 7 THEN 6.55::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
  1.0::DOUBLE AS improvement_surcharge,
  (floor(l_extendedprice * (1 + l_tax) + 0.5) / 100) * sign + batch AS total_amount,
  CASE WHEN l_orderkey % 2 = 0 THEN 2.5::DOUBLE END AS congestion_surcharge,
  CASE WHEN l_partkey % 268 IN (1, 132, 138) THEN 1.25::DOUBLE ELSE 0.0::DOUBLE END
    AS airport_fee,
  TIMESTAMP '2002-01-01 00:00:00' + to_days(batch) AS _ingested_at,
  'trips/' || strftime(l_shipdate, '%Y-%m') || '.parquet' AS _source_file,
  strftime(l_shipdate, '%Y-%m') AS _execution_date,
  l_linestatus AS line_status
FROM (
  SELECT *,
    l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber * 131) % 1440 * 60 + l_orderkey % 60)
      AS started,
    CASE WHEN l_orderkey % 31 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sign
  FROM lineitem
) AS item
JOIN (VALUES (0), (1)) AS delivery(batch) ON batch = 0 OR l_orderkey % 10 = 0
"""
STEPS["bronze"] = f"SELECT {', '.join(RAW + AUDIT)} FROM trip_rows"
STEPS["latest"] = newest("bronze", ["_execution_date", *KEY])
STEPS["cleaned"] = f"SELECT {select(SILVER)} FROM latest"
STEPS["cleaned_all"] = f"SELECT {select(SILVER)} FROM bronze"
STEPS["silver"] = f"SELECT * FROM cleaned WHERE {ALL_RULES}"
STEPS["lookup"] = f"""
SELECT p_partkey AS "LocationID",
  CASE p_partkey % 8 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in BOROUGHS.items())}
    WHEN 6 THEN 'Unknown' END AS "Borough",
  p_name AS "Zone", p_brand AS service_zone
FROM part
"""
STEPS["zones"] = f"""
SELECT "LocationID" AS location_id, "Borough" AS borough, "Zone" AS zone, service_zone,
  {labelled('"Borough"', GROUPS, "Unknown")} AS borough_group,
  "LocationID" IN (1, 132, 138) AS is_airport, {AS_OF} AS loaded_at
FROM lookup
"""

CARD = "payment_type = 'Credit Card'"
MILES, REVENUE = total("trip_distance_miles"), total("total_amount")
DAILY_COLUMNS = {
    "pickup_date": "pickup_date",
    "total_trips": "count(*)",
    "total_passengers": "CAST(sum(passenger_count) AS BIGINT)",
    "avg_passengers_per_trip": rounded("avg(passenger_count)", 2),
    "total_revenue": rounded(REVENUE, 2),
    "avg_revenue_per_trip": rounded(mean("total_amount"), 2),
    "total_fare": rounded(total("fare_amount"), 2),
    "total_tips": rounded(total("tip_amount"), 2),
    "total_tolls": rounded(total("tolls_amount"), 2),
    "total_congestion_surcharge": rounded(total("congestion_surcharge"), 2),
    "total_airport_fees": rounded(total("airport_fee"), 2),
    "avg_tip_rate": rounded(mean_rate("tip_rate"), 4),
    "overall_tip_rate": rounded(
        f"({total('tip_amount')} / nullif({total('fare_amount')}, 0))", 4
    ),
    "trips_with_tip": "count(*) FILTER (tip_amount > 0)",
    "tip_incidence_rate": portion("tip_amount > 0"),
    "avg_trip_distance_miles": rounded(mean("trip_distance_miles"), 2),
    "avg_trip_duration_min": rounded("avg(trip_duration_min)", 1),
    "avg_distance_per_trip": rounded(f"({MILES} / count(*))", 2),
    "credit_card_trips": f"count(*) FILTER ({CARD})",
    "cash_trips": "count(*) FILTER (payment_type = 'Cash')",
    "no_charge_trips": "count(*) FILTER (payment_type = 'No Charge')",
    "credit_card_rate": portion(CARD),
    "airport_trips": "count(*) FILTER (is_airport_trip)",
    "airport_trip_rate": portion("is_airport_trip"),
    "revenue_per_mile": rounded(f"({REVENUE} / nullif({MILES}, 0))", 2),
    "revenue_per_minute": rounded(f"({REVENUE} / nullif(sum(trip_duration_min), 0))", 4),
    **{
        f"p{cut}_revenue": rounded(f"quantile_disc(total_amount, {cut / 100})", 2)
        for cut in (50, 90, 99)
    },
    "updated_at": AS_OF,
    "_execution_date": "strftime(pickup_date, '%Y-%m')",
}
STEPS["daily"] = f"SELECT {select(DAILY_COLUMNS)} FROM silver GROUP BY pickup_date"

ZONE_COLUMNS = {
    "month": "CAST(date_trunc('month', pickup_date) AS DATE)",
    "location_id": "pickup_location_id",
    "zone_name": "zone",
    "borough": "borough",
    "borough_group": "borough_group",
    "is_airport": "is_airport",
    "total_pickups": "count(*)",
    "total_passengers": "CAST(sum(passenger_count) AS BIGINT)",
    "total_revenue": rounded(REVENUE, 2),
    "avg_revenue_per_trip": rounded(mean("total_amount"), 2),
    "total_fare": rounded(total("fare_amount"), 2),
    "total_tips": rounded(total("tip_amount"), 2),
    "avg_distance_miles": rounded(mean("trip_distance_miles"), 2),
    "avg_duration_min": rounded("avg(trip_duration_min)", 1),
    "avg_tip_rate": rounded(mean_rate("tip_rate"), 4),
    "credit_card_trips": f"count(*) FILTER ({CARD})",
    "credit_card_rate": portion(CARD),
}
STEPS["zone_stats"] = f"""
SELECT {select(ZONE_COLUMNS)}
FROM silver LEFT JOIN zones ON pickup_location_id = location_id
GROUP BY ALL
"""
IN_BOROUGH, IN_MONTH = "PARTITION BY month, borough", "PARTITION BY month"
RANK_BOROUGH = f"rank() OVER ({IN_BOROUGH} ORDER BY total_revenue DESC)"
RANK_ALL = f"rank() OVER ({IN_MONTH} ORDER BY total_pickups DESC)"
SHARE = rounded(f"(total_revenue / nullif(sum(total_revenue) OVER ({IN_BOROUGH}), 0))", 4)
STEPS["zone_kpi"] = f"""
SELECT *, {RANK_BOROUGH} AS rank_in_borough_by_revenue, {RANK_ALL} AS rank_overall_by_pickups,
  {SHARE} AS revenue_share_in_borough, {AS_OF} AS updated_at,
  strftime(month, '%Y-%m') AS _execution_date
FROM zone_stats
"""

SEGMENT = """
CASE WHEN pickup_hour IN (7, 8, 9) THEN 'Morning Rush' WHEN pickup_hour IN (11, 12, 13) THEN 'Lunch'
  WHEN pickup_hour IN (17, 18, 19) THEN 'Evening Rush' WHEN pickup_hour IN (22, 23, 0)
  THEN 'Late Night' WHEN pickup_hour IN (1, 2, 3, 4, 5) THEN 'Overnight' ELSE 'Off-Peak' END
"""
DAY_NAME = f"CASE pickup_dow {' '.join(f"WHEN {k} THEN '{v}'" for k, v in DAYS.items())} END"
DAY_TYPE = "CASE WHEN pickup_dow IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END"
HOUR_COLUMNS = {
    "month": "strftime(pickup_date, '%Y-%m')",
    "pickup_dow": "pickup_dow",
    "day_of_week": DAY_NAME,
    "day_type": DAY_TYPE,
    "pickup_hour": "pickup_hour",
    "total_trips": "count(*)",
    "avg_trips_per_day": rounded("(count(*) / count(DISTINCT pickup_date))", 1),
    "avg_revenue": rounded(mean("total_amount"), 2),
    "total_revenue": rounded(REVENUE, 2),
    "median_revenue": rounded("quantile_disc(total_amount, 0.5)", 2),
    "avg_distance_miles": rounded(mean("trip_distance_miles"), 2),
    "avg_duration_min": rounded("avg(trip_duration_min)", 1),
    "avg_passengers": rounded("avg(passenger_count)", 2),
    "avg_tip_rate": rounded(mean_rate("tip_rate"), 4),
    "tip_incidence_rate": portion("tip_amount > 0"),
    "credit_card_rate": portion(CARD),
}
STEPS["hour_stats"] = f"SELECT {select(HOUR_COLUMNS)} FROM silver GROUP BY ALL"
MONTH_MEAN = (
    f"(CAST(sum(CAST(avg_trips_per_day AS DECIMAL(18,1))) OVER ({IN_MONTH}) AS DOUBLE)"
    f" / count(*) OVER ({IN_MONTH}))"
)
INDEX = rounded(f"(avg_trips_per_day / nullif({MONTH_MEAN}, 0))", 3)
STEPS["hour_kpi"] = f"""
SELECT *, {AS_OF} AS updated_at, {SEGMENT} AS time_of_day_segment, {INDEX} AS demand_index
FROM hour_stats
"""
STEPS["stats"] = f"""
SELECT strftime(pickup_date, '%Y-%m') AS _execution_date, count(*) AS total_days,
  CAST(sum(total_trips) AS BIGINT) AS total_trips, {rounded(total("total_revenue"), 2)}
  AS total_revenue, min(pickup_date) AS min_date, max(pickup_date) AS max_date
FROM daily GROUP BY 1
"""

# The short variant.
LITE = {
    "vendor_id": '"VendorID"',
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pickup_date": IDENTITY["pickup_date"],
    "pickup_hour": CALENDAR["pickup_hour"],
    "pickup_dow": CALENDAR["pickup_dow"],
    "trip_duration_min": MINUTES,
    "passenger_count": "coalesce(passenger_count, 1)",
    "trip_distance_miles": "trip_distance",
    "pickup_location_id": '"PULocationID"',
    "dropoff_location_id": '"DOLocationID"',
    "payment_type": labelled("payment_type", {**PAYMENTS, 5: "Unknown"}, "Other"),
    **{
        name: f"CASE WHEN {name} < 0 THEN 0.0 ELSE {name} END"
        for name in ("fare_amount", "tip_amount", "total_amount")
    },
    "congestion_surcharge": "coalesce(congestion_surcharge, 0)",
    "airport_fee": "coalesce(airport_fee, 0)",
    "tip_rate": "tip_amount / nullif(fare_amount, 0)",
    "avg_speed_mph": f"trip_distance / nullif({MINUTES}, 0)",
    "_ingested_at": "_ingested_at",
    "_execution_date": "_execution_date",
}
STEPS["lite"] = f"""
SELECT {select(LITE)} FROM bronze
WHERE tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance >= 0 AND total_amount >= 0
"""
STEPS["lite_merged"] = STEPS["lite"].replace("FROM bronze", "FROM merged")
STEPS["lite_daily"] = f"""
SELECT pickup_date, _execution_date, count(*) AS total_trips,
  {total("passenger_count")} AS total_passengers, {rounded(REVENUE, 2)} AS total_revenue,
  {rounded(mean("total_amount"), 2)} AS avg_revenue_per_trip,
  {rounded(total("fare_amount"), 2)} AS total_fare,
  {rounded(total("tip_amount"), 2)} AS total_tips,
  {rounded(mean_rate("tip_rate"), 4)} AS avg_tip_rate,
  {rounded(mean("trip_distance_miles"), 2)} AS avg_trip_distance,
  {rounded("avg(trip_duration_min)", 1)} AS avg_trip_duration_min,
  count(*) FILTER ({CARD}) AS credit_card_trips,
  count(*) FILTER (payment_type = 'Cash') AS cash_trips, {AS_OF} AS updated_at
FROM lite GROUP BY pickup_date, _execution_date
"""
STEPS["lite_zones"] = f"""
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS month, pickup_location_id AS zone_id,
  zone AS zone_name, borough, count(*) AS total_pickups, {rounded(REVENUE, 2)} AS total_revenue,
  {rounded(mean("total_amount"), 2)} AS avg_revenue_per_trip,
  {rounded(mean("trip_distance_miles"), 2)} AS avg_distance,
  round({total("passenger_count")}) AS total_passengers,
  CAST(date_trunc('month', pickup_date) AS DATE) AS _partition_date, {AS_OF} AS updated_at,
  _execution_date
FROM lite LEFT JOIN zones ON pickup_location_id = location_id
GROUP BY ALL
"""
STEPS["lite_hours"] = f"""
SELECT strftime(pickup_date, '%Y-%m') AS month, pickup_dow, {DAY_NAME} AS day_of_week,
  pickup_hour, count(*) AS total_trips, {rounded(mean("total_amount"), 2)} AS avg_revenue,
  {rounded("avg(trip_duration_min)", 1)} AS avg_duration_min,
  {rounded(mean("trip_distance_miles"), 2)} AS avg_distance, {AS_OF} AS updated_at,
  _execution_date
FROM lite GROUP BY ALL
"""

# Checks: rows tested and failed by month, then status and text.
_CHECKS = {
    "not_null_pickup_datetime": (
        "bronze",
        "bronze",
        "_execution_date",
        "count(*)",
        "count(*) FILTER (tpep_pickup_datetime IS NULL)",
        0.0,
        "FAILED",
        "f || ' NULL pickup datetimes out of ' || n || ' rows'",
    ),
    "minimum_row_count": (
        "bronze",
        "bronze",
        "_execution_date",
        "count(*)",
        "CAST(count(*) < 1000 AS BIGINT)",
        None,
        "FAILED",
        "'Row count: ' || format('{:,}', n) || '. Minimum expected: 1,000'",
    ),
    "no_future_pickup_dates": (
        "bronze",
        "bronze",
        "_execution_date",
        "count(*)",
        f"count(*) FILTER (tpep_pickup_datetime > {AS_OF})",
        0.0,
        "WARNING",
        "f || ' rows with future pickup datetime'",
    ),
    "valid_location_ids": (
        "silver",
        "silver",
        "_execution_date",
        "count(*)",
        "count(*) FILTER (pickup_location_id NOT BETWEEN 1 AND 265"
        " OR dropoff_location_id NOT BETWEEN 1 AND 265)",
        0.001,
        "FAILED",
        "f || ' rows with invalid TLC zone IDs (allowed range: 1-265)'",
    ),
    "non_negative_amounts": (
        "silver",
        "silver",
        "_execution_date",
        "count(*)",
        "count(*) FILTER (least(total_amount, fare_amount) < 0)",
        0.0,
        "FAILED",
        "f || ' rows with negative total_amount or fare_amount'",
    ),
    "trip_duration_range_1_to_300_min": (
        "silver",
        "silver",
        "_execution_date",
        "count(*)",
        "count(*) FILTER (trip_duration_min < 1 OR trip_duration_min > 300)",
        0.005,
        "WARNING",
        f"f || ' trips with duration outside [1, 300] minutes (' || {percent('rate')} || ')'",
    ),
    "daily_revenue_completeness": (
        "gold",
        "daily",
        "strftime(pickup_date, '%Y-%m')",
        "count(DISTINCT pickup_date)",
        "CAST(count(DISTINCT pickup_date) < 25 AS BIGINT)",
        None,
        "FAILED",
        "n || ' days found in kpi_daily_revenue for ' || m || '. Minimum: 25'",
    ),
    "positive_daily_revenue": (
        "gold",
        "daily",
        "strftime(pickup_date, '%Y-%m')",
        "count(*)",
        "count(*) FILTER (total_revenue <= 0)",
        0.0,
        "FAILED",
        "f || ' days with zero or negative total_revenue'",
    ),
}


def check(name: str, source: str | None = None) -> str:
    layer, step, month, tested, failed, threshold, severity, text = _CHECKS[name]
    table = "kpi_daily_revenue" if layer == "gold" else "trips"
    rate = "0.0::DOUBLE" if threshold is None else "f / n"
    bad = "f > 0" if threshold is None else f"rate > {threshold}"
    return f"""
SELECT m AS execution_date, '{name}' AS check_name, '{layer}' AS layer,
  '{layer}.{table}' AS table_name, CASE WHEN {bad} THEN '{severity}' ELSE 'PASSED' END AS status,
  n AS rows_tested, f AS rows_failed, rate AS failure_rate,
  {threshold or 0.0}::DOUBLE AS threshold, {text} AS details
FROM (SELECT *, {rate} AS rate FROM (
  SELECT {month} AS m, {tested} AS n, {failed} AS f FROM {source or step} GROUP BY 1))
"""


def checks_of(layer: str, source: str | None = None) -> str:
    names = [name for name, spec in _CHECKS.items() if spec[0] == layer]
    return " UNION ALL ".join(check(name, source) for name in names)


STEPS["all_checks"] = " UNION ALL ".join(check(name) for name in _CHECKS)

STEPS["run_events"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y-%m') AS execution_date,
  'dev' AS env,
  CASE WHEN step = 0 THEN 'STARTED' WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'FAILED' END
    AS status,
  o_orderdate + to_seconds(o_orderkey % 86400 + step * (o_custkey % 3600 + 1)) AS run_date,
  CASE WHEN step = 1 THEN o_orderdate
    + to_seconds(o_orderkey % 86400 + o_custkey % 3600 + 1 + o_orderkey % 7) END AS completed_at,
  CASE WHEN step = 1 AND o_orderstatus = 'F' THEN o_custkey * 100 END AS rows_ingested,
  CASE WHEN step = 1 THEN CAST(o_custkey % 3600 + 1 AS DOUBLE) END AS duration_seconds,
  CASE WHEN step = 1 AND o_orderstatus = 'P' THEN o_orderpriority END AS error_message
FROM orders JOIN (VALUES (0), (1)) AS steps(step) ON step = 0 OR o_orderstatus IN ('F', 'P')
"""
STEPS["recent"] = """
SELECT * FROM run_events
ORDER BY run_date DESC, run_id DESC, status DESC LIMIT 20
"""

# Raw trips of the single month of events, through the same cleaning.
STEPS["event_bronze"] = f"""
SELECT CAST(user_id % 2 + 1 AS BIGINT) AS "VendorID", ts AS tpep_pickup_datetime,
  ts + to_seconds((event_id % 290 + 1) * 60 + event_id % 60) AS tpep_dropoff_datetime,
  CAST(event_id % 7 AS DOUBLE) AS passenger_count,
  CAST(event_id % 400 AS DOUBLE) / 10 AS trip_distance,
  CAST(event_id % 8 AS DOUBLE) AS "RatecodeID",
  CASE user_id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS store_and_fwd_flag,
  CAST(user_id % 266 + 1 AS BIGINT) AS "PULocationID",
  CAST(event_id * 13 % 265 + 1 AS BIGINT) AS "DOLocationID",
  CAST(list_position(['click', 'view', 'purchase', 'signup', 'error'], event_type) AS BIGINT)
    AS payment_type,
  floor(value * 80 + 0.5) / 100 AS fare_amount, 0.5::DOUBLE AS extra,
  0.5::DOUBLE AS mta_tax,
  CASE WHEN event_type = 'click' THEN floor(value * 12 + 0.5) / 100 ELSE 0.0::DOUBLE END
    AS tip_amount,
  0.0::DOUBLE AS tolls_amount, 1.0::DOUBLE AS improvement_surcharge,
  floor(value * 100 + 0.5) / 100 AS total_amount,
  CASE WHEN event_id % 2 = 0 THEN 2.5::DOUBLE END AS congestion_surcharge,
  0.0::DOUBLE AS airport_fee, {AS_OF} AS _ingested_at, 'events' AS _source_file,
  (SELECT strftime(max(ts), '%Y-%m') FROM events) AS _execution_date
FROM events
"""
STEPS["event_latest"] = newest("event_bronze", KEY)
STEPS["event_silver"] = (
    f"SELECT * FROM (SELECT {select(SILVER)} FROM event_latest) WHERE {ALL_RULES}"
)
# One delivery with the second copies in it: all rows share one ingestion time.
STEPS["drop_bronze"] = f"""
SELECT {", ".join(RAW)}, {AS_OF} AS _ingested_at, _source_file, _execution_date FROM bronze
"""
STEPS["merged"] = newest("drop_bronze", KEY)
STEPS["drop_latest"] = newest("drop_bronze", ["_execution_date", *KEY])
STEPS["drop_silver"] = (
    f"SELECT * FROM (SELECT {select(SILVER)} FROM drop_latest) WHERE {ALL_RULES}"
)


def run_summary(bronze: str, silver: str) -> str:
    """A summary row per month with a bronze row."""
    small = "coalesce(trips, 0) < 1000"
    return f"""
SELECT 'run-1' AS run_id, m AS execution_date,
  CASE WHEN {small} THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  trips AS total_trips, revenue AS total_revenue, n AS rows_ingested, n AS rows_bronze,
  coalesce(trips, 0) AS rows_silver, days + zones + hours AS rows_gold,
  CASE WHEN {small} THEN 'gold quality gate failed: too few trips' END AS error_message
FROM (SELECT _execution_date AS m, count(*) AS n FROM {bronze} GROUP BY 1) AS delivered
LEFT JOIN (
  SELECT _execution_date AS m, count(*) AS trips, {REVENUE} AS revenue,
    count(DISTINCT pickup_date) AS days, count(DISTINCT pickup_location_id) AS zones,
    count(DISTINCT pickup_dow * 100 + pickup_hour) AS hours
  FROM {silver} GROUP BY 1) AS kept USING (m)
"""


def with_steps(body: str) -> str:
    """Put the steps a body needs in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"(FROM|JOIN) {name}\b", text):
                visit(STEPS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    steps = ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in needed)
    return f"WITH {steps}\n{body.strip()}" if needed else body.strip()


def derived(*groups: dict[str, str]) -> str:
    columns = {name: value for group in groups for name, value in group.items()}
    keys = ", ".join(f'{name} AS "key_{name.strip(chr(34))}"' for name in KEY)
    return f"SELECT {keys}, {select(columns)} FROM bronze"


WITHOUT_FEE = ", ".join(
    "CAST(NULL AS DOUBLE) AS airport_fee" if name == "airport_fee" else name
    for name in RAW + AUDIT
)
RAW_MONTH = f"SELECT {', '.join(RAW)}, _execution_date FROM bronze"
MONTH_COUNTS = """
SELECT _execution_date, count(*) AS row_count,
  count(*) FILTER (strftime(tpep_pickup_datetime, '%Y-%m') = _execution_date) AS rows_in_month
FROM bronze GROUP BY 1
"""
MONTH_SHARES = f"SELECT *, rows_in_month / row_count AS month_share FROM ({MONTH_COUNTS})"
SHARE_ISSUE = (
    f"'Only ' || {percent('month_share', 1)} || ' of rows are within expected month '"
    " || _execution_date"
)
NO_RUN = (
    "CAST(NULL AS BIGINT) AS rows_bronze, CAST(NULL AS BIGINT) AS rows_silver, "
    "CAST(NULL AS BIGINT) AS rows_gold, CAST(NULL AS VARCHAR) AS error_message"
)
NO_TIME = "CAST(NULL AS TIMESTAMP) AS completed_at, CAST(NULL AS DOUBLE) AS duration_seconds"
INSERTED = f"""
SELECT s.* FROM ({newest("bronze", KEY)}) AS s
WHERE NOT EXISTS (SELECT 1 FROM trip_rows AS t WHERE t.line_status = 'F'
  AND {{match}})
"""


def same_key(operator: str) -> str:
    return " AND ".join(f"t.{name} {operator} s.{name}" for name in KEY)


ZONE_WINDOW = "SELECT month, borough, location_id, total_revenue, total_pickups, {} FROM zone_stats"
LAST = "(run_date, status <> 'STARTED')"

_BODIES = {
    "kpi_daily_revenue": "SELECT * FROM daily",
    "kpi_zone_performance": "SELECT * FROM zone_kpi",
    "kpi_hourly_patterns": "SELECT * FROM hour_kpi",
    "scan_raw_trips": RAW_MONTH,
    "conform_bronze_schema": f"SELECT {WITHOUT_FEE} FROM bronze",
    "add_audit_columns": f"""
        SELECT {", ".join(RAW)}, {AS_OF} AS _ingested_at, _source_file, _execution_date
        FROM bronze""",
    "normalize_column_names": RAW_MONTH,
    "append_bronze": "SELECT * FROM bronze",
    "skip_loaded_files": """
        SELECT _source_file, _execution_date, count(*) AS rows_delivered FROM bronze
        GROUP BY ALL HAVING count(*) % 2 = 1""",
    "write_silver_partitioned": "SELECT * FROM silver",
    "republished_silver": """
        SELECT * FROM silver
        WHERE CAST(substr(_execution_date, 6, 2) AS INTEGER) % 2 = 0 OR NOT is_airport_trip""",
    "write_gold_tables": f"""
        SELECT _execution_date AS month, 'kpi_daily_revenue' AS table_name,
          count(*) AS rows_written, {rounded("sum(total_revenue)", 2)} AS total_revenue
        FROM daily GROUP BY 1
        UNION ALL SELECT _execution_date, 'kpi_zone_performance', count(*),
          {rounded("sum(total_revenue)", 2)} FROM zone_kpi GROUP BY 1
        UNION ALL SELECT month, 'kpi_hourly_patterns', count(*),
          {rounded("sum(total_revenue)", 2)} FROM hour_kpi GROUP BY 1""",
    "gold_in_order": """
        SELECT 'kpi_daily_revenue' AS table_name, _execution_date AS month,
          CAST(pickup_date AS VARCHAR) AS row_name, row_number() OVER (ORDER BY pickup_date) AS position
        FROM daily
        UNION ALL SELECT 'kpi_zone_performance', substr(CAST(month AS VARCHAR), 1, 7), CAST(location_id AS VARCHAR), row_number() OVER (
          ORDER BY month, borough NULLS FIRST, rank_in_borough_by_revenue, location_id)
        FROM zone_kpi
        UNION ALL SELECT 'kpi_hourly_patterns', substr(CAST(month AS VARCHAR), 1, 7), pickup_dow || '/' || pickup_hour,
          row_number() OVER (ORDER BY month, pickup_dow, pickup_hour)
        FROM hour_kpi""",
    "scan_zone_lookup": "SELECT * FROM lookup",
    "append_metadata_rows": f"""
        SELECT 'run-' || _execution_date AS run_id, _execution_date AS execution_date,
          'dev' AS env, 'COMPLETED' AS status, {AS_OF} AS run_date, count(*) AS rows_ingested,
          {NO_TIME}, {NO_RUN}
        FROM bronze GROUP BY ALL""",
    "validate_not_empty": """
        SELECT _execution_date, count(*) AS row_count, count(*) = 0 AS is_empty
        FROM bronze GROUP BY 1""",
    "validate_required_columns": f"""
        SELECT _execution_date, 'Missing required column: total_amount'
          || CASE WHEN month_share < 0.8 THEN '; ' || {SHARE_ISSUE} ELSE '' END AS issues
        FROM ({MONTH_SHARES})""",
    "validate_month_ratio": f"SELECT *, month_share < 0.8 AS too_few FROM ({MONTH_SHARES})",
    "validation_report": f"""
        SELECT _execution_date, row_count, CAST(19 AS BIGINT) AS column_count, month_share,
          CASE WHEN month_share < 0.8 THEN {SHARE_ISSUE} ELSE '' END AS issues,
          month_share >= 0.8 AS valid
        FROM ({MONTH_SHARES})""",
    "dedup_latest_trip": "SELECT * FROM latest",
    "rename_and_type": derived(IDENTITY),
    "extract_calendar_parts": derived(CALENDAR),
    "default_and_floor_measures": derived(MEASURES),
    "trip_duration_minutes": derived(DURATION),
    "tip_rate": derived(TIP_RATE),
    "revenue_per_minute": derived(PER_MINUTE),
    "decode_payment_type": derived(PAYMENT),
    "decode_rate_code": derived(RATE),
    "store_and_forward_flag": derived(FORWARD),
    "airport_trip_flag": derived(AIRPORT),
    "filter_valid_trips": f"SELECT * FROM cleaned_all WHERE {ALL_RULES}",
    "clean_trips": "SELECT * FROM silver",
    "rejected_trips": f"""
        SELECT * FROM (SELECT *, concat_ws(',', {", ".join(
            f"CASE WHEN ({rule}) IS NOT TRUE THEN '{name}' END" for name, rule in RULES.items()
        )}) AS reasons FROM cleaned) WHERE reasons <> ''""",
    "rejected_trips_by_reason": " UNION ALL ".join(
        f"SELECT _execution_date, '{name}' AS reason,"
        f" count(*) FILTER (({rule}) IS NOT TRUE) AS rows_rejected FROM cleaned GROUP BY 1"
        for name, rule in RULES.items()
    )
    + """ UNION ALL SELECT _execution_date, 'negative_amount',
        count(*) FILTER (fare_amount < 0 OR total_amount < 0) FROM latest GROUP BY 1""",
    "clean_trips_lite": "SELECT * FROM lite",
    "dim_zones": "SELECT * FROM zones",
    "borough_group": "SELECT location_id, borough, borough_group FROM zones",
    "zone_is_airport": "SELECT location_id, is_airport FROM zones",
    "join_trips_zones": """
        SELECT vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, total_amount,
          zone, borough, borough_group, is_airport, service_zone
        FROM silver LEFT JOIN zones ON pickup_location_id = location_id""",
    "merge_insert_new_trips": INSERTED.format(match=same_key("=")),
    "merge_insert_new_trips_null_safe": INSERTED.format(match=same_key("IS NOT DISTINCT FROM")),
    "merge_indexed": INSERTED.format(match=same_key("=")),
    "kpi_daily_revenue_lite": "SELECT * FROM lite_daily",
    "kpi_zone_performance_lite": "SELECT * FROM lite_zones",
    "kpi_hourly_patterns_lite": "SELECT * FROM lite_hours",
    "gold_month_stats": "SELECT * FROM stats",
    "rank_zones_in_borough": ZONE_WINDOW.format(f"{RANK_BOROUGH} AS rank_in_borough_by_revenue"),
    "rank_zones_overall": ZONE_WINDOW.format(f"{RANK_ALL} AS rank_overall_by_pickups"),
    "revenue_share_in_borough": ZONE_WINDOW.format(f"{SHARE} AS revenue_share_in_borough"),
    "demand_index": f"""
        SELECT month, pickup_dow, pickup_hour, avg_trips_per_day, {INDEX} AS demand_index
        FROM hour_stats""",
    "day_name_and_type": f"""
        SELECT pickup_datetime, pickup_dow, {DAY_NAME} AS day_of_week, {DAY_TYPE} AS day_type
        FROM silver""",
    "time_of_day_segment": f"""
        SELECT pickup_datetime, pickup_hour, {SEGMENT} AS time_of_day_segment FROM silver""",
    "recent_runs": "SELECT * FROM recent",
    "rows_from_structs": checks_of("silver", "cleaned_all"),
    "dq_not_null_pickup": check("not_null_pickup_datetime"),
    "dq_min_row_count": check("minimum_row_count"),
    "dq_no_future_pickup": check("no_future_pickup_dates"),
    "dq_valid_location_ids": check("valid_location_ids", "cleaned_all"),
    "dq_non_negative_amounts": check("non_negative_amounts"),
    "dq_trip_duration_range": check("trip_duration_range_1_to_300_min", "cleaned_all"),
    "dq_daily_completeness": check("daily_revenue_completeness"),
    "dq_positive_daily_revenue": check("positive_daily_revenue"),
    "dq_run_all": "SELECT * FROM all_checks",
    "dq_bronze_inline": """
        SELECT _execution_date AS execution_date, 'not_null_pickup_datetime' AS check_name,
          'bronze' AS layer, 'bronze.trips' AS table_name,
          CASE WHEN count(*) = count(tpep_pickup_datetime) THEN 'PASSED' ELSE 'FAILED' END
            AS status,
          count(*) AS rows_tested, count(*) - count(tpep_pickup_datetime) AS rows_failed,
          (count(*) - count(tpep_pickup_datetime)) / count(*) AS failure_rate,
          0.0::DOUBLE AS threshold, 'NULL pickup datetimes' AS details
        FROM bronze GROUP BY 1""",
    "dq_gate_summary": """
        SELECT execution_date, count(*) FILTER (status = 'PASSED') AS passed,
          count(*) FILTER (status = 'WARNING') AS warnings,
          count(*) FILTER (status = 'FAILED') AS failed,
          CASE WHEN bool_or(status = 'FAILED') THEN 'FAIL' ELSE 'PASS' END AS verdict
        FROM all_checks GROUP BY 1""",
    "gold_min_trips_gate": "SELECT *, total_trips >= 1000 AS enough_trips FROM stats",
    "failure_pct": f"""
        SELECT execution_date, check_name, failure_rate, {percent("failure_rate")} AS failure_pct
        FROM all_checks WHERE layer = 'bronze'""",
    "log_run_start": f"""
        SELECT DISTINCT 'run-1' AS run_id, _execution_date AS execution_date, 'dev' AS env,
          'STARTED' AS status, {AS_OF} AS run_date, CAST(NULL AS BIGINT) AS rows_ingested,
          {NO_TIME}, {NO_RUN}
        FROM bronze""",
    "log_run_end": f"""
        SELECT 'run-1' AS run_id, _execution_date AS execution_date, 'dev' AS env,
          'COMPLETED' AS status, {AS_OF} AS run_date, count(*) AS rows_ingested,
          {AS_OF} AS completed_at, 31536000.0::DOUBLE AS duration_seconds, {NO_RUN}
        FROM bronze GROUP BY ALL""",
    "log_quality_results": f"""
        SELECT 'run-1' AS run_id, *, {AS_OF} AS check_timestamp
        FROM all_checks WHERE layer = 'bronze'""",
    "run_history": """
        SELECT run_id, execution_date, status, run_date, rows_ingested, duration_seconds,
          date_sub('second', run_date, completed_at) AS total_duration_s, error_message
        FROM recent""",
    "quality_trend": """
        SELECT execution_date, layer, check_name, status, rows_failed, failure_rate,
          CAST(strptime(execution_date, '%Y-%m') + INTERVAL 1 MONTH AS TIMESTAMP)
            AS check_timestamp
        FROM all_checks WHERE status <> 'PASSED'""",
    "latest_run_status": f"""
        SELECT run_id, execution_date, min(run_date) AS started_at, max(run_date) AS last_event_at,
          {", ".join(
              f"max_by(event, {LAST}).{name} AS {name}"
              for name in ("env", "status", "completed_at", "error_message", "rows_ingested")
          )}
        FROM (SELECT run_id, execution_date, run_date, status, {{
          'env': env, 'status': status, 'completed_at': completed_at,
          'error_message': error_message, 'rows_ingested': rows_ingested}} AS event
          FROM run_events)
        GROUP BY 1, 2""",
    "run_month": run_summary("event_bronze", "event_silver"),
    "run_months": run_summary("drop_bronze", "drop_silver"),
    "run_months_lite": f"""
        SELECT m AS execution_date,
          CASE WHEN coalesce(trips, 0) < 1000 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
          trips AS total_trips, revenue AS total_revenue, n AS rows_ingested, n AS rows_bronze
        FROM (SELECT DISTINCT _execution_date AS m FROM drop_bronze) AS delivered
        LEFT JOIN (SELECT _execution_date AS m, count(*) AS n FROM merged GROUP BY 1) AS held USING (m)
        LEFT JOIN (
          SELECT strftime(pickup_date, '%Y-%m') AS m, count(*) AS trips, {rounded(REVENUE, 2)} AS revenue
          FROM lite_merged GROUP BY 1) AS kept USING (m)""",
}

ORACLE: dict[str, str] = {name: with_steps(body) for name, body in _BODIES.items()}
