import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareloom.operators import trips
from fareloom.operators.lite import clean_trips_lite

from .conftest import SAMPLE, plan_of, trip


def rows_of(df):
    return [row.asDict() for row in df.orderBy("pickup_datetime").collect()]


def test_sample_values(sample):
    rows = rows_of(trips.clean_trips(sample, "2024-01"))
    assert len(rows) == 5

    def column(name):
        return [row[name] for row in rows]

    assert column("pickup_hour") == [6, 19, 0, 16, 23]
    assert column("pickup_dow") == [5, 5, 6, 1, 4]
    assert column("trip_duration_min") == [30, 20, 48, 15, 12]
    assert column("tip_rate") == [6 / 20, 0, 15 / 60, 0, 2 / 10]
    assert column("revenue_per_minute") == [30 / 30, 26 / 20, 90.25 / 48, 12 / 15, 15 / 12]
    card = "Credit Card"
    assert column("payment_type") == [card, "Cash", card, "No Charge", card]
    assert column("rate_code")[2] == "JFK"
    assert column("is_store_and_forward") == [False, False, True, False, False]
    assert column("is_airport_trip") == [False, True, True, False, False]
    assert column("passenger_count") == [2, 4, 3, 5, 1]


def cleaned(frame, **values):
    rows = trips.clean_trips(frame([trip(**values)]), "2024-01").collect()
    return rows[0] if rows else None


def test_amounts_are_floored_but_ratios_are_not(frame):
    row = cleaned(frame, fare_amount=-12.0, tip_amount=3.0, total_amount=-17.0, extra=None)
    assert (row["fare_amount"], row["total_amount"], row["extra_amount"]) == (0, 0, 0)
    assert row["tip_rate"] == -0.25
    assert row["revenue_per_minute"] == -17 / 25


def test_missing_values(frame):
    row = cleaned(
        frame,
        VendorID=None,
        passenger_count=None,
        trip_distance=None,
        RatecodeID=None,
        store_and_fwd_flag=None,
        payment_type=None,
        fare_amount=0.0,
    )
    assert row["vendor_id"] == 0
    assert row["passenger_count"] == 1
    assert row["trip_distance_miles"] == 0
    assert row["rate_code"] == "Standard Rate"
    assert row["payment_type"] == "Unknown"
    assert row["is_store_and_forward"] is None
    assert row["tip_rate"] is None


def test_passengers_are_rounded(frame):
    assert cleaned(frame, passenger_count=1.5)["passenger_count"] == 2
    assert cleaned(frame, passenger_count=0.0)["passenger_count"] == 1


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({"dropoff": "2024-01-15 08:00:59"}, False),
        ({"dropoff": "2024-01-15 08:01:00"}, True),
        ({"dropoff": "2024-01-15 13:00:59"}, True),
        ({"dropoff": "2024-01-15 13:01:00"}, False),
        ({"dropoff": "2024-01-15 08:00:00"}, False),
        ({"dropoff": None}, False),
        ({"pickup": None}, False),
        ({"trip_distance": 200.0}, True),
        ({"trip_distance": 200.01}, False),
        ({"trip_distance": -5.0}, True),
        ({"PULocationID": 0}, False),
        ({"PULocationID": 265}, True),
        ({"DOLocationID": 266}, False),
        ({"DOLocationID": None}, False),
        ({"pickup": "2023-12-31 23:59:00", "dropoff": "2024-01-01 00:10:00"}, False),
        ({"pickup": "2024-01-31 23:59:59", "dropoff": "2024-02-01 00:10:00"}, True),
        ({"pickup": "2024-02-01 00:00:00", "dropoff": "2024-02-01 00:10:00"}, False),
    ],
)
def test_rules(frame, values, kept):
    assert (cleaned(frame, **values) is not None) == kept


def test_newest_copy_wins_before_the_filters(frame):
    """A newer copy with an invalid zone takes the valid older one with it."""
    newer = trip(PULocationID=0, _ingested_at=dt.datetime(2024, 3, 1))
    assert trips.clean_trips(frame([trip(), newer]), "2024-01").count() == 0


def test_missing_keys_are_one_trip(frame):
    rows = [trip(VendorID=None, total_amount=float(i)) for i in range(3)]
    assert trips.latest_trips(frame(rows)).count() == 1


def test_months_do_not_see_each_other(frame):
    other = trip(_execution_date="2024-02", _ingested_at=dt.datetime(2024, 3, 1))
    bronze = frame([trip(), other])
    assert trips.latest_trips(bronze).count() == 2
    assert trips.clean_trips(bronze).count() == 1
    assert trips.clean_trips(bronze, "2024-01").count() == 1
    assert trips.clean_trips(bronze, "2024-02").count() == 0


def test_all_months_are_the_union_of_single_months(spark):
    from suite.inputs import bronze

    from .conftest import SF

    rows = bronze(spark, SF).where(F.col("_execution_date").between("1996-01", "1996-03"))
    months = ["1996-01", "1996-02", "1996-03"]
    together = Counter(trips.clean_trips(rows).collect())
    listed = Counter(trips.clean_trips(rows, months).collect())
    single = Counter(row for m in months for row in trips.clean_trips(rows, m).collect())
    assert together == listed == single and together


def test_clean_and_rejected_make_up_the_deduplicated(spark):
    from suite.inputs import bronze

    from .conftest import SF

    rows = bronze(spark, SF)
    kept, out = trips.clean_trips(rows).count(), trips.rejected_trips(rows).count()
    assert kept + out == trips.latest_trips(rows).count()
    assert kept and out


def test_deduplication_is_idempotent(spark):
    from suite.inputs import bronze

    from .conftest import SF

    once = trips.latest_trips(bronze(spark, SF))
    assert once.exceptAll(trips.latest_trips(once)).count() == 0


COPY = st.builds(
    lambda vendor, minute, day, amount, zone: trip(
        f"2024-01-15 08:{minute:02d}:00",
        VendorID=vendor,
        _ingested_at=dt.datetime(2024, 2, day),
        total_amount=amount,
        PULocationID=zone,
    ),
    st.sampled_from([None, 1, 2]),
    st.integers(0, 2),
    st.integers(1, 3),
    st.sampled_from([1.0, 2.0, None]),
    st.sampled_from([None, 5, 7]),
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=st.lists(COPY, min_size=1, max_size=20))
def test_deduplication_against_brute_force(frame, rows):
    def rank(row):
        low = -1.0
        return [
            row["_ingested_at"],
            low if row["PULocationID"] is None else row["PULocationID"],
            low if row["total_amount"] is None else row["total_amount"],
        ]

    best = {}
    for row in rows:
        key = (row["VendorID"], row["tpep_pickup_datetime"])
        if key not in best or rank(row) > rank(best[key]):
            best[key] = row
    kept = trips.latest_trips(frame(rows)).collect()
    found = Counter((r["VendorID"], *rank(r.asDict())) for r in kept)
    assert found == Counter((r["VendorID"], *rank(r)) for r in best.values())


def test_a_key_with_most_rows_is_reduced_before_the_shuffle(frame, spark):
    hot = [{**SAMPLE[0], "total_amount": float(i)} for i in range(400)]
    bronze = frame(hot + SAMPLE).repartition(8)
    kept = trips.latest_trips(bronze)
    assert kept.count() == 5
    best = kept.where(F.col("tpep_pickup_datetime") == SAMPLE[0]["tpep_pickup_datetime"]).first()
    assert best["total_amount"] == 399.0
    plan = plan_of(kept)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_rejections_count_every_reason(frame):
    bad = trip(pickup=None, PULocationID=0, fare_amount=-1.0)
    counts = trips.rejected_trips_by_reason(frame([*SAMPLE, bad])).collect()
    found = {row["reason"]: row["rows_rejected"] for row in counts if row["rows_rejected"]}
    assert found == {
        "pickup_present": 1,
        "dropoff_after_pickup": 1,
        "duration_in_range": 1,
        "pickup_zone_valid": 1,
        "expected_month": 1,
        "negative_amount": 1,
    }


def test_lite_keeps_missing_amounts_and_copies(frame):
    rows = clean_trips_lite(
        frame([trip(fare_amount=None, payment_type=9), trip(), trip(total_amount=-1.0)])
    ).collect()
    assert len(rows) == 2
    assert {row["fare_amount"] for row in rows} == {None, 12.0}
    assert {row["payment_type"] for row in rows} == {"Other", "Credit Card"}
    assert rows[0]["avg_speed_mph"] == 2.5 / 25
