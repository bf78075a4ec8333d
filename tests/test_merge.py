import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareloom import schemas
from fareloom.operators.merge import merge_insert_new_trips

from .conftest import plan_of, trip


def brute_force(staging, target, null_safe):
    """Keys inserted by an insert-only merge of the newest staged row per key."""

    def key(row):
        return tuple(row[name] for name in schemas.TRIP_KEY)

    known = {key(row) for row in target}
    if not null_safe:
        known = {k for k in known if None not in k}
    return {k for k in map(key, staging) if k not in known}


ROW = st.builds(
    lambda vendor, minute, end, day: trip(
        None if minute is None else f"2024-01-15 08:{minute:02d}:00",
        end,
        VendorID=vendor,
        _ingested_at=dt.datetime(2024, 2, day),
    ),
    st.sampled_from([None, 1, 2]),
    st.sampled_from([None, 0, 1]),
    st.sampled_from([None, "2024-01-15 09:00:00"]),
    st.integers(1, 3),
)


@pytest.mark.parametrize("null_safe", [False, True])
@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(staging=st.lists(ROW, min_size=1, max_size=12), target=st.lists(ROW, max_size=12))
def test_against_brute_force(frame, null_safe, staging, target):
    rows = merge_insert_new_trips(frame(staging), frame(target), null_safe=null_safe).collect()
    found = Counter(tuple(row[name] for name in schemas.TRIP_KEY) for row in rows)
    assert found == Counter(brute_force(staging, target, null_safe))


def test_existing_rows_win_and_the_newest_staged_is_inserted(frame):
    new = "2024-01-15 10:00:00"
    staging = [
        trip(total_amount=99.0),
        trip(new, "2024-01-15 10:30:00", total_amount=1.0),
        trip(
            new,
            "2024-01-15 10:30:00",
            total_amount=2.0,
            _ingested_at=dt.datetime(2024, 3, 1),
        ),
    ]
    (row,) = merge_insert_new_trips(frame(staging), frame([trip()])).collect()
    assert row["total_amount"] == 2.0
    assert row.asDict().keys() == set(schemas.BRONZE_TRIPS.names)


def test_only_the_months_staged(frame):
    staging = [trip(_execution_date="2024-01"), trip(VendorID=2, _execution_date="2024-02")]
    rows = merge_insert_new_trips(frame(staging), frame([]), "2024-02").collect()
    assert [row["VendorID"] for row in rows] == [2]


def test_each_side_is_shuffled_once_and_reduced_before(spark, tmp_path, frame):
    path = str(tmp_path / "bronze")
    frame([trip()]).write.parquet(path)
    bronze = spark.read.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(merge_insert_new_trips(bronze, bronze))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tree = plan.split("\n\n\n")[0]
    assert tree.count("Exchange") == 2
    assert tree.count("WindowGroupLimit") == 2
    assert tree.count("HashAggregate") == 2
    scans = [part for part in plan.split("\n\n") if "ReadSchema" in part]
    keys_only = [part for part in scans if "total_amount" not in part]
    assert len(keys_only) == 1
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-15T08:00)" in keys_only[0]
