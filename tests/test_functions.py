import datetime as dt
import math
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from fareloom.functions import labels, measures, months


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def total(spark, values, partitions=1):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return rows.agg(measures.exact_sum(F.col("x")).alias("t")).first()["t"]


def test_exact_sum_has_no_noise(spark):
    values = [0.1] * 10 + [1e9, -1e9]
    assert reduce(add, reversed(values)) != 1.0
    assert total(spark, values) == 1.0
    assert total(spark, list(reversed(values))) == 1.0


def test_exact_sum_takes_noisy_cents_as_cents(spark):
    assert total(spark, [240.03 + 1, 241.04]) == 482.07


def test_exact_sum_keeps_values_between_units(spark):
    assert total(spark, [0.00001] * 4) == pytest.approx(0.00004, rel=1e-12)


def test_exact_sum_of_unusual_values(spark):
    assert total(spark, []) is None
    assert total(spark, [None, None]) is None
    assert total(spark, [None, 2.5]) == 2.5
    assert math.isnan(total(spark, [float("nan"), 1.0]))
    assert total(spark, [float("inf"), 1.0]) == math.inf
    assert total(spark, [9e14, 9e14]) == 1.8e15


@pytest.mark.parametrize("one_odd", [0.25, 0.12345])
def test_exact_sum_is_one_arithmetic_at_any_size(spark, one_odd):
    # Far beyond what longs in steps of 1e-12 hold, with and without a fifth decimal.
    values = [30_000.1 + i / 7 for i in range(400)] + [one_odd]
    assert len({total(spark, values, n) for n in (1, 3, 7)}) == 1
    assert total(spark, values) == pytest.approx(math.fsum(values), rel=1e-12)


def test_average_rate_is_independent_of_order(spark):
    rates = [(i * 37 % 101) / 700 for i in range(500)]
    averages = set()
    for ordered in (rates, sorted(rates), sorted(rates, reverse=True)):
        rows = spark.createDataFrame([(r,) for r in ordered], "x double").coalesce(1)
        averages.add(rows.agg(measures.avg_rate(F.col("x")).alias("a")).first()["a"])
    assert len(averages) == 1
    assert averages.pop() == pytest.approx(sum(rates) / 500)


@pytest.mark.parametrize(
    ("value", "default", "expected"),
    [(None, 1, 1), (0, 1, 1), (3, 1, 3), (None, None, None), (-2, None, 1)],
)
def test_at_least(spark, value, default, expected):
    column = measures.at_least(F.lit(value).cast("long"), 1, default)
    assert one(spark, column) == expected


def test_percent_text(spark):
    assert one(spark, measures.percent_text(F.lit(0.0712))) == "7.12%"
    assert one(spark, measures.percent_text(F.lit(0))) == "0.00%"
    assert one(spark, measures.percent_text(F.lit(0.1), 1)) == "10.0%"


def test_month_arithmetic():
    assert months.month_end("2024-12") == dt.date(2025, 1, 1)
    assert months.previous_month(dt.date(2024, 1, 31)) == "2023-12"
    assert months.month_span("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert months.month_list(["2024-02", "2024-01", "2024-02"]) == ["2024-01", "2024-02"]
    with pytest.raises(ValueError):
        months.month_list("2024-13")


def test_within_months_with_a_gap(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-10", "2024-03-01", "2024-04-01"]
    rows = spark.createDataFrame([(d,) for d in days], "d string")
    kept = rows.where(months.within_months(F.to_date("d"), ["2024-01", "2024-03"])).collect()
    assert [row["d"] for row in kept] == ["2024-01-01", "2024-01-31", "2024-03-01"]


def test_minutes_are_cut_toward_zero(spark):
    def minutes(start, end):
        times = [F.lit(dt.datetime.fromisoformat(t)).cast("timestamp_ntz") for t in (start, end)]
        return one(spark, months.minutes_between(*times))

    assert minutes("2024-01-01 00:00:30", "2024-01-01 00:02:29") == 1
    assert minutes("2024-01-01 00:02:29", "2024-01-01 00:00:30") == -1


def test_labels(spark):
    code = F.col("id")
    rows = spark.range(0, 8).select(
        labels.payment_label(code), labels.payment_label_lite(code), labels.rate_label(code)
    )
    pay, lite, rate = (list(column) for column in zip(*rows.collect(), strict=True))
    assert pay[1:5] == ["Credit Card", "Cash", "No Charge", "Dispute"]
    assert {pay[0], *pay[5:]} == {"Unknown"}
    assert lite[5] == "Unknown" and lite[0] == lite[6] == "Other"
    assert rate[1] == "Standard Rate" and rate[6] == "Group Ride" and rate[7] == "Unknown"
    missing = F.lit(None).cast("double")
    assert one(spark, labels.rate_label(missing)) == "Standard Rate"
    assert one(spark, labels.payment_label(missing)) == "Unknown"
    assert one(spark, labels.borough_group(F.lit(None).cast("string"))) == "Unknown"


def test_parts_of_the_day(spark):
    rows = spark.range(24).select(months.time_of_day_segment(F.col("id")).alias("s")).collect()
    parts = [row["s"] for row in rows]
    assert parts[0] == parts[22] == parts[23] == "Late Night"
    assert set(parts[1:6]) == {"Overnight"}
    assert set(parts[7:10]) == {"Morning Rush"}
    assert set(parts[11:14]) == {"Lunch"}
    assert set(parts[17:20]) == {"Evening Rush"}
    assert {parts[6], parts[10], *parts[14:17], *parts[20:22]} == {"Off-Peak"}
