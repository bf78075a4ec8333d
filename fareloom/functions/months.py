"""Months, given as ``YYYY-MM`` text, and calendar labels."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")

Months = str | Iterable[str] | None

# Day number (1 = Sunday) to day name.
DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

# Hours of each part of the day; all other hours are Off-Peak.
DAY_PARTS = {
    "Morning Rush": (7, 8, 9),
    "Lunch": (11, 12, 13),
    "Evening Rush": (17, 18, 19),
    "Late Night": (22, 23, 0),
    "Overnight": (1, 2, 3, 4, 5),
}


def month_list(months: Months) -> list[str] | None:
    """Sorted distinct months, or ``None`` for all months."""
    if months is None:
        return None
    wanted = sorted({months} if isinstance(months, str) else set(months))
    for month in wanted:
        if not _MONTH.fullmatch(month):
            raise ValueError(f"not a YYYY-MM month: {month!r}")
    return wanted


def month_start(month: str) -> dt.date:
    year, number = month.split("-")
    return dt.date(int(year), int(number), 1)


def month_end(month: str) -> dt.date:
    """First day after the month."""
    return (month_start(month) + dt.timedelta(days=31)).replace(day=1)


def previous_month(today: dt.date) -> str:
    return f"{today.replace(day=1) - dt.timedelta(days=1):%Y-%m}"


def month_span(first: str, last: str) -> list[str]:
    """Every month from ``first`` to ``last``, both included."""
    months, day = [], month_start(first)
    while day <= month_start(last):
        months.append(f"{day:%Y-%m}")
        day = month_end(months[-1])
    return months


def at(when: dt.datetime) -> Column:
    """A time as recorded; unlike ``lit`` of a datetime it passes through no zone."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def month_text(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")


def month_date(when: Column) -> Column:
    return F.trunc(when, "MM")


def same_month(when: Column, month: Column) -> Column:
    """Whether a date or time lies in the month a ``YYYY-MM`` column names.

    Compares numbers, which is several times cheaper than formatting every date.
    """
    number = F.replace(month, F.lit("-")).try_cast("int")
    return F.year(when) * 100 + F.month(when) == number


def within_months(when: Column, months: Months) -> Column:
    """True where a date or timestamp lies in one of the months.

    The outer bounds are plain comparisons, which reach the Parquet scan;
    formatting the column as text would not.
    """
    wanted = month_list(months)
    if wanted is None:
        return when.isNotNull()
    if not wanted:
        return F.lit(False)
    bounds = (when >= F.lit(month_start(wanted[0]))) & (when < F.lit(month_end(wanted[-1])))
    if wanted == month_span(wanted[0], wanted[-1]):
        return bounds
    return bounds & month_text(when).isin(wanted)


def in_months(month: Column, months: Months) -> Column:
    """True where a ``YYYY-MM`` text column names one of the months."""
    wanted = month_list(months)
    return F.lit(True) if wanted is None else month.isin(wanted)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, cut off toward zero."""
    return F.timestamp_diff("MINUTE", start, end)


def day_name(day_of_week: Column) -> Column:
    label = F.lit(None).cast("string")
    for number, name in DAY_NAMES.items():
        label = F.when(day_of_week == number, name).otherwise(label)
    return label


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(1, 7), "Weekend").otherwise("Weekday")


def time_of_day_segment(hour: Column) -> Column:
    label = F.lit("Off-Peak")
    for name, hours in DAY_PARTS.items():
        label = F.when(hour.isin(*hours), name).otherwise(label)
    return label
