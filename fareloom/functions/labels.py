"""Code tables and the labels made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes.
PAYMENT_TYPES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}

# Rate codes.
RATE_CODES = {
    1: "Standard Rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
}

# Borough groups.
BOROUGH_GROUPS = {
    "Manhattan": "Core Manhattan",
    "Brooklyn": "Outer Borough",
    "Queens": "Outer Borough",
    "Bronx": "Outer Borough",
    "Staten Island": "Outer Borough",
    "EWR": "Airport",
}

# Zones that are airports, and the range of valid zones.
AIRPORT_ZONES = (132, 138, 1)
FIRST_ZONE, LAST_ZONE = 1, 265


def lookup(code: Column, table: dict, otherwise: str) -> Column:
    label = F.lit(otherwise)
    for key, name in table.items():
        label = F.when(code == key, name).otherwise(label)
    return label


def payment_label(code: Column) -> Column:
    return lookup(code, PAYMENT_TYPES, "Unknown")


def payment_label_lite(code: Column) -> Column:
    """Code 5 is Unknown here; anything else, NULL included, is Other."""
    return lookup(code, {**PAYMENT_TYPES, 5: "Unknown"}, "Other")


def rate_label(code: Column) -> Column:
    """A missing code counts as the standard rate."""
    return lookup(F.coalesce(F.round(code).cast("long"), F.lit(1)), RATE_CODES, "Unknown")


def borough_group(borough: Column) -> Column:
    return lookup(borough, BOROUGH_GROUPS, "Unknown")


def is_airport(zone: Column) -> Column:
    return zone.isin(*AIRPORT_ZONES)


def valid_zone(zone: Column) -> Column:
    return zone.between(FIRST_ZONE, LAST_ZONE)
