"""Insert-only upsert of staged rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom import schemas
from fareloom.functions.months import Months, at, in_months
from fareloom.operators.trips import latest_per_key


def merge_insert_new_trips(
    staging: DataFrame, target: DataFrame, months: Months = None, null_safe: bool = False
) -> DataFrame:
    """The staged rows to append: newest per trip key, keys the target lacks.

    A key with a missing part matches nothing and is inserted by every run, as a
    plain equality has it; ``null_safe`` lets it match, so a rerun inserts nothing.

    Both sides are reduced to one row per key within each task before they are
    shuffled, and the join works on the shuffles of those two reductions. Of the
    target only the key columns are read, and only row groups whose pickup times
    overlap the staged ones; the first and last of those are looked up beforehand.
    """
    key = schemas.TRIP_KEY
    staged = staging.where(in_months(F.col("_execution_date"), months))
    newest = latest_per_key(staged, key)
    known = target.select(*key)
    if null_safe:
        known = known.distinct()
        matched = reduce(and_, [newest[name].eqNullSafe(known[name]) for name in key])
        return newest.join(known, matched, "left_anti")

    pickup = F.col("tpep_pickup_datetime")
    first, last = staged.agg(F.min(pickup), F.max(pickup)).first()
    if first is None:
        return newest
    known = known.dropna().where(pickup.between(at(first), at(last))).distinct()
    return newest.join(known, list(key), "left_anti").select(*newest.columns)
