"""Sharding by rendezvous hashing over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import numbered

#: Slices a shard's rows are numbered in; a slice is the work of one task.
SLICES = 1024

#: Hash values are 13 hex digits, which a double holds exactly.
HASH_STEPS = float(16**13)


def _uniform(text: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the text alone."""
    digits = F.substring(F.md5(text), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(HASH_STEPS)


def costs(key: Column, weights: list[float]) -> Column:
    """Array of (cost, shard): the row goes to the shard of least cost.

    The cost of a shard depends on the key, the shard's number and its weight, so
    a further shard changes nothing among the ones before it, and shares of the
    keys are proportional to the weights. A NULL key counts as a key of its own.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    each = F.array(*[F.lit(float(w)) for w in weights])
    return F.transform(
        each,
        lambda weight, i: F.struct(
            (-F.ln(_uniform(F.concat(text, F.lit("/"), i.cast("string")))) / weight).alias("cost"),
            i.alias("shard"),
        ),
    )


def assign_shards(
    docs: DataFrame,
    weights: list[float],
    grown_weights: list[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Shard and gapless place in the shard of every row.

    Returns the key, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``,
    ``shard``, ``slot`` (from 0 in each shard) and ``grown_shard``: the shard
    under ``grown_weights``, which start with ``weights``. A NULL text has no
    bytes. Repeated rows stay rows of their own in one shard; an empty table
    gives no rows; other columns are ignored.
    """
    more = list(grown_weights or weights)
    if more[: len(weights)] != list(weights):
        raise ValueError("grown weights must start with the present ones")
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        costs(F.col(key), more).alias("_costs"),
    )
    placed = rows.select(
        key,
        "size",
        "text_crc32",
        F.array_min(F.slice("_costs", 1, len(weights)))["shard"].alias("shard"),
        F.array_min("_costs")["shard"].alias("grown_shard"),
    )
    row = F.concat_ws("/", F.col(key).cast("string"), F.col("size"), F.col("text_crc32"))
    slices = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long") % SLICES
    return numbered(placed, ["shard"], slices, [key, "size", "text_crc32"], "slot")
