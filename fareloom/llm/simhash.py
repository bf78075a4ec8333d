"""Near duplicates by SimHash fingerprints and meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import shuffle_partitions, written

BITS = 64
#: Words of a shingle, and most differing bits of linked fingerprints.
SHINGLE, RADIUS = 3, 2
#: Distinct fingerprints whose variants one task emits.
EMITTED = 200_000
#: Words that are hashed and counted at once.
BLOCK = 200_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text: a bit is set if it is in over half the shingles' hashes."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        found = [b" ".join(found)]
    else:
        found = [b" ".join(found[i : i + shingle]) for i in range(len(found) - shingle + 1)]
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(found), BLOCK):
        part = found[start : start + BLOCK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp``: the 64-bit fingerprint of every row, as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], names=[key, "fp"])

    frame = docs.select(key, text)
    return frame.mapInArrow(compute, f"`{key}` {frame.schema[key].dataType.simpleString()}, fp long")


def ball_links(distinct: DataFrame) -> DataFrame:
    """Links (``a`` < ``b``) that connect all fingerprints at most two bits apart.

    Every fingerprint emits itself and its variants with one of its bits
    changed: two fingerprints at most two bits apart meet on a variant. A variant
    gathers 65 fingerprints at most, all within two bits of each other, so the links
    of each to the least one connect them; the distance of each link is verified.
    The input must not repeat fingerprints.
    """
    masks = [0] + [(1 << b) - (1 << 64 if b == 63 else 0) for b in range(BITS)]
    listed = F.array(*[F.lit(mask).cast("long") for mask in masks])
    variants = F.transform(listed, lambda mask: F.col("fp").bitwiseXOR(mask))
    # What travels is the variant and the place of its mask, which give the fingerprint.
    met = (
        distinct.select(F.posexplode(variants).alias("at", "variant"))
        .groupBy("variant")
        .agg(F.collect_list(F.col("at").cast("byte")).alias("ats"))
        .where(F.size("ats") > 1)
        .withColumn("fps", F.transform("ats", lambda at: F.col("variant").bitwiseXOR(F.get(listed, at.cast("int")))))
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    return met.where((F.col("a") != F.col("b")) & near).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``: the least node of the component of every linked node.

    Large-star and small-star rounds in turn: a node's neighbours are linked to
    its least neighbour. All steps are groupings and joins; a node with very many
    links is pre-aggregated, and its joins are split by AQE. Each round is written
    to the shared folder. Stops when the links no longer change.
    """
    edges = written(links.select("a", "b"), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        ).distinct()
        down = large.where(F.col("a") != F.col("b"))
        # Small-star: each node and its smaller neighbours go to the least of them.
        lower = down.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = down.join(lower.withColumnRenamed("u", "b"), "b").select(
            F.col("m").alias("_m"), F.col("a").alias("_a"), "b"
        )
        stars = (
            small.select(F.col("_m").alias("a"), "b")
            .unionByName(small.select(F.col("_m").alias("a"), F.col("_a").alias("b")))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = written(stars, "links")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (hex) and ``component_id``, the least key reachable.

    Works on distinct fingerprints: copies share one, so a group of copies of any
    size is one node. NULL, empty and blank texts have fingerprint zero and are
    linked like any others; repeated rows stay, each with its component; an empty
    table gives no rows and other columns are ignored. A NULL key is no least one:
    it has the component of its texts, NULL where no row with a key is reachable.
    """
    marked = written(fingerprints(docs, shingle, key, text), "fingerprints")
    smallest = written(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    # 65 variants follow from each row, so their tasks are sized by rows and not by bytes.
    tasks = max(shuffle_partitions(docs.sparkSession), smallest.count() // EMITTED + 1)
    roots = components(ball_links(smallest.select("fp").repartition(tasks, "fp")))
    classes = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = written(classes.join(named, "root").select("fp", "component_id"), "classes")
    return marked.join(of_fp, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
