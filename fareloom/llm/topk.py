"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import written

SCALE = 1024
#: Vectors of a block, and of a group of blocks that a task searches at once.
BLOCK, GROUP = 64, 4096
#: The order of the vectors is fitted on this many of them at most.
SAMPLE, CENTRES = 8192, 64

FOUND = "query_id long, vec_id long, score long"


def searchable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``: components as floor(1024 x); unusable vectors are left out."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return vectors.where(usable & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(table: pa.Table, d: int) -> np.ndarray:
    flat = table.column("v").combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(flat.chunks).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _centres(rows: DataFrame, n_rows: int, d: int) -> np.ndarray:
    """Centres of a bounded sample (chosen by hash), after a few rounds of k-means."""
    share = min(1.0, SAMPLE / max(1, n_rows))
    steps = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) / 1e6
    sample = _matrix(rows.where(steps < share).limit(2 * SAMPLE).select("v").toArrow(), d).astype(np.float64)
    if not len(sample):
        return np.zeros((1, d))
    centres = sample[:: max(1, len(sample) // CENTRES)][:CENTRES]
    for _ in range(5):
        near = np.argmax(sample @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
        centres = np.array([sample[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


def block_bounds(query: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Most that a query can score in each block: term by term its largest product."""
    return high @ np.maximum(query, 0) + low @ np.minimum(query, 0)


def search_blocks(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """Best ``k`` of each query among the vectors, which are in the order of the blocks.

    Blocks are taken by falling bound, and scored through their vectors until a
    bound is below the k-th score so far, or below the query's floor.
    """
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    found = []
    for query, query_id, least in zip(queries, query_ids, floors, strict=True):
        bounds = block_bounds(query, high, low)
        scores, names = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] < least or (len(scores) == k and bounds[b] < scores[-1]):
                break
            at = slice(starts[b], starts[b] + BLOCK)
            new, own = vectors[at] @ query, ids[at]
            scores, names = np.append(scores, new[own != query_id]), np.append(names, own[own != query_id])
            best = np.lexsort((names, -scores))[:k]
            scores, names = scores[best], names[best]
        found += [(int(query_id), int(n), int(s)) for n, s in zip(names, scores, strict=True) if s >= least]
    return found


def _found(rows: list[tuple[int, int, int]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best vectors of other ids per query.

    Vectors are put in the order of their nearest of a few centres and cut into
    blocks of neighbouring rows. A first pass searches one group of blocks of the
    query's own centre; its k-th score is a floor for the second, which searches
    all groups. The result is exact whatever the order. Ties go to smaller ids.

    Vectors that are NULL or hold NULL or non-finite components take no part;
    shorter ones are filled with zeros. Repeated rows are candidates of their own;
    of query rows with one id the one with the smallest vector asks. Empty tables
    give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = searchable(vectors, key, vector)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    d = size["d"] or 1
    padded = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("v"))))
    centres = _centres(padded, size["n"], d)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(pa.Table.from_batches([batch]), d).astype(np.float64)
            near = np.argmax(matrix @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
            yield pa.record_batch([*batch.columns, pa.array(near.astype(np.int32))], names=["vec_id", "v", "centre"])

    placed = written(padded.mapInArrow(assign, "vec_id long, v array<long>, centre int"), "vectors")
    sizes = {r["centre"]: r["count"] for r in placed.groupBy("centre").count().collect()}
    parts = {c: math.ceil(n / GROUP) for c, n in sizes.items()}
    groups = [(c, p) for c in sorted(parts) for p in range(parts[c])]
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_parts = F.element_at(F.create_map(*[F.lit(x) for c, n in parts.items() for x in (c, n)]), F.col("centre"))
    index = placed.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), n_parts).cast("int"))
    asking = placed.withColumnRenamed("vec_id", key).where(is_query).groupBy(F.col(key).alias("query_id")).agg(
        F.min_by(F.struct("v", "centre"), "v").alias("q")
    ).select("query_id", F.col("q.v").alias("v"), F.col("q.centre").alias("centre"))

    def search(asked: pa.Table, table: pa.Table) -> pa.Table:
        if not asked.num_rows or not table.num_rows:
            return _found([])
        matrix, ids = _matrix(table, d), table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        floors = (
            asked.column("floor").to_numpy()
            if "floor" in asked.column_names
            else np.full(asked.num_rows, np.iinfo(np.int64).min)
        )
        return _found(
            search_blocks(_matrix(asked, d), asked.column("query_id").to_numpy(), floors, matrix[order], ids[order], k)
        )

    # First pass: one group of the query's own centre.
    first = (
        asking.withColumn("part", F.lit(0))
        .groupBy("centre", "part")
        .cogroup(index.where(F.col("part") == 0).groupBy("centre", "part"))
        .applyInArrow(search, FOUND)
    )
    floors = _ranked(first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    least = F.lit(-(2**63)).cast("long")
    ready = asking.join(floors, "query_id", "left").select("query_id", "v", F.coalesce("floor", least).alias("floor"))
    # Second pass: every query against every group of blocks, in blocks.
    everywhere = F.explode(F.array(*[F.struct(F.lit(c).alias("centre"), F.lit(p).alias("part")) for c, p in groups]))
    sent = ready.withColumn("g", everywhere).select("query_id", "v", "floor", "g.centre", "g.part")
    found = (
        sent.groupBy("centre", "part").cogroup(index.groupBy("centre", "part")).applyInArrow(search, FOUND)
    )
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
