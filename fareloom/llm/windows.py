"""Concatenate-and-cut packing: all documents in a row, cut into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import written
from fareloom.llm.packing import groups, load

#: Tokens of a sequence, and the id that ends every document.
CAPACITY = 4096
END_ID = 2
#: Partition totals are added up in blocks of this many.
BLOCK = 4096
#: Partitions whose starts (16 bytes each) are sent to all executors; with more the join shuffles.
MOST_BROADCAST = 1_000_000

ENCODED = "doc_id long, part long, at long, tokens long, ids binary, width int"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Ids of every document, and its place in the partition it was read in.

    Ids take two bytes each where the vocabulary allows it.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            ids = [
                np.frombuffer(found, "<u4").astype(f"<u{width}").tobytes() + end
                for group in groups(texts)
                for found in encoder.encode(group)
            ]
            tokens = np.array([len(x) // width for x in ids], np.int64)
            ends = at + np.cumsum(tokens)
            rows = len(ids)
            yield pa.record_batch(
                [batch.column(0), pa.array(np.full(rows, part, np.int64)), pa.array(ends - tokens),
                 pa.array(tokens), pa.array(ids, pa.binary()), pa.array(np.full(rows, width, np.int32))],
                names=["doc_id", "part", "at", "tokens", "ids", "width"],
            )
            at = int(ends[-1]) if rows else at

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, ENCODED)


def partition_starts(rows: DataFrame) -> DataFrame:
    """Global place of the first token of every partition: ``part, part_start``.

    The totals are added up within blocks of partitions and then over the blocks, so
    that no window holds more than ``BLOCK`` totals or one number a block.
    """
    totals = rows.groupBy("part").agg(F.sum("tokens").alias("total"))
    totals = totals.withColumn("block", F.floor(F.col("part") / BLOCK))
    before = (Window.unboundedPreceding, -1)
    inner = Window.partitionBy("block").orderBy("part").rowsBetween(*before)
    outer = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(*before)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("block_total"))
    blocks = blocks.select("block", F.coalesce(F.sum("block_total").over(outer), F.lit(0)).alias("block_start"))
    within = totals.select("block", "part", F.coalesce(F.sum("total").over(inner), F.lit(0)).alias("within"))
    return within.join(blocks, "block").select("part", (F.col("block_start") + F.col("within")).alias("part_start"))


def window_ends(total: int, capacity: int = CAPACITY) -> np.ndarray:
    """Where the sequences after the last full window end.

    What is left over is cut at falling powers of two. A sequence of such a length
    needs no padding, so there is none at all; they are at most as many as the
    capacity has binary digits.
    """
    at, left = total // capacity * capacity, total % capacity
    ends = []
    while left:
        some = 1 << (left.bit_length() - 1)
        at, left = at + some, left - some
        ends.append(at)
    return np.array(ends, np.int64)


def cut(batch: dict[str, list], full: int, ends: np.ndarray, capacity: int) -> list[tuple]:
    """Pieces of documents: one in each sequence that a document reaches into."""
    rows = []
    columns = (batch[c] for c in ("doc_id", "first", "tokens", "ids", "width"))
    for doc_id, first, tokens, ids, width in zip(*columns, strict=True):
        content = np.frombuffer(ids, f"<u{width}").astype("<u4")
        start = 0
        while start < tokens:
            place = first + start
            if place < full:
                sequence, offset = divmod(place, capacity)
                length = capacity - offset
            else:
                k = int(np.searchsorted(ends, place, "right"))
                opened = int(ends[k - 1]) if k else full
                sequence, offset = full // capacity + k, place - opened
                length = int(ends[k]) - place
            length = min(length, tokens - start)
            crc = zlib.crc32(content[start : start + length].tobytes())
            rows.append((doc_id, start, length, crc, tokens, sequence, offset))
            start += length
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of the documents, laid end to end and cut into windows of ``capacity``.

    The first pass encodes every document once and writes its ids with the number of
    tokens before it in its partition. Prefix sums over the totals of the partitions
    give each one's place in the whole, and the second pass cuts: a document that
    crosses ends of windows becomes several pieces. Only what is left after the last
    full window makes shorter sequences (``window_ends``). Documents follow each other
    as they were written, so a task that runs again cuts the same pieces.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Ids
    are those of the tokenizer without special tokens, then ``end_id``: NULL and empty
    texts are one token. Repeated rows and rows without id are packed one by one; an
    empty table gives no rows; other columns are ignored.
    """
    found = written(encoded(docs, tokenizer, end_id), "encoded")
    starts = written(partition_starts(found), "starts")
    summed = found.agg(F.sum("tokens").alias("total"), F.count_distinct("part").alias("parts")).first()
    total = summed["total"] or 0
    full, ends = total // capacity * capacity, window_ends(total, capacity)
    near = F.broadcast(starts) if summed["parts"] <= MOST_BROADCAST else starts
    placed = found.join(near, "part").select(
        "doc_id", (F.col("part_start") + F.col("at")).alias("first"), "tokens", "ids", "width"
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [column.split()[0] for column in PIECES.split(", ")]
        for batch in batches:
            rows = cut(batch.to_pydict(), full, ends, capacity)
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.record_batch(
                [pa.array(list(c), pa.int64()) for c in columns], names=names
            )

    return placed.mapInArrow(pieces, PIECES)
