"""Substring dedup: repeated windows of words become maximal removal intervals."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import release, shuffle_partitions

#: Consecutive words of a window.
WINDOW = 13
#: Multiplier of the Rabin-Karp hash, modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes of a chunk of documents, whose windows a task holds at once.
CHUNK_BYTES = 16_000_000
LAST_ID = (1 << 63) - 1


def window_hashes(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hash of the window that starts at each place of an array of word hashes."""
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, window):
        out *= BASE
        out += words[j : n + j]
    return out


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _word_hashes(text: str | None) -> np.ndarray:
    found = _split(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


class Chunk:
    """Documents of a range of ids, in order, with the windows they hold."""

    def __init__(self, ids: np.ndarray, texts: list[str | None], window: int) -> None:
        # Words are hashed text by text, so that never all of them are held.
        hashed = [_word_hashes(text) for text in texts]
        sizes = np.array([len(h) for h in hashed], np.int64)
        self.ends = np.cumsum(sizes)
        found = window_hashes(np.concatenate([*hashed, np.empty(0, np.uint64)]), window)
        del hashed
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[: len(found)]
        inside = np.arange(len(found)) + window <= self.ends[doc] if len(found) else np.empty(0, bool)
        self.window = window
        self.places = np.flatnonzero(inside)
        doc = doc[inside]
        self.unique, first, self.which = np.unique(found[inside], return_index=True, return_inverse=True)
        owner = ids[doc]
        # Windows are in order of ids, so the first place has the smallest one.
        self.repeated = owner > owner[first][self.which] if len(owner) else np.empty(0, bool)

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """Flag per word of the chunk; ``earlier`` flags unique windows of earlier chunks."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        starts = self.places[self.repeated | earlier[self.which]]
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + self.window, -1)
        return np.cumsum(change[:total]) > 0


def intervals(flags: np.ndarray) -> list[dict]:
    """Maximal runs of set flags, as words ``start`` to ``end`` (exclusive)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)]


def _in_order(table: pa.Table, key: str, text: str) -> tuple[pa.Table, np.ndarray, list]:
    ids = np.array([LAST_ID if i is None else i for i in table.column(key).to_pylist()], np.int64)
    order = np.argsort(ids, kind="stable")
    table = table.take(pa.array(order))
    return table, ids[order], table.column(text).to_pylist()


def bounds(docs: DataFrame, key: str, text: str) -> list[int]:
    """Ids that cut the documents into chunks of about equal numbers, in order.

    There are enough chunks for each to hold ``CHUNK_BYTES`` of text, and for each
    shuffle partition to get several.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    n = max(math.ceil(total / CHUNK_BYTES), 2 * shuffle_partitions(spark))
    cuts = docs.agg(
        F.percentile_approx(F.col(key).cast("long"), [i / n for i in range(1, n)], 20 * n).alias("cuts")
    ).first()["cuts"]
    return sorted(set(cuts or []))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows with ``n_words``, ``n_removed``, ``removed`` and ``kept_text``.

    A word goes if a window that covers it also starts in a document with a
    smaller id. Documents are dealt into chunks by ranges of their ids, so that
    the order of chunks is the order of documents. A chunk hands on the hash of
    each window it holds once, however often, packed by hash bucket; the bucket
    tells each chunk which of its windows an earlier chunk has, as one bit each;
    and the chunk turns these and its own repeats into intervals. ``removed`` are
    the intervals as word positions, ``kept_text`` the kept words joined by one
    blank.

    Windows are told apart by a 64-bit hash. Words are runs without ASCII blanks,
    NULL texts have none, texts shorter than a window lose nothing. Rows with one
    id remove nothing from each other; NULL ids come last. Empty tables give no
    rows; other columns are kept, but for those with the names of the new ones.
    """
    new = ("n_words", "n_removed", "removed", "kept_text")
    kept = docs.select(*[c for c in docs.columns if c not in new and c not in ("_chunk", "_bucket")])
    cuts = np.array(bounds(kept, key, text), np.int64)
    n_buckets = np.uint64(len(cuts) + 1)

    @F.pandas_udf("int")
    def chunk_of(ids):  # noqa: ANN001, ANN202
        filled = ids.astype("object").where(ids.notna(), LAST_ID).astype("int64")
        return filled.map(lambda x: int(np.searchsorted(cuts, x, "left"))).astype("int32")

    dealt = kept.withColumn("_chunk", chunk_of(F.col(key).cast("long")))

    def emit(table: pa.Table) -> pa.Table:
        release()
        chunk_id = table.column("_chunk")[0].as_py()
        _, ids, texts = _in_order(table, key, text)
        unique = Chunk(ids, texts, window).unique
        bucket = ((unique >> np.uint64(32)) * n_buckets) >> np.uint64(32)
        buckets, starts = np.unique(bucket, return_index=True)
        ends = np.append(starts, len(unique))[1:]
        packed = [unique[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        return pa.table(
            {
                "_bucket": pa.array(buckets.astype(np.int32)),
                "_chunk": pa.array([chunk_id] * len(packed), pa.int32()),
                "hashes": pa.array(packed, pa.binary()),
            }
        )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("_chunk")
        parts = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        joined = np.concatenate(parts)
        order = np.argsort(joined, kind="stable")
        ordered = joined[order]
        earlier = np.zeros(len(joined), bool)
        earlier[order[1:][ordered[1:] == ordered[:-1]]] = True
        cut = np.cumsum([len(p) for p in parts])[:-1]
        return pa.table(
            {
                "_chunk": table.column("_chunk"),
                "_bucket": table.column("_bucket"),
                "n": pa.array([len(p) for p in parts], pa.int64()),
                "earlier": pa.array([np.packbits(x).tobytes() for x in np.split(earlier, cut)], pa.binary()),
            }
        )

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        release()
        table, ids, texts = _in_order(table, key, text)
        chunk = Chunk(ids, texts, window)
        told = told.sort_by("_bucket")
        bits = [
            np.unpackbits(np.frombuffer(b, np.uint8), count=n)
            for b, n in zip(told.column("earlier").to_pylist(), told.column("n").to_pylist(), strict=True)
        ]
        earlier = np.concatenate(bits).astype(bool) if bits else np.empty(0, bool)
        if len(earlier) != len(chunk.unique):
            raise RuntimeError("the documents of a chunk changed between two reads")
        flags = np.split(chunk.removed(earlier), chunk.ends[:-1]) if len(ids) else []
        spans, texts_left = [], []
        for content, flag in zip(texts, flags, strict=True):
            found = _split(content)
            spans.append(intervals(flag) if flag.any() else [])
            left = [w for w, f in zip(found, flag.tolist(), strict=True) if not f] if spans[-1] else found
            texts_left.append(b" ".join(left).decode())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        added = {
            "n_words": pa.array([len(f) for f in flags], pa.int64()),
            "n_removed": pa.array([int(f.sum()) for f in flags], pa.int64()),
            "removed": pa.array(spans, kind),
            "kept_text": pa.array(texts_left, pa.string()),
        }
        table = table.drop_columns(["_chunk"])
        for name, column in added.items():
            table = table.append_column(name, column)
        return table

    told = (
        dealt.groupBy("_chunk")
        .applyInArrow(emit, "_bucket int, _chunk int, hashes binary")
        .groupBy("_bucket")
        .applyInArrow(compare, "_chunk int, _bucket int, n long, earlier binary")
    )
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return (
        dealt.groupBy("_chunk")
        .cogroup(told.groupBy("_chunk"))
        .applyInArrow(
            finish,
            f"{own}, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string",
        )
    )
