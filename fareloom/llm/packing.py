"""Best-fit packing of tokenized documents into sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import held, numbered, shuffle_partitions, written

#: Tokens of a sequence, and the id that ends every document.
CAPACITY = 4096
END_ID = 1
#: Chunks whose ids a worker remembers, and characters it encodes at once.
REMEMBERED = 1_000_000
GROUP_CHARS = 2_000_000
#: Points after a plain letter. A token ends before them in any case, so a blank
#: put there changes no id, and words with and without points share a chunk.
_POINTS = re.compile(r"[.,;:!?%&](?<=[A-Za-z][.,;:!?%&])")
#: Chunks that are one word to the tokenizer, and how the last token of a word ends.
_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
WORD_END = "</w>"
#: Words the tokenizer gets as one text.
JOINED_WORDS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of texts as bytes, by chunks between blanks, which no token crosses."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory: dict[str, bytes] = {"": b""}
        self.ends = word_ends(self.tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_POINTS.sub(r" \g<0>", t).replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        memory = self.memory
        if len(memory) > REMEMBERED:
            memory.clear()
            memory[""] = b""
        new = set().union(*split).difference(memory)
        if self.ends is not None:
            new = self._learn_words(new)
        self._learn(list(new))
        return [b"".join(map(memory.__getitem__, chunks)) for chunks in split]

    def _learn(self, chunks: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        for chunk, one in zip(chunks, found, strict=True):
            self.memory[chunk] = np.array(one.ids, "<u4").tobytes()

    def _learn_words(self, chunks: set[str]) -> set[str]:
        """Learn the chunks that are words, many at a call; the others are returned.

        Case does not matter to the ids, and words that stand between blanks are
        told apart in the ids of the whole by the tokens that end a word.
        """
        memory = self.memory
        lower = {chunk: chunk.lower() for chunk in chunks if _WORD.fullmatch(chunk)}
        words = list(set(lower.values()).difference(memory))
        parts = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        joined = self.tokenizer.encode_batch_fast([" ".join(part) for part in parts], add_special_tokens=False)
        for part, one in zip(parts, joined, strict=True):
            ids = np.array(one.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                self._learn(part)
                continue
            packed, at = ids.tobytes(), 0
            for word, stop in zip(part, (4 * stops).tolist(), strict=True):
                memory[word] = packed[at:stop]
                at = stop
        for chunk, word in lower.items():
            memory[chunk] = memory[word]
        return chunks.difference(lower)


def word_ends(tokenizer) -> np.ndarray | None:  # noqa: ANN001
    """Which ids end a word, if the tokenizer is one that lowers case and marks ends of words."""
    told = json.loads(tokenizer.to_str())
    steps = (told.get("normalizer") or {}).get("normalizers", [])
    lowers = any(step["type"] == "Lowercase" for step in steps)
    if not lowers or told["model"].get("end_of_word_suffix") != WORD_END:
        return None
    vocab = tokenizer.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
    return ends


def groups(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in groups of some ``GROUP_CHARS`` characters."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held > GROUP_CHARS:
            yield group
            group, held = [], 0
    yield group


def load(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents' ids: ``doc_id, piece, start, length, ids_crc32``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            encoded = (ids for group in groups(texts) for ids in encoder.encode(group))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.record_batch(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Places of pieces: rows of length, first rank, number, first sequence, offset.

    Pieces of one length are alike, so they are placed in bulk: the ranks from the
    first on take one place each in as many sequences, from the first on. Lengths
    are swept from the longest down. Those of one length go to their successors
    among the gaps, the smallest gaps that hold them, in order of rank; a gap takes
    as many as fit and what is left of it waits for the sweep to come down to it.
    What finds no gap opens sequences. The number of rows follows the number of
    lengths, not of pieces.
    """
    waiting: dict[int, list[tuple[int, int]]] = {}
    open_gaps: list[tuple[int, int, int]] = []  # gap, first sequence, number; smallest gap last
    places: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for size in range(capacity, 0, -1):
        for first, number in waiting.pop(size, ()):
            open_gaps.append((size, first, number))
        left, rank = counts.get(size, 0), 0

        def fill(gap: int, first: int, number: int) -> None:
            """Put pieces into sequences of one gap; keep what remains of them."""
            nonlocal left, rank
            each = gap // size
            full = min(number, left // each)
            groups = [(first, full, each)] if full else []
            if full < number and (some := left - full * each):
                groups.append((first + full, 1, some))
            used = 0
            for at, many, fit in groups:
                for k in range(fit):
                    places.append((size, rank, many, at, capacity - gap + k * size))
                    rank += many
                left -= many * fit
                used += many
                remains = gap - fit * size
                if remains >= size:
                    open_gaps.append((remains, at, many))
                elif remains:
                    waiting.setdefault(remains, []).append((at, many))
            if used < number:
                open_gaps.append((gap, first + used, number - used))
                open_gaps.sort(reverse=True)

        while left and open_gaps:
            fill(*open_gaps.pop())
        while left:
            each = capacity // size
            number = -(-left // each)
            first, sequences = sequences, sequences + number
            fill(capacity, first, number)
    return np.array(places, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, packed by best fit.

    Ids are those of the tokenizer without special tokens, then ``END_ID``. Only
    documents over the capacity are cut. Pieces are ranked within their length in
    Spark, in slices, so any length may hold most of them; the sweep needs their
    number per length, ``capacity`` numbers at most, and its places are applied to
    the rows in Spark. NULL and empty texts are pieces of the end alone; repeated
    rows are packed one by one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    found = written(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = best_fit(counts, capacity)
    # Places are in order of rank within a length.
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    shared = spark.sparkContext.broadcast((places[:, 0] << 44 | places[:, 1], places))
    slices = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shuffle_partitions(spark)))
    ranked = numbered(found, ["length"], slices, ["doc_id", "piece", "ids_crc32"], "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = shared.value
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(keys, lengths << 44 | ranks, "right") - 1
            added = table[at, 3] + ranks - table[at, 1]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(added), pa.array(table[at, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
