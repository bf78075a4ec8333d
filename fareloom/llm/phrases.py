"""Collocations: frequent phrases found by SON partitioning, scored and cleaned."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import written

#: Words of the longest phrase, least occurrences, phrases reported of a language.
LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
#: A phrase goes if a longer one has at least this percent of its occurrences.
ABSORB_PERCENT = 100
#: Shards that are mined by themselves. Each is many tasks; their number is fixed, as
#: the local support is the least count, parted among them.
SHARDS = 8

#: Characters of a chunk, and of what is split into words at once; words of a unit, which
#: is made of chunks and is what one task counts. Counts of a unit are shuffled, so larger
#: units shuffle less.
CHUNK_CHARS = 32_000_000
UNIT_WORDS = 4_000_000
SLICE_BYTES = 8_000_000
REQUEST_ROWS = 200_000
#: Rows of (language, shard) totals that are sent to all executors; more are shuffled.
MOST_BROADCAST = 500_000

UNDETERMINED = "und"
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"

CHUNKS = "chunk long, lang string, shard int, words long, ids binary, alive binary, vocab binary"
REQUESTS = "hash long, unit long, cell long, n long"
UNITS = "unit long, lang string, lang_words long, cell long, ids binary, alive binary, vocab binary"
MINED = f"{UNITS}, labels array<struct<phrase: string, n: long>>"
#: Once a table is written, the shuffles it came from are of no more use.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LABELS = pa.list_(pa.struct([("phrase", pa.string()), ("n", pa.int64())]))


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of the texts of some ``SLICE_BYTES``; a longer text is one by itself."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES)))
        yield texts.slice(first, last - first)
        first = last


def word_stream(texts: pa.Array, known: dict[str, int]) -> np.ndarray:
    """Numbers of the words in order, -1 where a piece ends; new words join ``known``."""
    # In this order: Arrow lowers wrong bytes of a slice that was cast before.
    lowered = pc.ascii_lower(texts).cast(pa.large_string())
    spaced = pc.replace_substring_regex(lowered, PIECE_ENDS, " \n ")
    spaced = pc.replace_substring(spaced, "\t", " ")
    spaced = pc.binary_join_element_wise(spaced, *(pa.scalar(x, pa.large_string()) for x in ("\n", " ")))
    found = pc.list_flatten(pc.split_pattern(spaced, " ")).dictionary_encode()
    number = {"": -2, "\n": -1}
    numbers = np.array(
        [number[w] if w in number else known.setdefault(w, len(known)) for w in found.dictionary.to_pylist()],
        np.int32,
    )
    ids = numbers[found.indices.to_numpy()]
    ids = ids[ids != -2]
    return ids[(ids >= 0) | np.append(False, ids[:-1] >= 0)]


def packed(content: bytes) -> bytes:
    """Length and compressed content."""
    return len(content).to_bytes(8, "little") + pa.compress(content, "zstd", asbytes=True)


def unpacked(content: bytes) -> bytes:
    return pa.decompress(content[8:], int.from_bytes(content[:8], "little"), "zstd", asbytes=True)


def packed_stream(ids: np.ndarray, alive: np.ndarray, vocab: list[str]) -> tuple[bytes, bytes, bytes]:
    """What a chunk keeps: its stream, where phrases start, and its words."""
    content = (ids.astype(np.int32).tobytes(), np.packbits(alive).tobytes(), " ".join(vocab).encode())
    return tuple(map(packed, content))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes the shuffle files of every query that has ended."""
    before = spark.conf.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def chunked(docs: DataFrame) -> DataFrame:
    """Word streams of the texts in chunks of one language each.

    A chunk belongs to the shard of the partition it was read in.
    """

    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        known: dict[str, dict[str, int]] = {}
        streams: dict[str, list[np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            nonlocal made
            rows = []
            for lang, parts in streams.items():
                ids = np.concatenate(parts)
                alive = ids >= 0
                stream = packed_stream(ids, alive, list(known[lang]))
                rows.append((part << 24 | made, lang, part % SHARDS, int(alive.sum()), *stream))
                made += 1
            known.clear()
            streams.clear()
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 3)
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            names = [column.split()[0] for column in CHUNKS.split(", ")]
            return pa.record_batch(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
            )

        held = 0
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for lang in pc.unique(langs).to_pylist():
                own = texts.filter(pc.equal(langs, lang))
                for some in slices(own):
                    vocab = known.setdefault(lang, {})
                    streams.setdefault(lang, []).append(word_stream(some, vocab))
                    held += pc.sum(pc.binary_length(some)).as_py()
                    if held >= CHUNK_CHARS:
                        yield flush()
                        held = 0
        yield flush()

    lang = F.coalesce(F.col("lang"), F.lit(UNDETERMINED))
    return docs.select(lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(chunk_rows, CHUNKS)


def with_support(chunks: DataFrame, least_count: int) -> DataFrame:
    """Add the words of the language and ``cell``: the shard and its local support.

    The local support is the least count times the shard's part of the language's
    words, rounded up. The parts add up to one, so a phrase that misses it in every
    shard misses the least count as a whole: no frequent phrase is lost.
    """
    totals = written(chunks.groupBy("lang", "shard").agg(F.sum("words").alias("shard_words")), "shards")
    langs = totals.groupBy("lang").agg(F.sum("shard_words").alias("lang_words"))
    support = F.expr(f"greatest(1, ({least_count} * shard_words + lang_words - 1) div lang_words)")
    known = totals.where("shard_words > 0").join(langs, "lang").select(
        "lang", "shard", "lang_words", (F.shiftleft(F.col("shard").cast("long"), 32) + support).alias("cell")
    )
    if totals.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    return chunks.join(known, ["lang", "shard"]).drop("shard")


def grams(ids: np.ndarray, hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on; places without a word count as any."""
    word = hashes[np.maximum(ids, 0)] if len(hashes) else np.zeros(len(ids), np.uint64)
    found = word
    for j in range(1, k):
        found = found[: len(word) - j] * np.uint64(0x9E3779B97F4A7C15) + word[j:]
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(32)
    return found


class Stream:
    """A unit's words, and where phrases start that all shards' union holds."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(unpacked(row["ids"]), np.int32)
        starts = np.frombuffer(unpacked(row["alive"]), np.uint8)
        self.alive = np.unpackbits(starts, count=len(self.ids)).astype(bool)
        text = unpacked(row["vocab"])
        self.vocab = text.decode().split(" ") if text else []
        self.lang = row["lang"]

    @cached_property
    def hashes(self) -> np.ndarray:
        prefix = self.lang.encode() + b"\0"
        return np.array([xxhash.xxh64_intdigest(prefix + w.encode()) for w in self.vocab], np.uint64)

    def candidates(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of phrases of ``k`` words whose two shorter ones are held."""
        starts = self.alive if k == 1 else self.alive[:-1] & self.alive[1:]
        at = np.flatnonzero(starts[: max(len(self.ids) - k + 1, 0)])
        return at, grams(self.ids, self.hashes, k)[at] if len(at) else np.zeros(0, np.uint64)


def units(chunks: DataFrame) -> DataFrame:
    """Chunks of one language and shard put together, up to some ``UNIT_WORDS``."""
    order = Window.partitionBy("cell", "lang").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(order), F.lit(0))
    numbered = chunks.select("chunk", "lang", "cell", F.floor(before / UNIT_WORDS).alias("number"))
    # A unit is named by its first chunk.
    first = F.min("chunk").over(Window.partitionBy("cell", "lang", "number"))
    dealt = numbered.select("chunk", first.alias("unit"))
    out = pa.schema(
        [("unit", pa.int64()), ("lang", pa.string()), ("lang_words", pa.int64()), ("cell", pa.int64()),
         ("ids", pa.binary()), ("alive", pa.binary()), ("vocab", pa.binary())]
    )

    def together(table: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        streams = []
        for batch in table.sort_by("chunk").to_batches(max_chunksize=1):
            (row,) = batch.to_pylist()
            stream = Stream(row)
            numbers = np.array([known.setdefault(w, len(known)) for w in stream.vocab] + [-1], np.int32)
            streams.append(numbers[stream.ids])
        ids = np.concatenate(streams)
        row |= dict(zip(("ids", "alive", "vocab"), packed_stream(ids, ids >= 0, list(known)), strict=True))
        return pa.table([pa.array([row[f.name]], f.type) for f in out], schema=out)

    near = F.broadcast(dealt) if chunks.count() <= MOST_BROADCAST else dealt
    return chunks.drop("words").join(near, "chunk").groupBy("unit").applyInArrow(together, UNITS)


def requests(parts: DataFrame, k: int) -> DataFrame:
    """How often each unit has each of its candidates of ``k`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stream = Stream(row)
                if k == 1:
                    found, n = stream.hashes, np.bincount(stream.ids + 1, minlength=len(stream.vocab) + 1)[1:]
                else:
                    found, n = np.unique(stream.candidates(k)[1], return_counts=True)
                for i in range(0, len(found), REQUEST_ROWS):
                    some = found[i : i + REQUEST_ROWS].view(np.int64)
                    size = len(some)
                    yield pa.record_batch(
                        [pa.array(some), pa.array(np.full(size, row["unit"], np.int64)),
                         pa.array(np.full(size, row["cell"], np.int64)),
                         pa.array(n[i : i + REQUEST_ROWS].astype(np.int64))],
                        names=["hash", "unit", "cell", "n"],
                    )

    return parts.select("unit", "lang", "cell", "ids", "alive", "vocab").mapInArrow(count, REQUESTS)


def mined(asked: DataFrame) -> DataFrame:
    """Phrases that reach the local support of some shard, for each unit that has them.

    The counts of the shards tell which phrases are locally frequent; for the union of
    these they add up to the exact count of the whole, as every unit has counted them.
    Of the units that hold a phrase one is its ``home``, which will spell it.
    """
    dealt = asked.repartition("hash")
    support = F.col("cell").bitwiseAND(F.lit((1 << 32) - 1))
    shards = dealt.groupBy("hash", "cell").agg(F.sum("n").alias("n"), F.min("unit").alias("home"))
    union = (
        shards.groupBy("hash")
        .agg(F.sum("n").alias("total"), F.min("home").alias("home"), F.max(F.col("n") >= support).alias("held"))
        .where("held")
        .drop("held")
    )
    replies = dealt.join(union.hint("shuffle_hash"), "hash")
    return replies.select("unit", "hash", F.col("total").alias("n"), (F.col("home") == F.col("unit")).alias("home"))


def narrowed(parts: DataFrame, replies: DataFrame, k: int, last: bool) -> DataFrame:
    """Units cut to the phrases of ``k`` words in the union, with those to be spelled."""

    def narrow(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [field.name for field in out]
        rows = left.to_pylist()
        if not rows or not len(right):
            return pa.table([pa.array([], field.type) for field in out], schema=out)
        row = rows[0]
        held = right["hash"].to_numpy().view(np.uint64)
        order = np.argsort(held)
        held, n = held[order], right["n"].to_numpy()[order]
        home = right["home"].to_numpy(zero_copy_only=False).astype(bool)[order]
        stream = Stream(row)
        # Words are looked up once each, longer phrases at every start.
        at, found = (None, stream.hashes) if k == 1 else stream.candidates(k)
        place = np.minimum(np.searchsorted(held, found), len(held) - 1)
        same = held[place] == found
        one, first = np.unique(place[same], return_index=True)
        starts = np.flatnonzero(same) if k == 1 else at[same]
        first = [starts[i] for p, i in zip(one, first, strict=True) if home[p]]
        spelled = [[w] if k == 1 else stream.ids[w : w + k] for w in first]
        labels = [
            {"phrase": " ".join(stream.vocab[w] for w in words), "n": int(count)}
            for words, count in zip(spelled, n[one[home[one]]], strict=True)
        ]
        kept = packed_stream(stream.ids[:0], stream.alive[:0], [])
        if not last:
            if k == 1:
                covered = alive = np.append(same, False)[stream.ids]
            else:
                alive = np.zeros(len(stream.ids), bool)
                alive[starts] = True
                covered = alive.copy()
                for j in range(1, k):
                    covered[j:] |= alive[: len(alive) - j]
            more = covered | np.append(False, covered[:-1])
            ids = np.where(covered, stream.ids, -1)[more]
            used, again = np.unique(ids[ids >= 0], return_inverse=True)
            ids[ids >= 0] = again
            kept = packed_stream(ids, alive[more], [stream.vocab[w] for w in used])
        row |= dict(zip(("ids", "alive", "vocab"), kept, strict=True)) | {"labels": labels}
        return pa.table([pa.array([row[name]], field.type) for name, field in zip(names, out, strict=True)], schema=out)

    out = pa.schema(
        [("unit", pa.int64()), ("lang", pa.string()), ("lang_words", pa.int64()), ("cell", pa.int64()),
         ("ids", pa.binary()), ("alive", pa.binary()), ("vocab", pa.binary()), ("labels", LABELS)]
    )
    left = parts.select("unit", "lang", "lang_words", "cell", "ids", "alive", "vocab")
    return left.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(narrow, MINED)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least_count: int = LEAST_COUNT) -> DataFrame:
    """Phrases of 1 to ``longest`` words: ``lang, phrase, f, n``.

    SON partitioning: the units form ``SHARDS`` shards, each of which is mined for
    all phrases that reach its local support; the union of these is counted over all
    units exactly. Shards are mined by length of phrase: a phrase is looked at only
    where the two phrases one word shorter are in the union. ``f`` counts a phrase and
    ``n`` all words of its language.
    """
    labels = []
    with shuffles_removed(docs.sparkSession):
        parts = written(units(with_support(written(chunked(docs), "chunks"), least_count)), "units")
        for k in range(1, longest + 1):
            parts = written(narrowed(parts, mined(requests(parts, k)), k, k == longest), f"mined{k}")
            spelled = F.inline("labels").alias("phrase", "f")
            labels.append(parts.select("lang", F.col("lang_words").alias("n"), spelled))
        found = reduce(DataFrame.unionByName, labels).where(F.col("f") >= least_count)
        return written(found.select("lang", "phrase", "f", "n"), "phrases")


def _words(phrase: str = "phrase") -> Column:
    return F.split(F.col(phrase), " ", -1)


def _joined(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words or more with their weakest cut: ``k, l, r, score``.

    Products may pass 64 bits; they are decimals, and the quotient is rounded down.
    """
    words = _words()
    cuts = found.select(
        "lang", "phrase", F.col("f").alias("a"), "n", words.alias("w"),
        F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"),
    ).where(F.size("w") > 1)
    cuts = cuts.select(
        "lang", "phrase", "a", "n", "k",
        _joined(F.col("w"), F.lit(1), F.col("k")).alias("head"),
        _joined(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"),
    )
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(18, 0)"
    score = F.expr(
        f"(cast(1000 * a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))"
    )
    both = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        both.groupBy("lang", "phrase", "a", "n")
        .agg(weakest.alias("cut"))
        .select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    )


def absorbing(found: DataFrame) -> DataFrame:
    """Most occurrences of a longer phrase around each phrase inside one: ``lang, phrase, around``."""
    words = _words()
    size = F.size("w")
    spans = found.select("lang", "f", words.alias("w")).where(size > 2)
    spans = spans.select("lang", "f", "w", F.explode(F.sequence(F.lit(2), size - 1)).alias("length"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)).alias("first"))
    inner = _joined(F.col("w"), F.col("first"), F.col("length"))
    return spans.groupBy("lang", inner.alias("phrase")).agg(F.max("f").alias("around"))


def mine(
    docs: DataFrame,
    longest: int = LONGEST,
    least_count: int = LEAST_COUNT,
    top: int = TOP,
    absorb_percent: int = ABSORB_PERCENT,
) -> DataFrame:
    """The best phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are lower case (A-Z only) and stay within pieces between points and ends of
    lines. A phrase of ``a`` occurrences is scored by its weakest cut into parts of
    ``l`` and ``r`` occurrences; it goes if a longer one has ``absorb_percent`` of its
    occurrences or more.

    A NULL language is ``und``, a NULL text empty; repeated rows count each; ids do not
    matter; an empty table gives no rows; other columns are ignored. Phrases meet by
    hashes of 64 bits: among 10^10 phrases one of 10^6 frequent ones would meet another
    with a chance of some 10^-3.
    """
    found = frequent_phrases(docs, longest, least_count)
    around = absorbing(found)
    kept = scored(found).join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < absorb_percent * F.col("a"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
