"""Language-model scoring: a hierarchical Pitman-Yor model seated by Gibbs sampling."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import written
from fareloom.llm.phrases import shuffles_removed

#: Discount and strength of the context restaurants and of the parent they share.
DISCOUNT, STRENGTH = 0.75, 20.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 100.0
#: Gibbs sweeps before the first sample, and samples that are averaged.
BURN_IN, SAMPLES = 2, 3
#: Counts up to this one are reseated exactly; larger ones in growing blocks.
EXACT = 64
SEED = 7
#: Text bytes of a chunk of documents, and so about those of a bucket of words.
CHUNK_BYTES = 16_000_000
#: Fewest buckets of words.
LEAST_BUCKETS = 16
#: Hash that stands for the end of a text, and as a context for its start.
END = np.uint64(0xE0D0E0D0E0D0E0D1)


@lru_cache(maxsize=4)
def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Log generalized Stirling numbers: ways to seat ``c`` customers at ``t`` tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        t = np.arange(c + 2)
        stay = np.full(c + 2, -np.inf)
        weight = c - discount * t
        np.log(weight, out=stay, where=weight > 0)
        new = np.concatenate(([-np.inf], out[c, : c + 1]))
        out[c + 1, : c + 2] = np.logaddexp(new, out[c, : c + 2] + stay)
    return out


def draw_tables(
    counts: np.ndarray, rest: np.ndarray, base: np.ndarray, discount: float, strength: float, rng: np.random.Generator
) -> np.ndarray:
    """Reseat the customers of each dish: a new number of tables given the rest.

    ``rest`` are the tables of other dishes in the dish's restaurant, ``base`` the
    probability of the dish in the parent. Up to ``EXACT`` customers the number is
    drawn from its conditional distribution; more are seated one after another by
    the Chinese-restaurant rule, in blocks of an eighth of those already seated.
    """
    tables = np.minimum(counts, 1)
    stirling = log_stirling(discount)
    for c in np.unique(counts[(counts > 1) & (counts <= EXACT)]):
        at = np.flatnonzero(counts == c)
        more = strength + discount * (rest[at, None] + np.arange(c))
        weights = stirling[c, 1 : c + 1] + np.cumsum(np.log(more * base[at, None]), axis=1)
        tables[at] = np.argmax(weights + rng.gumbel(size=weights.shape), axis=1) + 1
    at = np.flatnonzero(counts > EXACT)
    seated = np.ones(len(at), np.int64)
    t = np.ones(len(at), np.int64)
    while len(open_ := np.flatnonzero(seated < counts[at])):
        who = at[open_]
        block = np.minimum(np.maximum(1, seated[open_] // 8), counts[who] - seated[open_])
        new = (strength + discount * (rest[who] + t[open_])) * base[who]
        old = seated[open_] - discount * t[open_]
        t[open_] += rng.binomial(block, new / (new + old))
        seated[open_] += block
    tables[at] = t
    return tables


def sweep(
    word: np.ndarray, context: np.ndarray, counts: np.ndarray, tables: np.ndarray, in_context: np.ndarray,
    opened: np.ndarray, n_types: int, seats: int, root_seats: int, rng: np.random.Generator,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Reseat the entries of a bucket of words, then its words in the parent.

    ``tables`` of the entries and ``opened``, tables of the words in the parent, are
    the seating before. ``in_context`` are the tables of each context, ``seats`` and
    ``root_seats`` the customers and tables of the parent, over all buckets. Returns
    the new tables of entries, and per word the customers and tables of the parent.
    """
    customers = np.bincount(word, tables, len(opened)).astype(np.int64)
    base = (customers - ROOT_DISCOUNT * opened + (ROOT_STRENGTH + ROOT_DISCOUNT * root_seats) / (n_types + 1)) / (
        ROOT_STRENGTH + seats
    )
    tables = draw_tables(counts, in_context[context] - tables, base[word], DISCOUNT, STRENGTH, rng)
    customers = np.bincount(word, tables, len(opened)).astype(np.int64)
    uniform = np.full(len(opened), 1 / (n_types + 1))
    opened = draw_tables(customers, root_seats - opened, uniform, ROOT_DISCOUNT, ROOT_STRENGTH, rng)
    return tables, customers, opened


def bucket_starts(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of sorted hashes, by their upper bits, and where each starts and ends."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    buckets, starts = np.unique(bucket.astype(np.int32), return_index=True)
    return buckets, starts, np.append(starts, len(hashes))[1:]


class Chunk:
    """Tokens of some documents, as distinct (word, word before) entries in order of hash."""

    def __init__(self, texts: list[str | None]) -> None:
        places: dict[bytes, int] = {b"": 0}
        sizes = np.empty(len(texts), np.int64)
        tokens: list[np.ndarray] = []
        for i, text in enumerate(texts):
            found = (text or "").encode().lower().split()
            row = [places.setdefault(w, len(places)) for w in found]
            row.append(0)
            sizes[i] = len(row)
            tokens.append(np.array(row, np.int64))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in places), np.uint64, len(places))
        hashes[0] = END
        token = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
        del tokens, places
        self.sizes = sizes
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # Before the first word of a text stands the end of the one before it.
        token = rank[token]
        before = np.append(rank[:1], token)[:-1]
        keys, self.entry = np.unique(token * len(order) + before, return_inverse=True)
        self.word, self.context = keys // len(order), keys % len(order)
        self.hashes = hashes[order]

    def packed(self, n_buckets: int, chunk_id: int, counted: bool) -> pa.Table:
        """A row per bucket of words: its words, and the entries of each with their contexts."""
        buckets, starts, ends = bucket_starts(self.hashes, n_buckets)
        first = np.searchsorted(self.word, np.append(starts, len(self.hashes)))
        sizes = np.bincount(self.word, minlength=len(self.hashes))
        counts = np.bincount(self.entry, minlength=len(self.word)) if counted else np.empty(0, np.int64)
        columns: dict[str, list] = {"words": [], "sizes": [], "contexts": [], "places": [], "counts": []}
        for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
            at = slice(first[i], first[i + 1])
            contexts, places = np.unique(self.context[at], return_inverse=True)
            columns["words"].append(_packed(self.hashes[s:e], "<u8"))
            columns["sizes"].append(_packed(sizes[s:e], "<u4"))
            columns["contexts"].append(_packed(self.hashes[contexts], "<u8"))
            columns["places"].append(_packed(places, "<u4"))
            columns["counts"].append(_packed(counts[at], "<u4"))
        return pa.table(
            {"_bucket": pa.array(buckets, pa.int32()), "_chunk": pa.array([chunk_id] * len(buckets), pa.int32())}
            | {name: pa.array(values, pa.binary()) for name, values in columns.items()}
        )


def _packed(array: np.ndarray, kind: str) -> bytes:
    """The array, compressed byte place by byte place, after its size in bytes."""
    array = np.ascontiguousarray(array, kind)
    planes = array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(content: bytes, kind: str) -> np.ndarray:
    planes = pa.decompress(content[8:], int.from_bytes(content[:8], "little"), "zstd", asbytes=True)
    bytes_ = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(bytes_.T).view(kind).ravel()


def _read(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """The arrays of a column, one after another."""
    return np.concatenate([np.empty(0, kind), *(_unpacked(x, kind) for x in table.column(name).to_pylist() if x)])


def _count_of(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """Number of items in each array of a column."""
    width = np.dtype(kind).itemsize
    return np.array([int.from_bytes(x[:8], "little") // width for x in table.column(name).to_pylist()], np.int64)


def entries_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word of each packed entry, by place among all words of the rows; and its context, likewise."""
    words = np.repeat(np.arange(len(sizes := _read(table, "sizes", "<u4"))), sizes)
    asked = _count_of(table, "contexts", "<u8")
    starts = np.repeat(np.cumsum(asked) - asked, _count_of(table, "places", "<u4"))
    return words, _read(table, "places", "<u4") + starts


def _place(among: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, or -1."""
    if not len(among):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


PAYLOAD = "_bucket int, _chunk int, words binary, sizes binary, contexts binary, places binary, counts binary"
ENTRIES = "_bucket int, words binary, sizes binary, contexts binary, places binary, counts binary, n_tokens long, n_types long"
#: Tables of some contexts in a bucket, for their own buckets; or with ``_from`` -1 the seating of the bucket.
SENT = "_bucket int, _from int, contexts binary, tables binary, opened binary, seats long, root_seats long"
#: The same rows after it: tables of those contexts over all buckets, sent back; the seating has those of its words.
TOLD = "_bucket int, _from int, in_context binary, tables binary, opened binary, seats long, root_seats long"
REPLY = "_chunk int, _bucket int, counts binary, seated binary, entries binary"
#: Rows of some documents of a chunk as a compressed Arrow stream.
DEALT = "_chunk int, rows binary"


def learn(texts: DataFrame, n_buckets: int, text: str = "text") -> DataFrame:
    """Distinct (word, word before) entries of the texts with their counts, a row per bucket of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, first = batch.column(0), 0
            ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
            while first < len(ends):
                start = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, start + CHUNK_BYTES)))
                yield from Chunk(column.slice(first, last - first).to_pylist()).packed(n_buckets, -1, True).to_batches()
                first = last

    def merge(table: pa.Table) -> pa.Table:
        words, word = np.unique(_read(table, "words", "<u8"), return_inverse=True)
        contexts, context = np.unique(_read(table, "contexts", "<u8"), return_inverse=True)
        own_word, own_context = entries_of(table)
        keys, entry = np.unique(word[own_word] * len(contexts) + context[own_context], return_inverse=True)
        del own_word, own_context
        counts = np.bincount(entry, _read(table, "counts", "<u4"), len(keys))
        binaries = {
            "words": _packed(words, "<u8"),
            "sizes": _packed(np.bincount(keys // len(contexts), minlength=len(words)), "<u4"),
            "contexts": _packed(contexts, "<u8"),
            "places": _packed(keys % len(contexts), "<u4"),
            "counts": _packed(counts, "<u4"),
        }
        return pa.table(
            {"_bucket": table.column("_bucket")[:1]}
            | {name: pa.array([packed], pa.binary()) for name, packed in binaries.items()}
            | {"n_tokens": pa.array([int(counts.sum())], pa.int64()), "n_types": pa.array([len(words)], pa.int64())}
        )

    payload = texts.select(text).mapInArrow(count, PAYLOAD)
    return written(payload.groupBy("_bucket").applyInArrow(merge, ENTRIES), "op4-entries")


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each chunk in a batch, packed; the chunk is the last column."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        table = pa.Table.from_batches([batch]).sort_by("_chunk")
        chunks, starts = np.unique(table.column("_chunk").to_numpy(), return_index=True)
        table = table.drop_columns("_chunk")
        packed = []
        for start, end in zip(starts, np.append(starts, len(table))[1:], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as stream:
                stream.write_table(table.slice(start, end - start).combine_chunks())
            packed.append(sink.getvalue().to_pybytes())
        yield pa.record_batch([pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], names=["_chunk", "rows"])


def exchanged(sent: DataFrame, name: str) -> DataFrame:
    """Tables of each context added up over all buckets, by its own bucket, and sent back."""

    def add_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("_from")
        senders = table.column("_from").to_pylist()
        sizes = _count_of(table, "contexts", "<u8")
        contexts, place = np.unique(_read(table, "contexts", "<u8"), return_inverse=True)
        messages = table.filter(pc.greater_equal(table.column("_from"), 0))
        total = np.bincount(place, _read(messages, "tables", "<u4"), len(contexts)).astype(np.int64)
        ends = np.cumsum(sizes)
        # Every word learned stands before another, so the contexts are those of the seating's words.
        found = [
            _packed(total if sender < 0 else total[place[end - size : end]], "<u8")
            for sender, size, end in zip(senders, sizes, ends, strict=True)
        ]
        bucket = table.column("_bucket").to_pylist()
        seating = [sender < 0 for sender in senders]
        tables, opened = table.column("tables").to_pylist(), table.column("opened").to_pylist()
        return pa.table(
            {
                "_bucket": pa.array([b if own else f for own, b, f in zip(seating, bucket, senders, strict=True)], pa.int32()),
                "_from": pa.array([-1 if own else b for own, b in zip(seating, bucket, strict=True)], pa.int32()),
                "in_context": pa.array(found, pa.binary()),
                "tables": pa.array([t if own else b"" for own, t in zip(seating, tables, strict=True)], pa.binary()),
                "opened": pa.array(opened, pa.binary()),
                "seats": table.column("seats"),
                "root_seats": table.column("root_seats"),
            }
        )

    return written(sent.groupBy("_bucket").applyInArrow(add_up, TOLD), name)


def seatings(entries: DataFrame, n_buckets: int, n_types: int) -> list[tuple[DataFrame, int, int]]:
    """Sampled seatings with the customers and tables of the parent, from sweeps over all entries.

    Between two sweeps the tables of every context are added up over all buckets, so
    each bucket reseats its words given the totals of the whole.
    """

    def message(bucket: int, contexts: np.ndarray, place: np.ndarray, tables: np.ndarray,
                customers: np.ndarray, opened: np.ndarray) -> pa.Table:
        own = np.bincount(place, tables, len(contexts))
        to, starts, ends = bucket_starts(contexts, n_buckets)
        cuts = [*zip(starts, ends, strict=True)]
        n = len(cuts)
        return pa.table(
            {
                "_bucket": pa.array([*to.tolist(), bucket], pa.int32()),
                "_from": pa.array([bucket] * n + [-1], pa.int32()),
                "contexts": pa.array([_packed(contexts[s:e], "<u8") for s, e in cuts] + [_packed(contexts[:0], "<u8")], pa.binary()),
                "tables": pa.array([_packed(own[s:e], "<u4") for s, e in cuts] + [_packed(tables, "<u4")], pa.binary()),
                "opened": pa.array([b""] * n + [_packed(opened, "<u4")], pa.binary()),
                "seats": pa.array([0] * n + [int(customers.sum())], pa.int64()),
                "root_seats": pa.array([0] * n + [int(opened.sum())], pa.int64()),
            }
        )

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                place, sizes = _read(row, "places", "<u4"), _read(row, "sizes", "<u4")
                ones = np.ones(len(sizes), np.int64)
                contexts, tables = _read(row, "contexts", "<u8"), np.ones(len(place), np.int64)
                yield from message(row.column(0)[0].as_py(), contexts, place, tables, sizes, ones).to_batches()

    def step(n: int, seats: int, root_seats: int):  # noqa: ANN202
        def reseat(row: pa.Table, told: pa.Table) -> pa.Table:
            bucket = row.column("_bucket")[0].as_py()
            told = told.sort_by("_from")
            word, place = entries_of(row)
            tables, customers, opened = sweep(
                word, place, _read(row, "counts", "<u4").astype(np.int64),
                _read(told, "tables", "<u4").astype(np.int64), _read(told.slice(1), "in_context", "<u8").astype(np.int64),
                _read(told, "opened", "<u4").astype(np.int64), n_types, seats, root_seats,
                np.random.default_rng([SEED, n, bucket]),
            )
            return message(bucket, _read(row, "contexts", "<u8"), place, tables, customers, opened)

        return reseat

    def totals(told: DataFrame) -> tuple[DataFrame, int, int]:
        row = told.agg(F.sum("seats").alias("seats"), F.sum("root_seats").alias("root_seats")).first()
        return told, row["seats"] or 0, row["root_seats"] or 0

    found = [totals(exchanged(entries.mapInArrow(begin, SENT), "op4-sweep-0"))]
    for n in range(1, BURN_IN + SAMPLES + 1):
        told, seats, root_seats = found[-1]
        sent = entries.groupBy("_bucket").cogroup(told.groupBy("_bucket"))
        found.append(totals(exchanged(sent.applyInArrow(step(n, seats, root_seats), SENT), f"op4-sweep-{n}")))
    return found[-SAMPLES:]


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probability of every text under the model, and under add-one unigrams.

    The model is learned from the rows that are not ``held_out``. Every word has a
    context restaurant of its own that seats the words after it, the end of texts one
    for first words. They share one parent, whose customers are their tables; the
    parent's base is uniform over the words and one unseen word. Seatings are sampled
    by Gibbs sweeps, and the predictive probability of a token is averaged over the
    samples; it sums to one over words.

    Texts to learn from become distinct (word, word before) entries with counts, packed
    by hash of the word and merged by bucket of words. In a sweep all buckets reseat their
    entries; then the tables of every context are added up over all buckets and sent
    back, which ends the sweep. To score, documents are dealt into chunks by hash; a
    chunk sends its entries to the buckets, which reply with counts and tables.

    Returns the key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``. NULL texts count as empty: the end is their only
    token. Without training rows both models are uniform. Repeated rows count and
    score one by one; an empty table gives no rows; other columns are ignored.
    Words and contexts are told apart by 64-bit hashes. One task holds all entries
    of a word.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    # Buckets shape the samples, so nothing but the input may decide their number.
    n_buckets = max(math.ceil(total / CHUNK_BYTES), LEAST_BUCKETS)
    rows = docs.select(F.col(key), F.col(text), held_out.alias("held_out"))
    chunk = F.pmod(F.xxhash64(key, text), F.lit(n_buckets)).cast("int")
    dealt = rows.withColumn("_chunk", chunk).mapInArrow(pieces_of, DEALT)
    with shuffles_removed(spark):
        entries = learn(rows.where(~F.col("held_out")), n_buckets, text)
        sums = entries.agg(F.sum("n_tokens").alias("n"), F.sum("n_types").alias("types")).first()
        n, types = sums["n"] or 0, sums["types"] or 0
        samples = seatings(entries, n_buckets, types)
    sums_of = [(seats, root_seats) for _, seats, root_seats in samples]

    def tokens_of(table: pa.Table) -> tuple[pa.Table, Chunk]:
        table = pa.concat_tables([pa.ipc.open_stream(packed).read_all() for packed in table.column("rows").to_pylist()])
        # Both reads of a chunk must see its rows in one order.
        table = table.sort_by([(key, "ascending"), (text, "ascending")])
        return table, Chunk(table.column(text).to_pylist())

    def ask(table: pa.Table) -> pa.Table:
        chunk_id = table.column("_chunk")[0].as_py()
        return tokens_of(table)[1].packed(n_buckets, chunk_id, False)

    def reply(asked: pa.Table, learned: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return no_reply
        learned = learned.sort_by("_sample")
        row, seated = learned.slice(0, min(learned.num_rows, 1)), learned.slice(1)
        known, contexts = _read(row, "words", "<u8"), _read(row, "contexts", "<u8")
        word, place = entries_of(row)
        counts = _read(row, "counts", "<u4").astype(np.int64)
        # One more, at the end, stands for words and entries that were not learned.
        word_counts = np.append(np.bincount(word, counts, len(known)), 0)
        summed = np.zeros(len(word), np.int64)
        # Per sample, a word's customers and tables in the parent, and the tables of its own restaurant.
        of_word = np.zeros((3 * SAMPLES, len(known) + 1), np.int64)
        for s in range(seated.num_rows):
            one = seated.slice(s, 1)
            tables = _read(one, "tables", "<u4")
            summed += tables
            of_word[s, :-1] = np.bincount(word, tables, len(known))
            of_word[SAMPLES + s, :-1] = _read(one, "opened", "<u4")
            of_word[2 * SAMPLES + s, :-1] = _read(one, "in_context", "<u8")
        of_entry = np.stack([np.append(counts, 0), np.append(summed, 0)])
        keys = word * len(contexts) + place
        found: dict[str, list] = {"counts": [], "seated": [], "entries": []}
        for i in range(asked.num_rows):
            one = asked.slice(i, 1)
            at = _place(known, _read(one, "words", "<u8"))
            found["counts"].append(_packed(word_counts[at], "<u8"))
            found["seated"].append(_packed(of_word[:, at].ravel(), "<u8"))
            words, places = entries_of(one)
            w, c = at[words], _place(contexts, _read(one, "contexts", "<u8"))[places]
            at = _place(keys, np.where((w < 0) | (c < 0), -1, w * len(contexts) + c))
            found["entries"].append(_packed(of_entry[:, at].ravel(), "<u4"))
        return pa.table(
            {"_chunk": asked.column("_chunk"), "_bucket": asked.column("_bucket")}
            | {name: pa.array(packed, pa.binary()) for name, packed in found.items()}
        )

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return empty
        table, chunk = tokens_of(table)
        told = told.sort_by("_bucket")
        count_of = _read(told, "counts", "<u8").astype(float)
        seated = [_unpacked(x, "<u8").reshape(3 * SAMPLES, -1) for x in told.column("seated").to_pylist()]
        customers, opened, in_context = np.split(np.concatenate(seated, axis=1).astype(float), 3)
        of_entry = [_unpacked(x, "<u4").reshape(2, -1) for x in told.column("entries").to_pylist()]
        counts, tables = np.concatenate(of_entry, axis=1).astype(float)
        if len(count_of) != len(chunk.hashes) or len(counts) != len(chunk.word):
            raise RuntimeError("the documents of a chunk changed between two reads")
        unseen = np.array([(ROOT_STRENGTH + ROOT_DISCOUNT * root_seats) / (types + 1) for _, root_seats in sums_of])
        divisor = np.array([ROOT_STRENGTH + seats for seats, _ in sums_of])
        root = (customers - ROOT_DISCOUNT * opened + unseen[:, None]) / divisor[:, None]
        c, w = chunk.context, chunk.word
        own = counts - DISCOUNT * tables / SAMPLES
        backed = sum((STRENGTH + DISCOUNT * in_context[s][c]) * root[s][w] for s in range(SAMPLES)) / SAMPLES
        # A word is followed as often as it occurs.
        chance = np.log10((own + backed) / (STRENGTH + count_of[c]))
        base = np.log10((count_of[w] + 1) / (n + types + 1))
        doc, entry, m = chunk.doc, chunk.entry, table.num_rows
        return pa.table(
            {
                key: table.column(key),
                "held_out": table.column("held_out"),
                "n_tokens": pa.array(chunk.sizes, pa.int64()),
                "n_known": pa.array(np.bincount(doc, (count_of[w] > 0)[entry], m).astype(np.int64)),
                "train_tokens": pa.array(np.full(m, n), pa.int64()),
                "base_score": pa.array(np.bincount(doc, base[entry], m)),
                "score": pa.array(np.bincount(doc, chance[entry], m)),
            }
        )

    kind = rows.schema[key].dataType.simpleString()
    result = (
        f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    empty = pa.table(
        {n: pa.array([], t) for n, t in zip(
            (key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
            (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)}
    )
    no_reply = pa.table(
        {"_chunk": pa.array([], pa.int32()), "_bucket": pa.array([], pa.int32()),
         "counts": pa.array([], pa.binary()), "seated": pa.array([], pa.binary()), "entries": pa.array([], pa.binary())}
    )
    learned = entries.drop("n_tokens", "n_types").withColumn("_sample", F.lit(-1))
    for s, (told, _, _) in enumerate(samples):
        seating = told.where("_from = -1").select("_bucket", "in_context", "tables", "opened")
        learned = learned.unionByName(seating.withColumn("_sample", F.lit(s)), allowMissingColumns=True)
    asked = dealt.groupBy("_chunk").applyInArrow(ask, PAYLOAD).drop("counts")
    told = asked.groupBy("_bucket").cogroup(learned.groupBy("_bucket")).applyInArrow(reply, REPLY)
    return dealt.groupBy("_chunk").cogroup(told.groupBy("_chunk")).applyInArrow(finish, result)
