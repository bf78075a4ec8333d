"""SentencePiece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from fareloom.llm.common import held

BLANK = "▁"
#: Runs of the text that no merge crosses: blanks with the characters after them.
_RUN = re.compile(rf"{BLANK}*[^{BLANK}]+|{BLANK}+")

#: Odd number that spreads steps and pairs over 64 bits.
STEP_FACTOR = np.uint64(0xD6E8FEB86659FD93)
#: Share of candidate merges that are skipped.
DROPOUT = 0.1
#: More steps than the agenda of a run of ``LONG_RUN`` characters or fewer takes.
MOST_STEPS = 256
#: Runs of more characters keep their agenda as a heap, and are not remembered.
LONG_RUN = 64
OUT = float("inf")
#: Runs whose segmentation without skips a worker remembers, at most about 400 bytes each.
REMEMBERED = 400_000
#: Characters of texts that are encoded together, and entries of agendas that step together.
GROUP_CHARS, ENTRIES = 1_000_000, 100_000
#: Stands for no part.
NONE = -1


class _Numbers(dict):
    """Numbers of parts; a character that no piece holds gets one when it is met."""

    def __init__(self, parts: list[str]) -> None:
        super().__init__(zip(parts, range(len(parts)), strict=True))
        self.parts = parts

    def __missing__(self, char: str) -> int:
        self.parts.append(char)
        self[char] = len(self.parts) - 1
        return self[char]


class PieceModel:
    """Pieces and merge ranks of a SentencePiece BPE model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes_of: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, float] = {}
        self.byte_ids = [0] * 256
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece] = i
                self.ranks[piece] = -model.get_score(i)
                self.bytes_of.append(piece.replace(BLANK, " ").encode())
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            raise ValueError("a piece holds a blank after other characters")
        self.byte_pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.byte_sizes = np.array([*map(len, self.bytes_of)], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self._table_pairs()
        self.forget()

    def _table_pairs(self) -> None:
        """Number the pieces and table, by hash, the pairs of parts that make them."""
        self.piece_ids = np.array([*self.ids.values()], np.int32)
        self.number = number = _Numbers([*self.ids])
        #: Numbers of the characters met so far, by code point.
        self.char_numbers = np.full(0x110000, NONE, np.int32)
        # The last rank is that of no piece.
        self.rank_of = np.array([self.ranks[piece] for piece in self.ids] + [OUT])
        pairs = [
            (number[piece[:k]] << 32 | number[piece[k:]], whole)
            for whole, piece in enumerate([*self.ids])
            for k in range(1, len(piece))
            if (k == 1 or piece[:k] in number) and (k == len(piece) - 1 or piece[k:] in number)
        ]
        keys, wholes = np.array(pairs, np.int64).reshape(-1, 2).T
        self.bits = len(pairs).bit_length() + 2
        self.pair_keys, self.pair_wholes = (np.full(1 << self.bits, NONE, np.int64) for _ in range(2))
        at = self._slots(keys)
        while len(keys):
            # Of the pairs that want a free slot one gets it; the others go on to the next.
            free = self.pair_keys[at] == NONE
            self.pair_keys[at[free]] = keys[free]
            placed = self.pair_keys[at] == keys
            self.pair_wholes[at[placed]] = wholes[placed]
            keys, wholes, at = keys[~placed], wholes[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * STEP_FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the piece that each pair of parts makes, or ``NONE``."""
        keys = left << 32 | right
        at = self._slots(keys)
        there = self.pair_keys[at]
        # No part makes a key below zero: that of a free slot, or of none, and both make no piece.
        other = there != keys
        found = self.pair_wholes[at]
        found[other] = NONE
        open_ = np.flatnonzero(other & (there != NONE) & (keys >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.pair_keys[at[open_]]
            same = there == keys[open_]
            found[open_[same]] = self.pair_wholes[at[open_[same]]]
            open_ = open_[~same & (there != NONE)]
        return found

    def _characters(self, text: str) -> np.ndarray:
        """Numbers of the characters of a text."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        found = self.char_numbers[points]
        if len(new := np.unique(points[found == NONE])):
            self.char_numbers[new] = [self.number[chr(point)] for point in new.tolist()]
            found = self.char_numbers[points]
        return found

    def forget(self) -> None:
        """Empty the memory of runs: their places, and per place steps, ids and where they are."""
        self.places: dict[str, int] = {}
        self.steps, self.sizes, self.starts = (np.empty(0, np.int64) for _ in range(3))
        self.pool = np.empty(0, np.int32)

    def segment_all(
        self, runs: list[str], keys: np.ndarray | None = None, dropout: float = 0.0
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Steps taken and number of ids of each run, and their ids one after another.

        As ``segment``, but runs of like length take their steps together. The skip of
        a step is drawn from the key of the run; without keys there are none.
        """
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        steps, sizes = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        found, at = [np.empty(0, np.int32)], 0
        while at < len(order):
            end = np.searchsorted(ordered, ordered[at] + 1, "right")
            own = order[at : min(int(end), at + ENTRIES // (int(ordered[at]) + 2) + 1)]
            drawn = None if keys is None else keys[own]
            steps[own], sizes[own], ids = self._step_together([runs[i] for i in own.tolist()], lengths[own], drawn, dropout)
            found.append(ids)
            at += len(own)
        starts = np.empty(len(runs), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return steps, sizes, np.concatenate(found)[ragged(starts, sizes)]

    def _step_together(
        self, runs: list[str], lengths: np.ndarray, keys: np.ndarray | None, dropout: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts and the ranks of pairs lie in a row per run, whose last entry is no part.

        A merged part stays in the place of its left side, and the place of the right
        one is passed over from then on, so the order of places is that of the text.
        """
        n = len(runs)
        wide = int(lengths.max()) + 1
        parts = np.full((n, wide), NONE, np.int64)
        parts[np.arange(wide) < lengths[:, None]] = self._characters("".join(runs))
        parts = parts.ravel()
        after, before = np.arange(1, n * wide + 1), np.arange(-1, n * wide - 1)
        before[::wide] += wide
        whole = self._joined(parts, np.append(parts[1:], NONE))
        agenda = self.rank_of[whole]
        by_run = agenda.reshape(n, wide)
        steps, live = np.zeros(n, np.int64), np.arange(n)
        while len(live):
            best = (by_run if len(live) == n else by_run[live]).argmin(axis=1) + live * wide
            open_ = agenda[best] != OUT
            live, best = live[open_], best[open_]
            steps[live] += 1
            if keys is not None:
                out = skipped(keys[live], steps[live], dropout)
                agenda[best[out]] = OUT
                best = best[~out]
            made, gone, left = whole[best], after[best], before[best]
            right = after[gone]
            parts[best], parts[gone], agenda[gone] = made, NONE, OUT
            after[best], before[right] = right, best
            changed = np.concatenate([best, left])
            whole[changed] = self._joined(
                np.concatenate([made, parts[left]]), np.concatenate([parts[right], made])
            )
            agenda[changed] = self.rank_of[whole[changed]]
        kept = parts != NONE
        sizes, flat = kept.reshape(n, wide).sum(axis=1), parts[kept]
        spelled = np.flatnonzero(flat >= len(self.piece_ids))
        ids = self.piece_ids[np.minimum(flat, len(self.piece_ids) - 1)]
        if len(spelled):
            # Characters that are no piece become their bytes.
            as_bytes = [self._spelled(self.number.parts[x]) for x in flat[spelled].tolist()]
            widths = np.ones(len(flat), np.int64)
            widths[spelled] = [len(b) for b in as_bytes]
            ends = np.cumsum(widths)
            ids = np.repeat(ids, widths)
            ids[ragged(ends[spelled] - widths[spelled], widths[spelled])] = np.concatenate(as_bytes)
            run_ends = ends[np.cumsum(sizes) - 1]
            sizes = np.diff(run_ends, prepend=0)
        return steps, sizes, ids

    def _spelled(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()]

    def segment(self, run: str, skipped: int) -> tuple[int, tuple[int, ...]]:
        """Steps taken and ids of a run: merges come from an agenda, best rank first.

        The agenda holds the rank of each pair of neighbours. The candidate of a step
        is skipped, and then stays out, if the step's bit of ``skipped`` is set; a pair
        made by a later merge is a new candidate. Ties go to the left.
        """
        parts = list(run)
        rank_of = self.ranks.get
        agenda = [rank_of(a + b, OUT) for a, b in zip(parts, parts[1:], strict=False)]
        last, step = len(agenda) - 1, 0
        while last >= 0 and (best := min(agenda)) != OUT:
            i = agenda.index(best)
            step += 1
            if skipped >> step - 1 & 1:
                agenda[i] = OUT
                continue
            parts[i] = whole = parts[i] + parts[i + 1]
            del parts[i + 1], agenda[i]
            if i < last:
                agenda[i] = rank_of(whole + parts[i + 1], OUT)
            if i:
                agenda[i - 1] = rank_of(parts[i - 1] + whole, OUT)
            last -= 1
        return step, self._ids(parts)

    def segment_long(self, run: str, key: int, dropout: float) -> tuple[int, ...]:
        """The same with a heap, for runs that are too long to search one by one."""
        parts, n = list(run), len(run)
        ends = list(range(1, n + 1))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        flags, step = b"", 0
        agenda: list[tuple] = []

        def offer(left: int, right: int) -> None:
            rank = self.ranks.get(parts[left] + parts[right])
            if rank is not None:
                heapq.heappush(agenda, (rank, left, right, ends[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            rank, left, right, end = heapq.heappop(agenda)
            if not parts[left] or after[left] != right or ends[right] != end:
                continue
            if self.ranks.get(parts[left] + parts[right]) != rank:
                continue
            if dropout:
                if step % 4096 == 0:
                    flags = skips(np.array([key], np.uint64), step, 4096, dropout)[0].tobytes()
                step += 1
                if flags[(step - 1) % 4096]:
                    continue
            parts[left] += parts[right]
            parts[right], ends[left], after[left] = "", end, after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return self._ids([part for part in parts if part])

    def _ids(self, parts: list[str]) -> tuple[int, ...]:
        ids = tuple(map(self.ids.get, parts))
        if None not in ids:
            return ids
        spelled: list[int] = []
        for part, known in zip(parts, ids, strict=True):
            spelled.extend([known] if known is not None else [self.byte_ids[b] for b in part.encode()])
        return tuple(spelled)

    def encode(self, text: str, row_key: int, dropout: float) -> list[int]:
        """Ids of one text, see ``encode_all``."""
        return next(self.encode_all([text], [row_key], dropout)).tolist()

    def encode_all(self, texts: list[str], row_keys: list[int], dropout: float) -> Iterator[np.ndarray]:
        """Ids of texts; a blank sign (U+2581) in a text itself is spelled in bytes.

        Each run of a text has a key of its own, by the row key and its place.
        """
        group: list[tuple[list[str], int]] = []
        held = 0
        for text, row_key in zip(texts, row_keys, strict=True):
            group.append((runs_of(text), row_key))
            held += len(text)
            if held >= GROUP_CHARS:
                yield from self._encode_group(group, dropout)
                group, held = [], 0
        yield from self._encode_group(group, dropout)

    def _places_of(self, runs: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.get, runs, repeat(NONE)), np.int64, len(runs))

    def _learn(self, runs: set[str]) -> None:
        """Remember runs without skips."""
        if "" not in self.places:
            # The empty run stands for a blank sign of the text.
            self.places[""] = 0
            self.pool = np.array(self._spelled(BLANK), np.int32)
            self.steps, self.starts, self.sizes = (np.array([x]) for x in (0, 0, len(self.pool)))
        new = [run for run in runs if run not in self.places and len(run) <= LONG_RUN]
        steps, sizes, ids = self.segment_all(new)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.starts = np.append(self.starts, len(self.pool) + np.cumsum(sizes) - sizes)
        self.steps, self.sizes = np.append(self.steps, steps), np.append(self.sizes, sizes)
        self.pool = np.append(self.pool, ids)

    def _encode_group(self, group: list[tuple[list[str], int]], dropout: float) -> Iterator[np.ndarray]:
        runs = [*chain.from_iterable(own for own, _ in group)]
        known = self._places_of(runs)
        unknown = np.flatnonzero(known == NONE)
        missed = [runs[i] for i in unknown.tolist()]
        new = set(missed)
        if len(self.places) + len(new) > REMEMBERED:
            self.forget()
            self._learn(set(runs))
            known = self._places_of(runs)
        else:
            self._learn(new)
            known[unknown] = self._places_of(missed)
        counts = np.array([len(own) for own, _ in group], np.int64)
        # The key of a run is drawn from its place among the runs of its text.
        real = np.cumsum(known != self.places[""])
        ends = np.append(0, real)[np.cumsum(counts) - counts]
        place = (real - 1 - np.repeat(ends, counts)).astype(np.uint64)
        keys = _mixed(place + np.repeat(np.array([key for _, key in group], np.uint64), counts))
        steps, sizes, starts = self.steps[known], self.sizes[known], self.starts[known]
        # Runs with a skip among the steps that they take without one.
        hit = np.zeros(len(runs), bool)
        open_, step = np.flatnonzero(known != NONE) if dropout else np.empty(0, np.int64), 0
        while len(open_ := open_[steps[open_] > step]):
            step += 1
            out = skipped(keys[open_], np.full(len(open_), step), dropout)
            hit[open_[out]] = True
            open_ = open_[~out]
        hits = np.flatnonzero(hit)
        _, sizes[hits], drawn = self.segment_all([runs[i] for i in hits.tolist()], keys[hits], dropout)
        starts[hits] = len(self.pool) + np.cumsum(sizes[hits]) - sizes[hits]
        long = np.flatnonzero(known == NONE)
        found = [self.segment_long(runs[i], int(keys[i]), dropout) for i in long.tolist()]
        sizes[long] = [len(ids) for ids in found]
        starts[long] = len(self.pool) + len(drawn) + np.cumsum(sizes[long]) - sizes[long]
        pool = np.concatenate([self.pool, drawn, np.array([*chain.from_iterable(found)], np.int32)])
        ids = pool[ragged(starts, sizes)]
        cuts = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        for start, end in pairwise(cuts.tolist()):
            yield ids[start:end]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        content = b"".join(
            self.byte_pool[ragged(self.byte_starts[own], self.byte_sizes[own])].tobytes()
            for own in (ids[i : i + ENTRIES] for i in range(0, len(ids), ENTRIES))
        )
        return content.decode("utf-8", "replace").removeprefix(" ")


def runs_of(text: str) -> list[str]:
    """Runs of a text that no merge crosses; empty ones stand for blank signs in it."""
    if not text:
        return []
    if BLANK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        # One blank before every run.
        return (BLANK + text.replace(" ", f" {BLANK}")).split(" ")
    runs: list[str] = []
    for k, part in enumerate(text.split(BLANK)):
        if k:
            runs.append("")
        runs += _RUN.findall((BLANK if k == 0 else "") + part.replace(" ", BLANK))
    return runs


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of slices of an array, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def skipped(keys: np.ndarray, steps: np.ndarray, dropout: float) -> np.ndarray:
    """Whether a key skips the candidate of a step, by keyed hash."""
    limit = np.uint64(dropout * (1 << 64) if dropout < 1 else (1 << 64) - 1)
    return _mixed(keys ^ steps.astype(np.uint64) * STEP_FACTOR) < limit


def skips(keys: np.ndarray, first: int, n: int, dropout: float) -> np.ndarray:
    """Whether each key skips the candidate of each of ``n`` steps."""
    return skipped(keys[:, None], np.arange(first + 1, first + n + 1), dropout)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit mix of an array of integers (splitmix64)."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def load(path: str) -> PieceModel:
    return held(("pieces", path), lambda: PieceModel(path))


def encode_documents(
    docs: DataFrame,
    model_path: str,
    seed: int = 1,
    dropout: float = DROPOUT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key`` and ``ids`` (array of int): the text's pieces with merges dropped.

    Every occurrence of a word draws its own skips, by seed, document and place. The
    same seed, key and text give the same ids wherever the row is computed;
    another seed gives another segmentation, and dropout 0 the model's own one.
    Every segmentation decodes to the very text. NULL texts give NULL ids, empty
    ones none; ties of rank go to the left; repeated rows are encoded alike and
    other columns are ignored. The model file must be readable on every node.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            row_keys = [xxhash.xxh64_intdigest(f"{seed}/{k}".encode()) for k in keys]
            texts = batch.column(1).to_pylist()
            found = model.encode_all([content or "" for content in texts], row_keys, dropout)
            values = [None if content is None else ids for content, ids in zip(texts, found, strict=True)]
            ids = pa.array(values, pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), ids], names=[key, "ids"])

    frame = docs.select(key, text)
    kind = frame.schema[key].dataType.simpleString()
    return frame.mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of encoded rows; NULL ids give a NULL text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            texts = [None if ids is None else model.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    frame = encoded.select(key, "ids")
    kind = frame.schema[key].dataType.simpleString()
    return frame.mapInArrow(decode, f"`{key}` {kind}, text string")


def encode_and_check(docs: DataFrame, model_path: str, seed: int = 1, key: str = "doc_id") -> DataFrame:
    """Encoded rows with their number of ids and whether they decode to the text.

    Both directions run on a row while it is in the task, so that its text need
    not be shuffled to meet what was decoded from it.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            contents = [content or "" for content in texts]
            row_keys = [xxhash.xxh64_intdigest(f"{seed}/{k}".encode()) for k in keys]
            values = [*model.encode_all(contents, row_keys, DROPOUT)]
            same = [model.decode(ids) == content for ids, content in zip(values, contents, strict=True)]
            yield pa.record_batch(
                [batch.column(0), pa.array(values, pa.list_(pa.int32())),
                 pa.array([len(v) for v in values], pa.int64()), pa.array(same, pa.bool_())],
                names=[key, "ids", "n_ids", "lossless"],
            )

    frame = docs.select(key, "text")
    kind = frame.schema[key].dataType.simpleString()
    return frame.mapInArrow(check, f"`{key}` {kind}, ids array<int>, n_ids long, lossless boolean")
