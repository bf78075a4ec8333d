"""Language identification: known words first, then shorter and shorter n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import written

#: Longest and shortest character n-grams of the backoff.
LONGEST, SHORTEST = 4, 1
#: Words, and n-grams of each length, kept per language: the most frequent.
KNOWN_WORDS = 20_000
KNOWN_GRAMS = 5_000
#: Log10 factor for each step down to shorter n-grams.
BACKOFF = -0.4
#: Log10 frequency taken where a language has not seen an entry.
UNSEEN = -7.0
#: Labelled texts of a language the model is fitted on, about this many at most:
#: those with the lowest hashes of their ids.
TRAINING_TEXTS = 3_000
#: Counts a task holds before it hands them to Spark; chunks a worker remembers.
HELD = 300_000
REMEMBERED = 500_000
#: Chunks of texts that are looked up together.
GROUPED = 200_000
#: Predicted for texts without letters.
UNDETERMINED = "und"

#: Languages whose shares of the sample are broadcast.
BROADCAST_LANGUAGES = 10_000
#: Maximal runs of letters (no digits or other numerals, no underscore).
LETTERS = regex.compile(r"\p{L}+")


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its boundary marks."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("entry", pa.string()), ("count", pa.int64())])
    held: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            found: dict[int, Counter] = {0: words}
            for n in range(SHORTEST, LONGEST + 1):
                found[n] = Counter()
            for word, count in words.items():
                for n in range(SHORTEST, LONGEST + 1):
                    for gram in grams(word, n):
                        found[n][gram] += count
            for n, counts in found.items():
                yield pa.record_batch(
                    [pa.array([lang] * len(counts)), pa.array([n] * len(counts), pa.int32()),
                     pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                    schema=schema,
                )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
        if sum(map(len, held.values())) > HELD:
            yield from flush()
    yield from flush()


def sampled(rows: DataFrame, key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """About ``TRAINING_TEXTS`` rows of each language, chosen by the hash of the key.

    A language's share is its bound over its number of rows, so a language with
    fewer rows keeps them all. Shares travel as one small row per language, to
    every task unless there are too many of them.
    """
    share = F.least(F.lit(1.0), F.lit(float(TRAINING_TEXTS)) / F.count(F.lit(1)))
    shares = rows.groupBy(F.col(lang).alias("_lang")).agg(share.alias("_share"))
    shares = written(shares, "shares")
    if shares.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES:
        shares = F.broadcast(shares)
    steps = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000)) / 1e6
    return rows.join(shares, F.col(lang) == F.col("_lang")).where(steps < F.col("_share"))


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Log frequencies: ``lang, n, entry, weight``, n = 0 for words.

    Rows with a NULL text or lang teach nothing. What is kept of the counts, the ``KNOWN_WORDS`` most frequent words and ``KNOWN_GRAMS``
    most frequent n-grams of each length per language (ties by the entry), is the
    model's size and bounds it. A weight is log10 of the entry's share of all
    entries of its length in the language.
    """
    labelled = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counted = labelled.mapInArrow(_count, "lang string, n int, entry string, count long")
    sums = counted.groupBy("lang", "n", "entry").agg(F.sum("count").alias("count"))
    return _weights(sums)


def _weights(sums: DataFrame) -> DataFrame:
    """The most frequent entries with their log shares.

    Each (lang, n) is cut down within hashed slices first, so that no task gets
    all words of a language; the slices' leaders then meet.
    """
    slices = F.pmod(F.xxhash64("entry"), F.lit(64))
    most = F.when(F.col("n") == 0, F.lit(KNOWN_WORDS)).otherwise(F.lit(KNOWN_GRAMS))
    order = [F.desc("count"), F.asc("entry")]
    inner = Window.partitionBy("lang", "n", "_slice").orderBy(*order)
    outer = Window.partitionBy("lang", "n").orderBy(*order)
    totals = sums.groupBy("lang", "n").agg(F.sum("count").alias("total"))
    best = (
        sums.withColumn("_slice", slices)
        .withColumn("_rank", F.row_number().over(inner))
        .where((F.col("_rank") <= KNOWN_WORDS) & (F.col("_rank") <= most))
        .withColumn("_rank", F.row_number().over(outer))
        .where((F.col("_rank") <= KNOWN_WORDS) & (F.col("_rank") <= most))
    )
    return best.join(totals, ["lang", "n"]).select(
        "lang", "n", "entry", F.log10(F.col("count") / F.col("total")).alias("weight")
    )


class Detector:
    """Scores texts by the learned weights; remembers the scores of what it met.

    ``words`` and ``grams`` give the rows of ``weights``, a column per language.
    """

    def __init__(self, langs: list[str], words: dict[str, int], grams: dict[str, int], weights: np.ndarray) -> None:
        self.langs, self.words, self.grams = langs, words, grams
        # One more row is what no n-gram is known of.
        self.weights = np.vstack([weights, np.full(len(langs), UNSEEN)])
        self.steps_down = np.zeros(len(self.weights))
        for gram, row in grams.items():
            self.steps_down[row] = BACKOFF * (LONGEST - len(gram))
        self.forget()

    def forget(self) -> None:
        """Empty the memory of chunks: their places, and per place scores and words."""
        self.places: dict[str, int] = {}
        self.scores = np.zeros((4096, len(self.langs) + 1))

    def _gram_rows(self, word: str) -> list[int]:
        """Row of the longest known n-gram that starts at each place of a word."""
        marked, get, last = f"<{word}>", self.grams.get, len(self.weights) - 1
        rows = [get(marked[i : i + LONGEST], last) for i in range(len(marked))]
        if last in rows:
            for i in [i for i, row in enumerate(rows) if row == last]:
                for n in range(min(LONGEST - 1, len(marked) - i), SHORTEST - 1, -1):
                    if (row := get(marked[i : i + n])) is not None:
                        rows[i] = row
                        break
        return rows

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log frequency per language of each word.

        A known word has its own. An unseen one has the mean over its places of
        the longest known n-gram that starts there, ``BACKOFF`` for each step down.
        All unseen words are added up together, place by place.
        """
        known = np.array([self.words.get(word, -1) for word in words], np.int64)
        scores = self.weights[known]
        unseen = np.flatnonzero(known < 0)
        rows = [self._gram_rows(words[i]) for i in unseen.tolist()]
        sizes = np.array([len(r) for r in rows], np.int64)
        # The longest first: those that have a place are the first ones.
        order = np.argsort(-sizes, kind="stable")
        sizes, flat = sizes[order], np.array([row for i in order.tolist() for row in rows[i]], np.int64)
        starts, total = np.cumsum(sizes) - sizes, np.zeros((len(order), len(self.langs)))
        for place in range(sizes[0] if len(sizes) else 0):
            have = np.searchsorted(-sizes, -place)
            at = flat[starts[:have] + place]
            total[:have] += self.weights[at]
            total[:have] += self.steps_down[at, None]
        scores[unseen[order]] = total / np.maximum(sizes, 1)[:, None] + BACKOFF * LONGEST
        return scores

    def _learn(self, chunks: list[str]) -> None:
        """Give each chunk between blanks a place, with the sum of the scores of its words."""
        first = len(self.places)
        self.places.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        while len(self.places) > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
        found = [LETTERS.findall(chunk) for chunk in chunks]
        numbers: dict[str, int] = {}
        flat = np.array([numbers.setdefault(w, len(numbers)) for ws in found for w in ws], np.int64)
        counts = np.array([len(ws) for ws in found], np.int64)
        scores = self.word_scores(list(numbers))
        own, starts = self.scores[first : first + len(chunks)], np.cumsum(counts) - counts
        own[:, -1] = counts
        have, k = np.flatnonzero(counts), 0
        while len(have):
            own[have, :-1] += scores[flat[starts[have] + k]]
            k += 1
            have = have[counts[have] > k]

    def predict(self, text: str) -> tuple[str, float]:
        """Language of one text and its probability."""
        return next(self.predict_all([text]))

    def predict_all(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        """Language and its probability of each text, from the mean scores of its words."""
        parts: list[tuple[int, list[str]]] = []
        held, totals = 0, np.zeros((len(texts), len(self.langs) + 1))
        for i, text in enumerate(texts):
            chunks = text.lower().split()
            for start in range(0, len(chunks), REMEMBERED):
                parts.append((i, chunks[start : start + REMEMBERED]))
                held += len(parts[-1][1])
                if held >= GROUPED:
                    self._add(parts, totals)
                    parts, held = [], 0
        self._add(parts, totals)
        return map(self._best, totals)

    def _add(self, parts: list[tuple[int, list[str]]], totals: np.ndarray) -> None:
        """Add the scores of the chunks of texts to their totals; new chunks are scored together."""
        if len(self.places) >= REMEMBERED:
            self.forget()
        self._learn(list(set().union(*(part for _, part in parts)).difference(self.places)))
        for i, part in parts:
            rows = np.fromiter(map(self.places.__getitem__, part), np.intp, len(part))
            totals[i] += self.scores.take(rows, axis=0).sum(axis=0)

    def _best(self, total: np.ndarray) -> tuple[str, float]:
        words = total[-1]
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        # Words of a text depend on each other: its evidence grows as the root of n.
        evidence = total[:-1] / np.sqrt(words) * np.log(10)
        chances = np.exp(evidence - evidence.max())
        best = int(np.argmax(chances))
        return self.langs[best], float(chances[best] / chances.sum())


def detector(model: DataFrame) -> Detector:
    """The model as tables; at most ``KNOWN_*`` entries per language come to the driver."""
    rows = model.toArrow().to_pydict()
    langs = sorted(set(rows["lang"]))
    place = {lang: i for i, lang in enumerate(langs)}
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    at = [
        (words if n == 0 else grams).setdefault(entry, len(words) + len(grams))
        for n, entry in zip(rows["n"], rows["entry"], strict=True)
    ]
    weights = np.full((len(words) + len(grams), len(langs)), UNSEEN)
    weights[at, [place[lang] for lang in rows["lang"]]] = rows["weight"]
    return Detector(langs, words, grams, weights)


def identify(
    docs: DataFrame, trained_on: Column, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; learned from rows of ``trained_on``.

    The model is fitted on a bounded sample of them, see ``sampled``.

    Predictions see the text alone. NULL texts and texts without letters are
    ``und`` with score 0, as is every text if nothing was learned; ties of scores
    go to the first language in order. Empty tables give no rows. Columns named
    ``lang_pred`` or ``score`` are replaced.
    """
    spark = docs.sparkSession
    labelled = docs.where(trained_on & F.col(text).isNotNull()).select(key, text, lang)
    taught = sampled(labelled, key, lang)
    shared = spark.sparkContext.broadcast(detector(learn(taught, text, lang)))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(batch.schema.names.index(text)).to_pylist()
            found = list(model.predict_all([x or "" for x in column]))
            yield pa.record_batch(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    frame = docs.select(*kept)
    return frame.mapInArrow(predict, _schema(frame, "lang_pred string, score double"))


def _schema(frame: DataFrame, more: str) -> str:
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return f"{own}, {more}"
