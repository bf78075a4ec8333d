"""Sampled and learned results against plain versions of their methods."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import languages, lm, pieces, quality
from fareloom.llm.common import crc_fold
from fareloom.llm.queries import PIECE_MODEL, tokenizer_path
from tests.llm.conftest import prose


def _plain_agenda(model, whole: str, key: int, dropout: float) -> list[int]:
    """Merges one by one, each candidate with a hash of its own."""
    parts, out, step = [(i, c) for i, c in enumerate(whole)], set(), 0
    while True:
        offers = [
            (model.ranks[a[1] + b[1]], a[0], i)
            for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
            if a[1] + b[1] in model.ranks and (a, b) not in out
        ]
        if not offers:
            return list(model._ids([p for _, p in parts]))
        i = min(offers)[2]
        skip = bool(pieces.skips(np.array([key], np.uint64), step, 1, dropout)[0, 0])
        step += 1
        if skip:
            out.add((parts[i], parts[i + 1]))
        else:
            parts[i : i + 2] = [(parts[i][0], parts[i][1] + parts[i + 1][1])]


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_dropout_equals_a_plain_agenda(dropout):
    model = pieces.PieceModel(tokenizer_path(PIECE_MODEL))
    listed = ["internationalization", "a", "Ünïcode", "the", "counterrevolutionaries" * 2, "x" * 90, "of"] * 12
    row = 2**64 - 5  # keys wrap
    keys = pieces._mixed(np.arange(len(listed), dtype=np.uint64) + np.uint64(row))
    expected = [i for k, w in zip(keys.tolist(), listed, strict=True) for i in _plain_agenda(model, "▁" + w, k, dropout)]
    for _ in range(2):  # computed, then remembered
        assert model.encode(" ".join(listed), row, dropout) == expected


def test_occurrences_of_a_word_are_segmented_each_by_itself(spark):
    model = pieces.PieceModel(tokenizer_path(PIECE_MODEL))
    word = "internationalization"
    frame = spark.createDataFrame([(i, word) for i in range(2000)], "doc_id long, text string")
    found = Counter(tuple(r.ids) for r in pieces.encode_documents(frame, tokenizer_path(PIECE_MODEL)).collect())
    steps, whole = model.segment("▁" + word, 0)
    # Those that skip no step stay whole, and some that do; the others differ.
    assert 0.9**steps - 0.04 < found[whole] / 2000 < 0.7
    assert len(found) > 50


def _distance(p, q) -> float:
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
    return math.sqrt(max(sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)) / 2, 0.0))


def _shares(text: str) -> tuple[list[float], list[float]]:
    def kind(c: str) -> int:
        if "a" <= c <= "z":
            return 0
        if "A" <= c <= "Z":
            return 1
        if "0" <= c <= "9":
            return 2
        if c.isalpha():
            return 3
        if c in "\t\n\x0b\x0c\r ":
            return 4
        return 5 if c in ".,;:!?'\"()-" else 6

    chars = Counter(map(kind, text))
    words = [w.decode().lower() for w in text.encode().split()]
    bins = Counter(w if w in quality.WORD_BINS else None for w in words)
    return (
        [chars[k] / len(text) for k in range(7)],
        [bins[k] / len(words) for k in [*quality.WORD_BINS, None]],
    )


def test_distances_and_verdicts_equal_a_plain_version(spark):
    rows = [(i, prose(i, 90 + i) + " Zwölf, (12) % été" * (i % 5), "xx") for i in range(30)]
    rows += [(100 + i, " ".join(f"{w.upper()}!" for w in prose(i, 70).split()), "yy") for i in range(25)]
    rows += [(200, "#%&* 999 " * 40 + " ".join(f"{i}" for i in range(200)), "xx"), (201, prose(3, 49), "xx")]
    rows += [(202, " ".join(f"<{i}>" for i in range(80)), "rare"), (203, " ".join(f"<{i}>" for i in range(80)), None)]
    frame = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, _row string, _number string"
    )
    shares = {i: _shares(t) for i, t, _ in rows}
    by_lang = defaultdict(list)
    for i, text, lang in rows:
        if lang and len(text.split()) >= quality.LEAST_WORDS:
            by_lang[lang].append(shares[i])
    means = {
        lang: [np.mean([s[k] for s in listed], axis=0) for k in (0, 1)]
        for lang, listed in by_lang.items()
        if len(listed) >= quality.LEAST_TEXTS
    }
    assert set(means) == {"xx", "yy"}
    kept = set()
    for row in quality.judge(frame).collect():
        near = [min(_distance(shares[row.doc_id][k], mean[k]) for mean in means.values()) for k in (0, 1)]
        assert (row.char_distance, row.word_distance) == pytest.approx(near, abs=1e-6)
        far = near[0] > quality.MOST_CHAR_DISTANCE or (near[0] > quality.RATHER_FAR[0] and near[1] > quality.RATHER_FAR[1])
        compared = row.n_words >= quality.LEAST_WORDS and row.lang in {*means, None}
        assert row.kept == (not row.base_failed and not (compared and far))
        kept |= {row.doc_id} if row.kept else set()
    assert {200, 201, 203}.isdisjoint(kept) and {202, *range(30)} <= kept
    left = quality.passing(frame)
    assert left.columns == frame.columns
    assert {(r.doc_id, r._row, r._number) for r in left.collect()} == {(i, "x", "y") for i in kept}
    assert {r.doc_id for r in quality.judge(frame, keep=["doc_id"]).where("kept").collect()} == kept


def test_backoff_equals_a_plain_version(spark):
    rows = [(i, prose(i, 30), "en") for i in range(20)] + [(50 + i, "und der die haus " * 4 + f"baum{'x' * i}", "de") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = {(r.lang, r.n, r.entry): r.weight for r in languages.learn(frame).collect()}
    langs = ["de", "en"]

    def word_score(word: str, lang: str) -> float:
        if any((k, 0, word) in model for k in langs):
            return model.get((lang, 0, word), languages.UNSEEN)
        marked, total = f"<{word}>", 0.0
        for i in range(len(marked)):
            for n in range(languages.LONGEST, 0, -1):
                gram = marked[i : i + n]
                if len(gram) == n and any((k, n, gram) in model for k in langs):
                    total += model.get((lang, n, gram), languages.UNSEEN) + languages.BACKOFF * (languages.LONGEST - n)
                    break
            else:
                total += languages.UNSEEN
        return total / len(marked) + languages.BACKOFF * languages.LONGEST

    detector = languages.detector(languages.learn(frame))
    for text in ("the haus and thx", "unders, häuser2und q", "Der baumxxx DIE of", "zzz"):
        words = languages.LETTERS.findall(text.lower())
        sums = [sum(word_score(w, lang) for w in words) / math.sqrt(len(words)) for lang in langs]
        chances = [10 ** (s - max(sums)) for s in sums]
        lang, score = detector.predict(text)
        assert lang == langs[int(np.argmax(chances))]
        assert score == pytest.approx(max(chances) / sum(chances), rel=1e-9)


def test_scores_do_not_depend_on_the_partitions(spark, docs):
    held = crc_fold(F.col("doc_id"), 7) == 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions in (2, 24):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            found.append(sorted((r.doc_id, r.score) for r in lm.score(docs, held).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_piece_keys_are_hashes():
    flags = pieces.skips(np.array([xxhash.xxh64_intdigest(b"%d" % i) for i in range(4000)], np.uint64), 0, 16, 0.1)
    assert np.abs(flags.mean(axis=0) - 0.1).max() < 0.02
