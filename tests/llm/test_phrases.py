"""Phrases against counts by brute force."""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fareloom.llm import phrases
from tests.llm.conftest import prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_force(rows, least, top=2000, longest=5, absorb=100):
    """Expected rows from pairs of text and language."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    expected = set()
    for lang, found in counts.items():
        held = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        kept = []
        for phrase, a in held.items():
            around = [
                f for p, f in held.items() if len(p) > len(phrase)
                and any(p[i : i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))
            ]
            if any(100 * f >= absorb * a for f in around):
                continue
            cuts = [(found[phrase[:k]], found[phrase[k:]]) for k in range(1, len(phrase))]
            left, right = min(cuts, key=lambda c: 1000 * a * totals[lang] // (c[0] * c[1]))
            score = 1000 * a * totals[lang] // (left * right)
            kept.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            expected.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return expected


@pytest.fixture(scope="module")
def sentences(texts):
    rows = [(t, "xy"[i % 2] if i % 7 else None) for i, t in texts.items()]
    rows += [(f"New York city, the {prose(i, 30, 5)} New York; CITY hall\tin New York", "en") for i in range(60)]
    rows += [("a a a a a a. a a", "en"), ("é É\x85ß x\x0cy  z\r\nA", "en"), ("word " * 4000, "en"), ("", None)] * 3
    return rows


def frame_of(spark, rows):
    made = [(None, text, lang, "p", 1) for text, lang in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, phrase string, n int")


@pytest.mark.parametrize(("parts", "least"), [(1, 3), (13, 3), (13, 20)])
def test_phrases_equal_brute_force(spark, sentences, monkeypatch, parts, least):
    monkeypatch.setattr(phrases, "CHUNK_CHARS", 3000)
    monkeypatch.setattr(phrases, "UNIT_WORDS", 900)
    docs = frame_of(spark, sentences).repartition(parts)
    found = {tuple(row) for row in phrases.mine(docs, least_count=least).collect()}
    assert found == brute_force(sentences, least) and len(found) > 5


def test_limits_are_parameters(spark, sentences):
    docs = frame_of(spark, sentences)
    found = {tuple(r) for r in phrases.mine(docs, longest=3, least_count=9, top=4, absorb_percent=60).collect()}
    assert found == brute_force(sentences, 9, top=4, longest=3, absorb=60)


def test_large_slices_keep_every_word(spark, sentences, monkeypatch):
    import pyarrow as pa

    texts = pa.array([text or "" for text, _ in sentences])
    whole: dict[str, int] = {}
    stream = phrases.word_stream(texts, whole)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    some: dict[str, int] = {}
    parts = [phrases.word_stream(part, some) for part in phrases.slices(texts)]
    assert len(parts) > 5 and sum(map(len, parts)) == len(stream) and whole == some
    assert [x for part in parts for x in part] == list(stream)


def test_products_beyond_64_bits_stay_exact(spark):
    big = 900_000_000_007
    rows = [("en", "b c", big - 4, 7 * big), ("en", "b", big, 7 * big), ("en", "c", big - 1, 7 * big)]
    (row,) = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, f long, n long")).collect()
    assert row.score == 1000 * (big - 4) * 7 * big // (big * (big - 1))


def test_locally_frequent_phrases_hold_all_frequent_ones(spark, sentences):
    """The local support of a shard never exceeds its share of the least count."""
    chunks = phrases.chunked(frame_of(spark, sentences).repartition(13))
    rows = phrases.with_support(chunks, 20).select("lang", "cell", "lang_words").distinct().collect()
    words = {(r.lang, r.shard): r.n for r in chunks.groupBy("lang", "shard").agg(F.sum("words").alias("n")).collect()}
    supports = defaultdict(int)
    for row in rows:
        shard, support = row.cell >> 32, row.cell & (2**32 - 1)
        assert support == max(1, -(-20 * words[row.lang, shard] // row.lang_words))
        supports[row.lang] += support - 1
    assert len(rows) > phrases.SHARDS and all(n < 20 for n in supports.values())


def test_no_phrases_without_rows(spark, no_docs):
    assert phrases.mine(no_docs).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], "text string, lang string")
    assert phrases.mine(blank).count() == 0
