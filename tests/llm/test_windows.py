"""Concatenated and cut sequences against the tokenizer."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from fareloom.llm import windows
from fareloom.llm.queries import WORD_TOKENIZER, tokenizer_path

PATH = tokenizer_path(WORD_TOKENIZER)


def ids_of(text, end_id=2):
    found = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return np.array([*found, end_id], "<u4")


def check(rows, texts, capacity, end_id=2):
    """Every id in one piece, sequences without gaps, full ones but for powers of two."""
    encoded = {i: ids_of(t, end_id) for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        ids = encoded[row.doc_id]
        assert row.doc_tokens == len(ids)
        assert row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())
        pieces[row.doc_id].append((row.start, row.length))
        sequences[row.sequence_id].append((row.offset, row.length))
    short = []
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
        if at < capacity:
            short.append(at)
    assert len(set(short)) == len(short) and all(x & (x - 1) == 0 for x in short)
    return pieces


@pytest.mark.parametrize(("capacity", "parts"), [(64, 1), (64, 5), (100, 9), (4096, 3)])
def test_every_id_lies_in_one_piece(spark, texts, monkeypatch, capacity, parts):
    monkeypatch.setattr(windows, "BLOCK", 2)
    rows = [(i, t, 1, 2) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part long, tokens long").repartition(parts)
    pieces = check(windows.pack(docs, PATH, capacity).collect(), texts, capacity)
    assert pieces.keys() == texts.keys()
    for doc_id, found in pieces.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(ids_of(texts[doc_id]))


def test_repeated_rows_and_rows_without_id(spark, docs, no_docs, texts):
    more = docs.unionByName(docs.selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_words",
                                            "kept", "score").where("text = 'one'"))
    rows = windows.pack(more, PATH, 128).collect()
    pieces = check(rows, {**texts, None: "one"}, 128)
    repeated = Counter(doc_id for doc_id, found in pieces.items() for start, _ in found if start == 0)
    assert sorted(repeated.values())[-2:] == [1, 2] and repeated[None] == 1
    assert windows.pack(no_docs, PATH).count() == 0


def test_other_capacity_and_end(spark, docs, texts):
    rows = windows.pack(docs, PATH, 50, end_id=70_000).collect()
    check(rows, texts, 50, end_id=70_000)


def test_left_over_is_cut_at_powers_of_two():
    assert list(windows.window_ends(4096 * 3)) == []
    assert [int(x) for x in windows.window_ends(4096 + 11)] == [4096 + 8, 4096 + 10, 4096 + 11]
    assert [int(x) for x in windows.window_ends(5, 8)] == [4, 5]


def test_starts_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK", 8)
    rows = spark.range(1000).selectExpr("id % 97 part", "id tokens")
    totals = Counter()
    for i in range(1000):
        totals[i % 97] += i
    expected, at = {}, 0
    for part in range(97):
        expected[part] = at
        at += totals[part]
    assert {r.part: r.part_start for r in windows.partition_starts(rows).collect()} == expected
