"""Fill-in-middle examples against a cut by lists of units."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fareloom.llm import infill


def expected(doc_id, text, plain_percent=10, spm_percent=20, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain_percent:
        return len(units), "plain", text, None, None
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_percent:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


@pytest.fixture(scope="module")
def rows(texts):
    rows = dict(texts) | {100 + i: "<P" * (i % 5) + f"ab{i} <S <M\n>>" + "S>" * (i % 3) for i in range(60)}
    rows |= {200: "a <M> b", 201: "<S>", 202: "x<P>", 203: "\\1 $1 ${a} \\E", 204: "\U0001f600é́a" * 50}
    rows |= {300 + i: "q w" * i for i in range(40)} | {400: "ab, " * 300_000, 401: "z" * 1_000_000, 402: "\n" * 400_000}
    return rows


@pytest.mark.parametrize(("plain", "spm"), [(10, 20), (0, 50), (100, 0)])
def test_examples_equal_brute_force(spark, rows, plain, spm):
    made = [(i, t, "n", 1, "o") for i, t in rows.items()]
    docs = spark.createDataFrame([*made, made[12]], "doc_id long, text string, n string, form int, output string")
    examples = infill.fill_in_middle(docs.repartition(3), plain_percent=plain, spm_percent=spm)
    found = examples.select(
        "*", infill.restored(F.col("output"), F.col("form")).alias("restored"),
    ).collect()
    assert len(found) == len(made) + 1
    measured = {r.doc_id: r for r in infill.measured(examples).collect()}
    for row in found:
        n, form, output, prefix, middle = expected(row.doc_id, rows[row.doc_id], plain, spm)
        assert (row.n, row.form, row.output) == (n, form, output)
        assert row.restored == (rows[row.doc_id] or "")
        told = measured[row.doc_id]
        assert (told.prefix_chars, told.middle_chars) == (prefix, middle)
        assert told.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert told.restored_sha256 == hashlib.sha256((rows[row.doc_id] or "").encode()).hexdigest()
    assert {r.form for r in found} == ({"plain"} if plain == 100 else {"plain", "psm", "spm"})


def test_keys_of_any_kind(spark, no_docs):
    docs = spark.createDataFrame([(None, "a b c d"), ("k1", "a b c d")], "name string, body string")
    found = infill.fill_in_middle(docs, "name", "body", seed=4, plain_percent=0).collect()
    for row in found:
        assert (row.n, row.form, row.output) == expected(row.name, "a b c d", 0, 20, 4)[:3]
    assert infill.measured(infill.fill_in_middle(no_docs)).count() == 0


def test_nothing_is_shuffled(docs):
    plan = infill.measured(infill.fill_in_middle(docs.select("doc_id", "text")))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Aggregate" not in text
