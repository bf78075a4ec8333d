"""Small tables with the awkward rows every corpus operator must take."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_words string, kept string, score string"


def prose(seed: int, n: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and to in a is that for it was on with as be by".split()) + (
        f"{rng.randrange(words)}" if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> dict[int, str | None]:
    """Nulls, blanks, copies, near copies, shared passages, a very long text."""
    passage = " ".join(f"shared{i}" for i in range(40))
    rows: dict[int, str | None] = {0: None, 1: "", 2: " \n\t ", 3: "one", 4: "Two words", 5: "x\\y ▁ é 日本 \x1c"}
    rows |= {10 + i: prose(i, 80 + 7 * i) for i in range(12)}
    rows |= {30: rows[12], 31: rows[12], 32: rows[12] + " end", 33: rows[12].upper()}
    rows |= {40: passage + " " + prose(50, 60), 41: prose(51, 60) + " " + passage, 42: passage}
    rows |= {50: "again and again\n" * 60, 51: prose(52, 9000), 52: "a " * 300}
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as rows with clashing column names; one row is repeated."""
    rows = [(i, t, "xy"[i % 2] if i % 7 else None, "s", "n", "k", "z") for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[9]], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
