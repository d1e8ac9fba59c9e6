"""Small tables with every awkward case, shared by the tests of all operators."""

from __future__ import annotations

import random

import pytest

LONG = 30_000  # words of the very long text
CLASHING = "score n_bytes kind digest blob token content component_id held_out spans label text_ bucket"


def sentence(seed: int, words: int, vocabulary: int = 300) -> str:
    """Invented prose, the same for the same seed."""
    chosen = random.Random(seed)
    return " ".join(f"w{chosen.randrange(vocabulary)}{'.' if k % 9 == 8 else ''}" for k in range(words))


@pytest.fixture(scope="session")
def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empties, repeats, ties, one long text."""
    texts = {
        1: sentence(1, 80), 2: sentence(1, 80), 3: "", 4: None, 5: "   \n\t ", 6: "ok",
        7: sentence(2, LONG, 5000), 8: "Ünïcödé — ñandú ✓ 中文", 9: "a" * 5000,
        10: sentence(1, 79) + " changed", 11: "\x00 odd \x1c control\u0085", 12: "??? 123 --",
    }
    rows = [(k, t, "en" if k % 2 else None, "s", None) for k, t in texts.items()]
    rows.append(rows[0])  # a repeated row
    rows.append((None, sentence(3, 20), "en", None, 1))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward_rows, SCHEMA)
    return docs.withColumns({c: F.lit("clash") for c in CLASHING.split()})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def make_docs(spark):
    def make(texts) -> object:
        items = texts.items() if isinstance(texts, dict) else enumerate(texts)
        return spark.createDataFrame([(k, t, None, None, None) for k, t in items], SCHEMA)

    return make
