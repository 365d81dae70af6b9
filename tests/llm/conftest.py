from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf() -> str:
    return SMALL


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, row string, part string, kept string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with names the operators use."""
    long_text = " ".join(f"word{i % 997}x{i}" for i in range(60_000))
    same = "one two three four five six seven eight nine ten " * 8
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "", 4),
        (4, long_text, "en", "a", len(long_text)),
        (5, "x" * 300_000, "de", "a", 300_000),
        (6, same, "en", "b", len(same)),
        (6, same, "en", "b", len(same)),
        (7, same, "en", "b", len(same)),
        (None, "no id here at all", "fr", "b", 17),
        (None, "no id here at all", "fr", "b", 17),
        (2**62, "ünïcödé 😀 <|endoftext|> <|END|> don't stop", None, None, 3),
        (-5, "!!! ??? 123", "es", "c", 11),
    ]
    return spark.createDataFrame([(*r, "s", "r", "p", "k") for r in rows], ODD_SCHEMA).coalesce(2)
