from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = (
    "the quick brown fox jumps over the lazy dog while seven grey geese cross a frozen lake and nobody in the village "
    "looks up from the long table where bread is cut and old letters are read aloud before the lamps go out again"
)


def numbered(seed: int, words: int) -> str:
    """Prose of words that no other seed has."""
    return " ".join(f"{chr(97 + seed % 26)}{(seed * 7919 + i * 104729) % 99991:x}" for i in range(words))


@pytest.fixture
def edge_rows():
    """Nulls in every column, empty and blank texts, repeats, a very long text, controls, scripts."""
    long = " ".join(numbered(i, 400) for i in range(60))
    return [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, None, None, None, None),
        (None, "no id here", "en", None, None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 3),
        (6, "¿Qué? 日本語 🙂  x <|endoftext|> ý", "es", "b", 9), (7, long, "en", "c", 10), (8, "one", None, "c", 3),
    ]


@pytest.fixture
def edge_documents(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCUMENT)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCUMENT))
