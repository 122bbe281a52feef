from __future__ import annotations

from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"

#: Rows with every awkward value: nulls, empty, short, long and repeated texts, and columns whose names clash.
ODD = [
    (1, "Some words are here, and more words follow them in a line.", "en", "a", 7),
    (1, "Some words are here, and more words follow them in a line.", "en", "a", 7),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t ", "de", None, 6),
    (5, "!!! *** ???", "de", "b", 11),
    (6, "word " * 30_000, "en", "a", 150_000),
    (7, "x" * 20_000, "fr", "b", 20_000),
    (8, "ÄÖÜ straße ΣΑΣ 日本語 😀 \x1cend's", None, "c", 20),
    (None, "No id but words that count all the same.", "en", "c", 40),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, score double, word string, key long, size int, hash long"


@pytest.fixture(scope="session")
def sf() -> str:
    if not Path(SF).exists():
        pytest.skip("no test data")
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 0.5, "w", 3, 4, 5) for r in ODD], ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
