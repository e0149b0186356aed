"""Tables of odd rows for every operator over documents."""

import importlib.util
from pathlib import Path

import pytest

# both folders' files are imported as "conftest"; whichever stays has the helpers of the tests above
_spec = importlib.util.spec_from_file_location("shared_conftest", Path(__file__).parents[1] / "conftest.py")
_shared = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_shared)
SMALL, at, day = _shared.SMALL, _shared.at, _shared.day

DOCS = "doc_id long, text string, lang string, source string, n_chars int, kept string, row int, size int, _key int, _copies int, text_hash int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns named like inner ones."""
    words = "the quick brown fox jumps over a lazy dog and runs away from it all".split()
    long = " ".join(words[(i * i + i // 7) % len(words)] + str(i % 97) for i in range(30000))
    texts = [(None, None), (1, None), (2, ""), (3, ""), (4, " "), (5, "one two"), (6, "ONE two"), (7, "éa Öb"), (8, "ÉA Öb"), (9, long),
             (10, long + " tail"), (11, "x" * 70000), (12, "one two three four five six"), (12, "one two three four five six"),
             (None, "one two three four five six"), (None, None), (13, "12345 ?! ..."), (14, "a\0b\1c")]
    rows = [(i, t, ("en", "fr", None)[k % 3], ("b", None, "a")[k % 3], None, "x", k, None, k, k, k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
