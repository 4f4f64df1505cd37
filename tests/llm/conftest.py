from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Nulls, an empty and a blank text, copies, a repeated row, and extra columns that clash with results.
AWKWARD = [
    (7, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n", "en", "a", 3), (5, "one", "en", "a", 3),
    (None, "no id here", "en", "a", 10), (9, "same words in it", "en", "b", 16), (8, "same words in it", None, "b", 16),
    (8, "same words in it", None, "b", 16), (2, "x" * 3000, "de", "a", 3000), (6, "Été, ça va? 漢字 🙂", "fr", "a", 17),
]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from rows, or from texts that get the ids 0, 1, 2, ..."""

    def build(rows, extra: dict | None = None):
        from pyspark.sql import functions as F

        full = [r if isinstance(r, tuple) else (i, r, "en", "s", None if r is None else len(r)) for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, COLUMNS).repartition(3)
        return df.withColumns({name: F.lit(value) for name, value in (extra or {}).items()})

    return build


@pytest.fixture(scope="session")
def awkward(make):
    clashes = dict.fromkeys(["n_tokens", "score", "kept", "length", "piece", "component_id", "n_removed", "fingerprint", "ids", "rank", "offset"], "mine")
    return make(AWKWARD, clashes)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
