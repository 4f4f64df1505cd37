"""Tables between steps: those that only a step reads go with it."""

from __future__ import annotations

from pathlib import Path

import pytest

from clickloom.llm import near_dedup, substring_dedup
from clickloom.llm.storage import stored, tidied
from clickloom.session import shared_dir


def kept_tables(spark, before: set[str]) -> set[str]:
    found = {p.name for p in Path(shared_dir(spark).removeprefix("file:"), "clickloom").glob("*")}
    return {name.rsplit("-", 1)[0] for name in found - before}


def names(spark) -> set[str]:
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:"), "clickloom").glob("*")}


def test_only_what_a_result_reads_stays(spark):
    docs = spark.createDataFrame([(n, " ".join(f"w{(n % 3) * 100 + k}" for k in range(80))) for n in range(9)], "doc_id long, text string")
    before = names(spark)
    parts = near_dedup.component_ids(docs)
    assert kept_tables(spark, before) == {"components", "sizes"}
    assert {r.doc_id: r.component_id for r in parts.collect()} == {n: n % 3 for n in range(9)}
    before = names(spark)
    spans = substring_dedup.repeated_spans(docs)
    assert kept_tables(spark, before) == {"spans"}
    assert {r.doc_id for r in spans.collect()} == set(range(3, 9))


def test_a_step_that_fails_leaves_nothing(spark):
    before = names(spark)

    @tidied
    def failing(docs):
        stored(docs, "failing")
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        failing(spark.range(3))
    assert kept_tables(spark, before) == set()
