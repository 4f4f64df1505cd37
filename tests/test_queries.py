"""Every query that has a SQL text returns that text's rows."""

from __future__ import annotations

import inspect

import pytest
from conftest import TINY

import __spark_entry__ as entry_points
from verification import queries as catalogue
from verification.compare import differences, tables
from verification.oracles import ORACLES
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return tables(TINY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, TINY).toPandas()
    assert len(ours) > 0
    assert differences(ours, duck.execute(ORACLES[name]).df()) == ""


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    out = entry_points.entry(spark)
    assert out.columns == ["event_id", "user_id", "item_id", "label_planted", "ctr", "auc_roc", "auc_pr"]
    row = out.first()
    assert 0 <= row["ctr"] <= 1 and 0.5 < row["auc_roc"] <= 1


def test_random_samples_keep_their_promise(spark):
    split = QUERIES["random_split"](spark, TINY)
    assert split.select("event_id").distinct().count() == split.count() == 1000
    assert 0 < QUERIES["mini_batch"](spark, TINY).count() < 300


def test_no_query_cuts_its_input_short():
    source = inspect.getsource(catalogue)
    assert ".limit(" not in source and ".sample(" not in source and ".head(" not in source


def test_regression_moments_are_given_and_those_of_the_labels(spark):
    rows = {r.position: r for r in QUERIES["lr_moments"](spark, TINY).collect()}
    # The observed sum over 1,000 rows, rounded half up, is the moment that the fitted probabilities give.
    assert {p: r.moment for p, r in rows.items()} == {p: int(r.observed + 0.5 + 1e-9) / 1000 for p, r in rows.items()}
    assert len(rows) == 15 and all(r.met for r in rows.values())
