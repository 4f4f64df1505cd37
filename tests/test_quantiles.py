"""Exact quantiles against their definition."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import quantiles
from clickloom.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("rows, parts, ties", [(1, 2, 1), (7, 100, 1), (100, 100, 1), (1000, 7, 1), (1003, 100, 300), (500, 3, 499)])
def test_cuts_are_the_smallest_values_with_their_share(spark, rows, parts, ties):
    values = np.floor(np.random.default_rng(rows).permutation(rows) / ties)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = np.sort(values)
    assert exact_quantiles(df, "x", parts) == [ordered[(i * rows + parts - 1) // parts - 1] for i in range(1, parts)]


def test_a_value_is_not_held_against_every_cut(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("cuts are looked through for each value")

    monkeypatch.setattr(quantiles.F, "filter", refuse)
    assert exact_quantiles(spark.range(1000).select(F.col("id").cast("double").alias("x")), "x", 10) == [float(i * 100 - 1) for i in range(1, 10)]
