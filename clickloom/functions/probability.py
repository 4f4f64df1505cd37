"""Probability columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def click_probability(probability: str = "probability") -> Column:
    """P(click) out of a two-class probability vector."""
    return vector_to_array(F.col(probability))[1]


def two_class(p: Column) -> Column:
    """The vector [1 - p, p]."""
    return array_to_vector(F.array(1.0 - p, p))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))
