"""Label columns: casts, the two-class check, and signs for gradient training."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(label: str) -> Column:
    return F.col(label).cast("double")


def is_binary(label: str) -> Column:
    """True for 0 and 1, false for anything else and for null."""
    return F.coalesce(F.col(label).isin(0, 1), F.lit(False))


def require_binary(label: str) -> Column:
    """The label as double; the job fails on the first row whose label is not 0 or 1."""
    message = F.concat(
        F.lit("labels must be 0 or 1, found "), F.coalesce(F.col(label).cast("string"), F.lit("null"))
    )
    return F.when(is_binary(label), as_double(label)).otherwise(F.raise_error(message))


def require_double(label: str) -> Column:
    """The label as double; the job fails on the first row without one."""
    return F.when(F.col(label).isNull(), F.raise_error(F.lit(f"label {label} is null"))).otherwise(as_double(label))


def as_sign(label: str) -> Column:
    """+1 for a positive label, -1 for another; the job fails on the first row without one."""
    return F.when(require_double(label) > 0, 1.0).otherwise(-1.0)
