"""Converters for ``Param`` that also refuse values out of range, at the moment they are set."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml.param import TypeConverters


def _checked(convert: Callable[[Any], Any], accept: Callable[[Any], bool], expected: str) -> Callable[[Any], Any]:
    def converter(value: Any) -> Any:
        converted = convert(value)
        if not accept(converted):
            # Params turns TypeError into its own message and lets ValueError through.
            raise ValueError(f"expected {expected}, got {value!r}")
        return converted

    return converter


def at_least(low: float, convert: Callable = TypeConverters.toFloat) -> Callable[[Any], Any]:
    return _checked(convert, lambda v: v >= low, f"a number >= {low}")


def between(
    low: float, high: float, convert: Callable = TypeConverters.toFloat, open_low: bool = False
) -> Callable[[Any], Any]:
    if open_low:
        return _checked(convert, lambda v: low < v <= high, f"a number in ({low}, {high}]")
    return _checked(convert, lambda v: low <= v <= high, f"a number in [{low}, {high}]")


def one_of(*allowed: Any, convert: Callable) -> Callable[[Any], Any]:
    return _checked(convert, lambda v: v in allowed, f"one of {allowed}")


positive = _checked(TypeConverters.toFloat, lambda v: v > 0, "a number > 0")
positive_whole = _checked(TypeConverters.toInt, lambda v: v >= 1, "a whole number >= 1")
