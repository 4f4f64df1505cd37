"""Tables between steps: written to the shared folder, and sent to all executors only by counted size."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import scratch_path

BROADCAST_ROWS, BROADCAST_ELEMENTS = 300_000, 1_500_000


# Paths of tables that go when the running step has its result.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def tidied(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``step``, after which the tables it stored are deleted, but for lasting ones: its result may read those alone."""

    @wraps(step)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        token = _PASSING.set([])
        try:
            return step(docs, *args, **options)
        finally:
            for path in _PASSING.get():
                _delete(docs.sparkSession, path)
            _PASSING.reset(token)

    return run


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """The table as read back from the shared folder: what follows neither repeats nor renumbers it.

    Within a step that is ``tidied`` it goes at the end, unless it is ``lasting``.
    """
    path = scratch_path(df.sparkSession, name)
    if not lasting and _PASSING.get() is not None:
        _PASSING.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def lasting(df: DataFrame, name: str) -> DataFrame:
    """Like ``stored``, and not deleted at the end of a step."""
    return stored(df, name, lasting=True)


def small(df: DataFrame, array: str | None = None) -> DataFrame:
    """A stored table, to be broadcast if its rows (and elements of ``array``) are counted to be few.

    A larger one is left to a shuffle join, which gives the same rows.
    """
    elements = F.sum(F.size(array)) if array else F.lit(0)
    rows, held = df.agg(F.count("*"), elements).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_ELEMENTS else df
