"""Quantile bucketing with approximate or exact cuts."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol, HasRelativeError
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.running import chunks_for, totals_before, with_chunks
from clickloom.session import cached


def exact_quantiles(df: DataFrame, column: str, parts: int) -> list[float]:
    """For i in 1..parts-1, the smallest value with at least i/parts of the rows at or below it.

    Equal values are counted before any shuffle. Ranks then come from chunked running totals, so
    neither a task nor the driver ever holds the column; the driver sees ``parts - 1`` values.
    """
    values = df.select(F.col(column).cast("double").alias("value")).filter("value IS NOT NULL AND NOT isnan(value)")
    rows = values.count()
    if rows == 0:
        raise ValueError(f"no values to cut in column {column}")
    counted = values.groupBy("value").agg(F.count("*").alias("n"))
    # The 0-based position of the i-th cut is ceil(i * rows / parts) - 1, so a value holds the cuts with
    # before * parts < i * rows <= (before + n) * parts: two whole divisions, whatever the number of parts.
    first, last = F.expr(f"before * {parts}L div {rows}L + 1"), F.least(F.lit(parts - 1).cast("long"), F.expr(f"(before + n) * {parts}L div {rows}L"))
    with cached(counted):
        chunked = with_chunks(counted, ["value"], chunks_for(rows))
        ranked = totals_before(chunked, ["value"], [((), {"before": F.col("n")})])
        held = ranked.select("value", first.alias("first"), last.alias("last")).filter("first <= last")
        found = held.select("value", F.explode(F.sequence("first", "last")).alias("cut")).collect()
    by_cut = {r["cut"]: r["value"] for r in found}
    return [by_cut[i] for i in range(1, parts)]


class QuantileCuts(
    Estimator, HasInputCol, HasOutputCol, HasRelativeError, HasHandleInvalid,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Learns quantile cuts and returns a ``Bucketizer``; repeated cuts collapse.

    With ``relativeError`` above 0 the cuts come from Spark's quantile sketch. With 0 they are
    exact, found by a distributed count instead of a sketch that would keep every value.
    """

    numBuckets = Param(Params._dummy(), "numBuckets", "largest number of buckets, at least 2", TypeConverters.toInt)

    def __init__(
        self,
        inputCol: str | None = None,
        outputCol: str | None = None,
        numBuckets: int = 100,
        relativeError: float = 0.001,
        handleInvalid: str = "error",
    ):
        super().__init__()
        if numBuckets < 2:
            raise ValueError("numBuckets must be at least 2")
        if not 0 <= relativeError <= 1:
            raise ValueError("relativeError must be in [0, 1]")
        self._set(numBuckets=numBuckets, relativeError=relativeError, handleInvalid=handleInvalid)
        if inputCol is not None:
            self._set(inputCol=inputCol)
        if outputCol is not None:
            self._set(outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> Bucketizer:
        parts = self.getOrDefault("numBuckets")
        column, error = self.getInputCol(), self.getRelativeError()
        if error > 0:
            cuts = dataset.approxQuantile(column, [i / parts for i in range(1, parts)], error)
        else:
            cuts = exact_quantiles(dataset, column, parts)
        splits = sorted({float("-inf"), *cuts, float("inf")})
        return Bucketizer(
            splits=splits, inputCol=column, outputCol=self.getOutputCol(), handleInvalid=self.getHandleInvalid()
        )
