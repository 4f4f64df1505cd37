"""Factorization machines whose weights are a table: scoring and training as joins and sums.

Weights are rows (position, linear, factors). They meet the active entries of the rows by position, broadcast if
they are counted to be few and joined otherwise; sums by row give the scores, sums by position the
gradient. No task and no driver holds all weights, so the width is bound by storage alone.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from uuid import uuid4

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.labels import as_sign, require_double
from clickloom.functions.probability import clamp, sigmoid
from clickloom.operators.active import active
from clickloom.operators.fm_math import CLASSIFICATION
from clickloom.session import materialise, small

_META = "num_factors int, bias double, task int, low double, high double"
#: The bias is the weight of a feature that every row has with value 1.
_BIAS = -1


@dataclass(frozen=True)
class WeightTable:
    """``rows`` has ``position`` int, ``linear`` double, ``factors`` array<double>; a position without row has no weight."""

    rows: DataFrame
    num_factors: int
    bias: float = 0.0
    task: int = CLASSIFICATION
    low: float = float("-inf")
    high: float = float("inf")

    @classmethod
    def of_model(cls, spark: SparkSession, model) -> WeightTable:
        """The weights of a fitted ``FactorizationMachineModel``."""
        linear = np.zeros(model.num_features) if model.linear is None else model.linear
        rows = [(i, float(w), v) for i, (w, v) in enumerate(zip(linear, model.factors.tolist()))]
        table = spark.createDataFrame(rows, "position int, linear double, factors array<double>")
        return cls(table, model.num_factors, model.bias, model.getOrDefault("task"), model.low, model.high)

    @classmethod
    def initial(cls, positions: DataFrame, num_factors: int, std: float, seed: int, **settings) -> WeightTable:
        """Factors drawn from N(0, std) by a hash of seed, position and factor; linear weights are 0."""

        def uniform(salt: int, factor: int) -> Column:
            return (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.lit(factor), "position"), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))

        normal = lambda f: F.sqrt(-2.0 * F.log(uniform(1, f))) * F.cos(2.0 * np.pi * uniform(2, f)) * std
        factors = F.array(*[normal(f) for f in range(num_factors)]).alias("factors")
        return cls(positions.select("position", F.lit(0.0).alias("linear"), factors), num_factors, **settings)

    def save(self, path: str) -> None:
        self.rows.write.parquet(f"{path}/weights")
        meta = [(self.num_factors, self.bias, self.task, self.low, self.high)]
        self.rows.sparkSession.createDataFrame(meta, _META).coalesce(1).write.parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WeightTable:
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls(spark.read.parquet(f"{path}/weights"), meta["num_factors"], meta["bias"], meta["task"], meta["low"], meta["high"])


def _factors(k: int) -> list[str]:
    return [f"v{f}" for f in range(k)]


def _wide(weights: WeightTable) -> DataFrame:
    """A column for each factor, and the sum of their squares."""
    squares = F.aggregate("factors", F.lit(0.0), lambda s, v: s + v * v).alias("square")
    each = [F.get("factors", f).alias(name) for f, name in enumerate(_factors(weights.num_factors))]
    return weights.rows.select("position", "linear", *each, squares)


def _sums(k: int) -> list[Column]:
    """The parts of a row's score, over its entries joined to their weights."""
    total = lambda e, name: F.coalesce(F.sum(e), F.lit(0.0)).alias(name)
    x = F.col("value")
    each = [total(x * F.col(v), f"s{f}") for f, v in enumerate(_factors(k))]
    return [total(x * F.col("linear"), "lin"), *each, total(x * x * F.col("square"), "quad")]


def _raw(k: int, bias: float) -> Column:
    squared = sum((F.col(f"s{f}") * F.col(f"s{f}") for f in range(1, k)), F.col("s0") * F.col("s0"))
    return F.lit(float(bias)) + F.col("lin") + 0.5 * (squared - F.col("quad"))


def score_table(df: DataFrame, weights: WeightTable, features: str = "features", key: str | None = None, output: str = "ctr") -> DataFrame:
    """The rows of ``df`` with ``output``: P(click), or for a regression the prediction within the label range.

    ``key`` names a column that is unique and never null. Without one the table is stored once under row
    numbers. A row without active entries has the bias alone; positions without weight count nothing. The
    shuffle has one row for each row of ``df``, since the entries of a row lie together and are summed first,
    unless the weights are too many to broadcast.
    """
    own = df
    if key is None:
        key = "_row"
        own = materialise(df.withColumn(key, F.monotonically_increasing_id()), "rows-to-score")
    entries = own.select(F.col(key).alias("_key"), F.explode_outer(active(own, features)).alias("entry")).select("_key", "entry.position", "entry.value")
    sums = entries.join(small(_wide(weights)), "position", "left").groupBy("_key").agg(*_sums(weights.num_factors))
    raw = _raw(weights.num_factors, weights.bias)
    value = sigmoid(raw) if weights.task == CLASSIFICATION else clamp(raw, weights.low, weights.high)
    scored = sums.select("_key", value.alias("_score"))
    kept = [own[f"`{c}`"] for c in df.columns if c != output]
    score = F.when(own[key].isNull(), F.raise_error(F.lit(f"key {key} is null"))).otherwise(scored["_score"])
    return own.join(scored, own[key] == scored["_key"], "left").select(*kept, score.alias(output))


def gradient_table(rows: DataFrame, weights: WeightTable) -> DataFrame:
    """Summed gradient by position, without penalties, from ``rows`` of (key, y, entries).

    Columns ``position``, ``linear``, ``factors``. Position -1 is the bias, and has ``loss`` and ``n`` (rows) as well.
    """
    k = weights.num_factors
    entries = rows.select("key", "y", F.explode_outer("entries").alias("entry")).select("key", "y", "entry.position", "entry.value")
    joined = entries.join(small(_wide(weights)), "position", "left")
    own = F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "value"))).alias("entries")
    rowwise = joined.groupBy("key").agg(F.first("y").alias("y"), *_sums(k), own).withColumn("raw", _raw(k, weights.bias))
    if weights.task == CLASSIFICATION:
        margin = F.col("y") * F.col("raw")
        # ln(1 + exp(-m)) without overflow.
        loss = F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
        pull = -F.col("y") / (1.0 + F.exp(margin))
    else:
        pull = clamp(F.col("raw"), weights.low, weights.high) - F.col("y")
        loss = 0.5 * pull * pull
    bias = F.struct(F.lit(_BIAS).alias("position"), F.lit(1.0).alias("value"))
    spread = rowwise.select(loss.alias("loss"), pull.alias("pull"), *[f"s{f}" for f in range(k)], F.explode(F.array_append("entries", bias)).alias("entry"))
    x, p = F.col("entry.value"), F.col("pull")
    by_position = spread.groupBy(F.col("entry.position").alias("position")).agg(
        F.sum(p * x).alias("linear"), F.sum(p * x * x).alias("own"), *[F.sum(p * x * F.col(f"s{f}")).alias(f"t{f}") for f in range(k)],
        F.sum("loss").alias("loss"), F.count("*").alias("n"),
    )
    held = by_position.join(small(_wide(weights)).drop("linear", "square"), "position", "left")
    each = [F.col(f"t{f}") - F.coalesce(v, F.lit(0.0)) * F.col("own") for f, v in enumerate(_factors(k))]
    is_bias = F.col("position") == _BIAS
    return held.select("position", "linear", F.array(*each).alias("factors"), F.when(is_bias, F.col("loss")).alias("loss"), F.when(is_bias, F.col("n")).alias("n"))


def training_rows(df: DataFrame, features: str, label: str, task: int) -> DataFrame:
    """(key, y, entries), stored: what each step of a training reads."""
    y = as_sign(label) if task == CLASSIFICATION else require_double(label)
    return materialise(df.select(F.monotonically_increasing_id().alias("key"), y.alias("y"), active(df, features).alias("entries")), "training-rows")


class _Log:
    """Steps that are done: each with its stored weights. Entered last, so that a half-written step is never read."""

    schema = "step long, path string, bias double, loss double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def steps(self) -> list:
        try:
            return sorted(self.spark.read.schema(self.schema).parquet(f"{self.path}/log").collect(), key=lambda r: r["step"])
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def add(self, step: int, rows: DataFrame, bias: float, loss: float) -> DataFrame:
        target = f"{self.path}/weights-{uuid4().hex}"
        rows.write.parquet(target)
        self.spark.createDataFrame([(step, target, bias, loss)], self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return self.spark.read.parquet(target)


def train_table(
    rows: DataFrame, start: WeightTable, steps: int, step_size: float, path: str,
    reg_bias: float = 0.0, reg_linear: float = 0.0, reg_factors: float = 0.0,
) -> tuple[WeightTable, list[float]]:
    """Gradient descent with step ``step_size / sqrt(step)`` from ``start``; also the objective's loss before each step.

    ``rows`` comes from ``training_rows``. Each step's weights are a table under ``path``, a folder on shared
    storage; a training that was cut off goes on after its last whole step when it is called again with the
    same arguments. The driver sees the bias, the loss and the number of rows. ``start`` lists the positions
    to train; entries at other positions count nothing.
    """
    log = _Log(rows.sparkSession, path)
    done = log.steps()
    weights, history = start, [r["loss"] for r in done]
    if done:
        weights = replace(start, rows=rows.sparkSession.read.parquet(done[-1]["path"]), bias=done[-1]["bias"])
    for step in range(len(done) + 1, steps + 1):
        gradient = materialise(gradient_table(rows, weights), "gradient")
        whole = gradient.filter(F.col("position") == _BIAS).first()
        if whole is None:
            raise ValueError("no rows to train on")
        n, rate = whole["n"], step_size / np.sqrt(step)
        moved = lambda w, g, reg: w - rate * (F.coalesce(g, F.lit(0.0)) / n + reg * w)
        given = gradient.select("position", F.col("linear").alias("g_linear"), F.col("factors").alias("g_factors"))
        factors = F.transform("factors", lambda w, f: moved(w, F.get("g_factors", f), reg_factors))
        joined = weights.rows.join(given, "position", "left").select("position", moved(F.col("linear"), F.col("g_linear"), reg_linear).alias("linear"), factors.alias("factors"))
        bias = float(weights.bias - rate * (whole["linear"] / n + reg_bias * weights.bias))
        history.append(whole["loss"] / n)
        weights = replace(weights, rows=log.add(step, joined, bias, history[-1]), bias=bias)
    return weights, history
