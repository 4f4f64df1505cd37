"""Factorization machines trained by gradient descent or L-BFGS, with three separate penalties.

The rows are packed once into a cached table that Arrow hands to numpy without conversion. Every
step runs one Spark job over it; only the weights and summed gradients reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasAggregationDepth,
    HasCheckpointInterval,
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasSeed,
    HasSolver,
    HasStepSize,
    HasTol,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.labels import as_double, as_sign, require_double
from clickloom.functions.probability import clamp, sigmoid, two_class
from clickloom.operators.active import is_active_struct, width_of
from clickloom.operators.checks import at_least, between, one_of, positive, positive_whole
from clickloom.operators.features import require_width, vector_width
from clickloom.operators.fm_math import CLASSIFICATION, REGRESSION, Shape, loss_and_gradient
from clickloom.operators.fm_sparse import BLOCKS, active_evaluator, blocks_of, numbered_partitions, pack_active, summed
from clickloom.operators.fm_state import TrainingState
from clickloom.operators.fm_table import WeightTable, score_table
from clickloom.session import cached, ship_package

FORMAT_VERSION = "1.0"
MODEL_SCHEMA = T.StructType([
    T.StructField("factors", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("linear", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("task", T.IntegerType()),
    T.StructField("num_features", T.IntegerType()),
    T.StructField("num_factors", T.IntegerType()),
    T.StructField("format_version", T.StringType()),
])

# Wider vectors are trained by their active entries alone.
DENSE_WIDTH = 2048
# Draws of a mini-batch are whole numbers below this.
_DRAWS = 1 << 31

Evaluate = Callable[[Sequence[np.ndarray], int], list[tuple[float, np.ndarray, int]]]


def pack_rows(df: DataFrame, features: str, label: Column) -> DataFrame:
    """Rows to (y double, x binary, key long), where x holds the features as float64.

    ``key`` is a hash of the row, so that mini-batches don't depend on how rows are partitioned.

    An Arrow batch of such rows keeps all x back to back in one buffer, which numpy reads as a
    matrix without a copy.
    """
    width = vector_width(df, features)
    batch_rows = int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < batch_rows * width * 8 < 2**31:
        raise ValueError(
            f"{width} features need spark.sql.execution.arrow.maxRecordsPerBatch between 1 and {2**31 // (width * 8) - 1}"
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (width * 8)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(x)]
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, batch.column(2)], names=["y", "x", "key"])

    rows = df.select(label.cast("double").alias("y"), vector_to_array(features).alias("x"))
    return rows.withColumn("key", F.xxhash64("y", "x")).mapInArrow(pack, "y double, x binary, key long")


def _matrix(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column(0).to_numpy(zero_copy_only=False)
    column = batch.column(1)
    values = np.frombuffer(column.buffers()[2], dtype=np.float64, count=(column.offset + len(y)) * width)
    return values[column.offset * width :].reshape(-1, width), y


def row_evaluator(
    rows: DataFrame,
    shape: Shape,
    task: int,
    bounds: tuple[float, float] | None = None,
    fraction: float = 1.0,
    seed: int = 0,
    depth: int = 2,
) -> Evaluate:
    """A function that gives, for several weight vectors at once, mean loss, mean gradient and rows.

    A mini-batch is drawn by a hash of row key, seed and iteration before any row goes to Python.
    The partitions' sums meet on the executors over ``depth`` levels; see ``fm_sparse.combine``.
    """
    slots = numbered_partitions(rows)

    def evaluate(candidates: Sequence[np.ndarray], iteration: int) -> list[tuple[float, np.ndarray, int]]:
        points = np.stack(candidates)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, slot = np.zeros((len(points), shape.size + 2)), 0
            for batch in batches:
                slot = batch.column(2)[0].as_py()
                x, y = _matrix(batch, shape.num_features)
                for total, flat in zip(totals, points):
                    loss, gradient = loss_and_gradient(x, y, shape, flat, task, bounds)
                    total[:2] += loss, len(y)
                    total[2:] += gradient
            yield blocks_of(totals.ravel(), slot)

        draw = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(iteration)), F.lit(_DRAWS))
        batch = rows if fraction == 1.0 else rows.filter(draw < int(fraction * _DRAWS))
        partials = batch.select("y", "x", F.spark_partition_id().alias("slot")).mapInArrow(partial, BLOCKS)
        totals = summed(partials, slots, depth, len(points) * (shape.size + 2))
        results = []
        for total in np.reshape(totals, (len(points), -1)):
            count = int(total[1])
            results.append((total[0] / max(count, 1), total[2:] / max(count, 1), count))
        return results

    return evaluate


def descend(
    evaluate: Evaluate, start: np.ndarray, penalties: np.ndarray, step: float, iterations: int, tol: float,
    state: TrainingState | None = None,
) -> tuple[np.ndarray, list[float]]:
    """Gradient descent with step ``step / sqrt(iteration)``; also the objective before each step.

    With ``state``, a training that was cut off goes on after the last step that was stored.
    """
    weights, history, first = start, [], 1
    if state is not None and (found := state.load()) is not None:
        first, weights, history = found.step + 1, found.arrays["weights"], found.arrays["history"].tolist()
    for i in range(first, iterations + 1):
        loss, gradient, rows = evaluate([weights], i)[0]
        if rows == 0:
            # The sample of this step came out empty.
            continue
        history.append(loss + 0.5 * float(penalties @ weights**2))
        moved = weights - step / np.sqrt(i) * (gradient + penalties * weights)
        change = np.linalg.norm(moved - weights)
        weights = moved
        if state is not None:
            state.save(i, weights=weights, history=np.array(history))
        if change < tol * max(np.linalg.norm(weights), 1.0):
            break
    return weights, history


def lbfgs(
    evaluate: Evaluate, start: np.ndarray, penalties: np.ndarray, iterations: int, corrections: int, tol: float,
    state: TrainingState | None = None,
) -> tuple[np.ndarray, list[float]]:
    """L-BFGS with a backtracking search: a quarter of the step length after each refusal.

    With ``state``, a training that was cut off goes on with the kept pairs of the last stored step.
    """

    def objectives(points: Sequence[np.ndarray], iteration: int) -> list[tuple[float, np.ndarray]]:
        found = evaluate(points, iteration)
        return [
            (loss + 0.5 * float(penalties @ w**2), gradient + penalties * w)
            for w, (loss, gradient, _) in zip(points, found)
        ]

    if state is not None and (found := state.load()) is not None:
        kept = found.arrays
        weights, gradient, history = kept["weights"], kept["gradient"], kept["history"].tolist()
        value, first = history[-1], found.step + 1
        pairs = list(zip(kept["shifts"].reshape(-1, len(weights)), kept["bends"].reshape(-1, len(weights))))
    else:
        weights, first = start, 1
        value, gradient = objectives([weights], 0)[0]
        history, pairs = [value], []
    for i in range(first, iterations + 1):
        direction = -_inverse_hessian_times(gradient, pairs)
        slope = float(direction @ gradient)
        if slope >= 0:
            pairs, direction, slope = [], -gradient, -float(gradient @ gradient)
        s = 1.0 if pairs else 1.0 / max(np.linalg.norm(gradient), 1e-12)
        accepted = None
        for _ in range(16):
            # Nearly always the first length fits, so lengths are tried one by one.
            new_value, new_gradient = objectives([weights + s * direction], i)[0]
            if new_value <= value + 1e-4 * s * slope:
                accepted = new_value, new_gradient, s
                break
            s *= 0.25
        if accepted is None:
            break
        new_value, new_gradient, s = accepted
        shift, bend = s * direction, new_gradient - gradient
        if shift @ bend > 1e-12:
            pairs = [*pairs, (shift, bend)][-corrections:]
        done = value - new_value <= tol * max(abs(value), abs(new_value), 1e-12)
        weights, value, gradient = weights + shift, new_value, new_gradient
        history.append(value)
        if state is not None:
            kept = {name: np.array([p[side] for p in pairs]).ravel() for side, name in enumerate(("shifts", "bends"))}
            state.save(i, weights=weights, gradient=gradient, history=np.array(history), **kept)
        if done:
            break
    return weights, history


def _inverse_hessian_times(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion over the kept (shift, gradient change) pairs."""
    q, factors = gradient.copy(), []
    for shift, bend in reversed(pairs):
        a = (shift @ q) / (shift @ bend)
        factors.append(a)
        q -= a * bend
    if pairs:
        shift, bend = pairs[-1]
        q *= (shift @ bend) / (bend @ bend)
    for (shift, bend), a in zip(pairs, reversed(factors)):
        q += (a - (bend @ q) / (shift @ bend)) * shift
    return q


class _FMParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    task = Param(
        Params._dummy(), "task", "0 for regression, 1 for classification",
        one_of(REGRESSION, CLASSIFICATION, convert=TypeConverters.toInt),
    )


class FactorizationMachine(
    Estimator, _FMParams, HasMaxIter, HasStepSize, HasSeed, HasSolver, HasTol, HasAggregationDepth, HasCheckpointInterval,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Trains a factorization machine.

    ``solver`` is "gd" (``stepSize``, ``miniBatchFraction``) or "lbfgs" (``numCorrections``).
    ``tol`` is the relative change at which training stops; 0 runs every iteration of "gd".

    Features are vectors or structs of ``indices`` and ``values``; structs need ``numFeatures``. ``storage`` "dense"
    keeps rows as blocks of a matrix, "sparse" by their active entries; "auto" takes the latter for structs and
    for vectors wider than ``DENSE_WIDTH``. Partial gradients meet over ``aggregationDepth`` levels. With
    ``checkpointPath``, every ``checkpointInterval`` steps are stored there, and a fit with the same settings and
    path goes on where one before was cut off. Weights that don't fit one machine: ``fm_table.train_table``.
    """

    storage = Param(Params._dummy(), "storage", "dense, sparse or auto", one_of("auto", "dense", "sparse", convert=TypeConverters.toString))
    numFeatures = Param(Params._dummy(), "numFeatures", "width of the features, 0 to read it from the column", at_least(0, convert=TypeConverters.toInt))
    checkpointPath = Param(Params._dummy(), "checkpointPath", "shared folder for the state of a training, empty for none", TypeConverters.toString)
    aggregationDepth = Param(Params._dummy(), "aggregationDepth", "levels over which partial gradients meet", positive_whole)
    checkpointInterval = Param(Params._dummy(), "checkpointInterval", "steps between stored states", positive_whole)

    useBias = Param(Params._dummy(), "useBias", "train a bias", TypeConverters.toBoolean)
    useLinear = Param(Params._dummy(), "useLinear", "train one linear weight per feature", TypeConverters.toBoolean)
    numFactors = Param(Params._dummy(), "numFactors", "factors per feature", positive_whole)
    regBias = Param(Params._dummy(), "regBias", "L2 strength on the bias", at_least(0.0))
    regLinear = Param(Params._dummy(), "regLinear", "L2 strength on the linear weights", at_least(0.0))
    regFactors = Param(Params._dummy(), "regFactors", "L2 strength on the factors", at_least(0.0))
    initStd = Param(Params._dummy(), "initStd", "spread of the initial factors", positive)
    miniBatchFraction = Param(
        Params._dummy(), "miniBatchFraction", "share of the rows in each gradient", between(0.0, 1.0, open_low=True)
    )
    numCorrections = Param(Params._dummy(), "numCorrections", "steps L-BFGS remembers", positive_whole)
    maxIter = Param(Params._dummy(), "maxIter", "largest number of iterations", positive_whole)
    stepSize = Param(Params._dummy(), "stepSize", "step of the first iteration", at_least(0.0))
    solver = Param(Params._dummy(), "solver", "gd, lbfgs, or auto for gd", one_of("auto", "gd", "lbfgs", convert=TypeConverters.toString))

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        predictionCol: str = "prediction",
        probabilityCol: str = "probability",
        task: int = CLASSIFICATION,
        solver: str = "gd",
        maxIter: int = 100,
        stepSize: float = 1.0,
        useBias: bool = True,
        useLinear: bool = True,
        numFactors: int = 8,
        regBias: float = 0.0,
        regLinear: float = 1e-3,
        regFactors: float = 1e-4,
        initStd: float = 0.01,
        miniBatchFraction: float = 1.0,
        numCorrections: int = 10,
        tol: float = 1e-6,
        seed: int = 17,
        storage: str = "auto",
        numFeatures: int = 0,
        aggregationDepth: int = 2,
        checkpointPath: str = "",
        checkpointInterval: int = 10,
    ):
        super().__init__()
        self._set(
            storage=storage, numFeatures=numFeatures, aggregationDepth=aggregationDepth, checkpointPath=checkpointPath,
            checkpointInterval=checkpointInterval,
        )
        self._set(
            featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, probabilityCol=probabilityCol,
            task=task, solver=solver, maxIter=maxIter, stepSize=stepSize, useBias=useBias, useLinear=useLinear,
            numFactors=numFactors, regBias=regBias, regLinear=regLinear, regFactors=regFactors, initStd=initStd,
            miniBatchFraction=miniBatchFraction, numCorrections=numCorrections, tol=tol, seed=seed,
        )

    @keyword_only
    def setParams(self, **kwargs) -> FactorizationMachine:
        return self._set(**kwargs)

    def setDim(self, useBias: bool = True, useLinear: bool = True, numFactors: int = 8) -> FactorizationMachine:
        return self._set(useBias=useBias, useLinear=useLinear, numFactors=numFactors)

    def setRegParam(self, regBias: float = 0.0, regLinear: float = 0.0, regFactors: float = 0.0) -> FactorizationMachine:
        return self._set(regBias=regBias, regLinear=regLinear, regFactors=regFactors)

    def _fit(self, dataset: DataFrame) -> FactorizationMachineModel:
        ship_package(dataset.sparkSession)
        get = self.getOrDefault
        task, label, features = get("task"), self.getLabelCol(), self.getFeaturesCol()
        width = width_of(dataset, features, get("numFeatures"))
        shape = Shape(width, get("numFactors"), get("useBias"), get("useLinear"))
        target = as_sign(label) if task == CLASSIFICATION else require_double(label)
        low, high = label_range(dataset, label) if task == REGRESSION else (float("-inf"), float("inf"))
        penalties = shape.penalties(get("regBias"), get("regLinear"), get("regFactors"))
        start = shape.initial(get("initStd"), get("seed"))
        by_entry = get("storage") == "sparse" or (get("storage") == "auto" and (width > DENSE_WIDTH or is_active_struct(dataset, features)))
        rows, evaluator = (pack_active(dataset, features, target), active_evaluator) if by_entry else (pack_rows(dataset, features, target), row_evaluator)
        state = self._state(dataset, width) if get("checkpointPath") else None
        with cached(rows):
            if get("solver") != "lbfgs":
                # Gradient descent sees clamped scores; the line search of L-BFGS needs smooth ones.
                bounds = (low, high) if task == REGRESSION else None
                evaluate = evaluator(rows, shape, task, bounds, get("miniBatchFraction"), get("seed"), get("aggregationDepth"))
                flat, history = descend(evaluate, start, penalties, get("stepSize"), get("maxIter"), get("tol"), state)
            else:
                evaluate = evaluator(rows, shape, task, depth=get("aggregationDepth"))
                flat, history = lbfgs(evaluate, start, penalties, get("maxIter"), get("numCorrections"), get("tol"), state)
        factors, linear, bias = shape.unpack(flat)
        model = FactorizationMachineModel(factors, linear if shape.use_linear else None, bias, low, high, history)
        model = self._copyValues(model)
        model._resetUid(self.uid)
        return model


    def _state(self, dataset: DataFrame, width: int) -> TrainingState:
        """The stored training, which another setting must not continue; only ``maxIter`` may differ."""
        free = {"maxIter", "checkpointPath", "checkpointInterval", "aggregationDepth", "storage"}
        settings = {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p) and p.name not in free}
        get = self.getOrDefault
        return TrainingState(dataset.sparkSession, get("checkpointPath"), get("checkpointInterval"), {**settings, "width": width})


def label_range(dataset: DataFrame, label: str) -> tuple[float, float]:
    """Smallest and largest label, which bound the predictions of a regression."""
    row = dataset.agg(F.min(as_double(label)).alias("low"), F.max(as_double(label)).alias("high")).first()
    return row["low"], row["high"]


def score_column(x: Column, factors: np.ndarray, linear: np.ndarray | None, bias: float) -> Column:
    """The raw score of a double array under fixed weights, as one Column expression."""

    def weighted(weights: np.ndarray, power: int = 1) -> Column:
        values = F.lit([float(w) for w in weights])
        return F.aggregate(
            F.zip_with(x, values, (lambda v, w: v * w) if power == 1 else (lambda v, w: v * v * w)),
            F.lit(0.0),
            lambda s, v: s + v,
        )

    score = F.lit(float(bias))
    if linear is not None:
        score = score + weighted(linear)
    squares = [F.pow(weighted(factors[:, f]), 2.0) for f in range(factors.shape[1])]
    return score + (sum(squares[1:], squares[0]) - weighted((factors**2).sum(axis=1), power=2)) / 2.0


class FactorizationMachineModel(Model, _FMParams, MLWritable, MLReadable):
    """Fitted weights. ``transform`` adds the prediction and, for classification, the probability."""

    def __init__(self, factors=None, linear=None, bias=0.0, low=float("-inf"), high=float("inf"), history=()):
        super().__init__()
        self.factors = None if factors is None else np.asarray(factors, dtype=float)
        self.linear = None if linear is None else np.asarray(linear, dtype=float)
        self.bias, self.low, self.high = float(bias), float(low), float(high)
        self.objective_history = list(history)
        self._setDefault(task=CLASSIFICATION)
        if self.factors is not None:
            Shape(*self.factors.shape)

    @property
    def num_features(self) -> int:
        return self.factors.shape[0]

    @property
    def num_factors(self) -> int:
        return self.factors.shape[1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Narrow vectors are scored by one expression; wide or sparse ones by a weight table, see ``fm_table.score_table``."""
        features = self.getFeaturesCol()
        if is_active_struct(dataset, features) or self.num_features > DENSE_WIDTH:
            table = WeightTable.of_model(dataset.sparkSession, self)
            regression = self.getOrDefault("task") == REGRESSION
            scored = score_table(dataset, table, features, None, self.getPredictionCol() if regression else "_p")
            if regression:
                return scored
            scored = scored.withColumn(self.getProbabilityCol(), two_class(F.col("_p")))
            return scored.withColumn(self.getPredictionCol(), F.when(F.col("_p") > 0.5, 1.0).otherwise(0.0)).drop("_p")
        require_width(dataset, features, self.num_features)
        raw = score_column(F.col("_x"), self.factors, self.linear, self.bias)
        scored = dataset.withColumn("_x", vector_to_array(features)).withColumn("_raw", raw)
        prediction = self.getPredictionCol()
        if self.getOrDefault("task") == REGRESSION:
            out = scored.withColumn(prediction, clamp(F.col("_raw"), self.low, self.high))
        else:
            p = sigmoid(F.col("_raw"))
            out = scored.withColumn(self.getProbabilityCol(), two_class(p))
            out = out.withColumn(prediction, F.when(F.col("_raw") > 0, 1.0).otherwise(0.0))
        return out.drop("_x", "_raw")

    def write(self) -> MLWriter:
        return _FMWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FMReader()


class _FMWriter(MLWriter):
    def __init__(self, model: FactorizationMachineModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession)
        row = (
            m.factors.tolist(), None if m.linear is None else m.linear.tolist(), m.bias, m.low, m.high,
            m.getOrDefault("task"), m.num_features, m.num_factors, FORMAT_VERSION,
        )
        self.sparkSession.createDataFrame([row], MODEL_SCHEMA).coalesce(1).write.parquet(f"{path}/data")


class _FMReader(MLReader):
    def load(self, path: str) -> FactorizationMachineModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        data = spark.read.parquet(f"{path}/data")
        missing = sorted(set(MODEL_SCHEMA.fieldNames()) - set(data.columns))
        if missing:
            raise ValueError(f"{path} holds no factorization machine: columns {missing} are missing")
        rows = data.select(MODEL_SCHEMA.fieldNames()).take(2)
        if len(rows) != 1:
            raise ValueError(f"{path} holds {len(rows) or 'no'} models, expected one")
        row = rows[0]
        if row["format_version"] != FORMAT_VERSION:
            raise ValueError(f"unsupported model format {row['format_version']!r}, expected {FORMAT_VERSION!r}")
        factors = np.array(row["factors"])
        if factors.shape != (row["num_features"], row["num_factors"]):
            raise ValueError(f"factors are {factors.shape}, expected {(row['num_features'], row['num_factors'])}")
        model = FactorizationMachineModel(factors, row["linear"], row["intercept"], row["min"], row["max"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.getOrDefault("task") != row["task"]:
            raise ValueError("task in the metadata and in the data differ")
        return model
