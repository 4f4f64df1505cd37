"""Multilayer perceptrons and factorization machines as Spark ML defines them, their gradients by blocks of rows.

Both estimators take the parameters, first weights, objective and stopping rule of the Spark ML estimator they
extend. Rows are packed once into cached blocks; every step runs one Spark job over them, and the driver sees
weights and summed gradients only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import FMClassifier, MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.labels import as_double, as_sign
from clickloom.operators.features import vector_width
from clickloom.operators.fm import Evaluate, FactorizationMachineModel, _inverse_hessian_times, descend, pack_rows, row_evaluator
from clickloom.operators.fm_math import CLASSIFICATION, Shape, loss_and_gradient
from clickloom.operators.fm_sparse import BLOCK, DIRECT
from clickloom.session import cached, ship_package

# Rows of a block, and those whose activations are held at a time.
BLOCK_ROWS, CHUNK_ROWS = 1 << 15, 1 << 11
# Below so many rows the jobs of the steps take longer than what they sum.
LEAST_ROWS = 1_000_000
# Values of the objective that L-BFGS of Spark ML looks back on, steps it remembers, and its search for a step length.
_MEMORY, _CORRECTIONS = 20, 10
_DECREASE, _CURVATURE, _TRIES = 1e-4, 0.9, 10
_PACKED = "slot int, y binary, dense binary, codes array<binary>, tables array<binary>, own array<struct<start: int, stop: int, codes: binary, table: binary>>"
# Neighbouring columns that have at most one different row in so many are held by number as well.
_ROWS_EACH = 16
# Tables of so many columns at most get their gradient from the rows themselves, not from sums by number.
_NARROW = 16
# Products of exponentials stay far from overflow up to this sum of exponents.
_EXPONENTS = 600.0


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The distinct rows of a matrix and each row's place among them; None unless there are half as many at most."""
    bits = np.ascontiguousarray(x).view(np.uint64)
    factors = np.random.default_rng(1).integers(1, 2**63, x.shape[1], dtype=np.uint64) | np.uint64(1)
    hashes = ((bits ^ (bits >> np.uint64(29))) * factors).sum(axis=1, dtype=np.uint64)
    _, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
    if 2 * len(first) > len(x) or not np.array_equal(bits[first][codes], bits):
        return None
    return x[first], codes.astype(np.int32)


def numbered_columns(x: np.ndarray, most: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of neighbouring columns with at most ``most`` different rows: start, stop, each row's number, those rows.

    A column that alone has more is in no run.
    """
    bits, runs, start, codes = np.ascontiguousarray(x).view(np.uint64), [], 0, None

    def close(stop: int) -> None:
        if codes is not None:
            _, first = np.unique(codes, return_index=True)
            runs.append((start, stop, codes.astype(np.uint16), np.ascontiguousarray(x[first, start:stop])))

    for column in range(x.shape[1]):
        values, own = np.unique(bits[:, column], return_inverse=True)
        if codes is not None and len(values) <= most:
            found, both = np.unique(codes * len(values) + own, return_inverse=True)
            if len(found) <= most:
                codes = both
                continue
        close(column)
        start, codes = column, own if len(values) <= most else None
    close(x.shape[1])
    return runs


def _dense_columns(width: int, shared: Sequence[tuple[int, int]], coded: Sequence[bool]) -> np.ndarray:
    dense = np.ones(width, bool)
    for (start, stop), held in zip(shared, coded):
        dense[start:stop] &= not held
    return np.flatnonzero(dense)


def pack_blocks(df: DataFrame, features: str, label: Column, classes: int, shared: Sequence[tuple[int, int]] = ()) -> DataFrame:
    """Rows packed by the ten thousand: labels, and the features as float64.

    ``shared`` are ranges of positions whose values as a whole many rows have in common, such as embeddings. Where
    that is so in a block, it holds the different ones once, and a number for each row. So it does, in ``own``, with
    neighbouring columns of few different values, such as categories, buckets and counts. A block's rows are in the
    order of the numbers of its longest shared table.
    """
    width = vector_width(df, features)

    def packed(x: np.ndarray, y: np.ndarray, slot: int) -> pa.RecordBatch:
        if not np.isfinite(x).all():
            raise ValueError("features have to be finite")
        if not (np.isin(y, np.arange(classes))).all():
            raise ValueError(f"labels have to be whole numbers from 0 to {classes - 1}")
        found = [distinct_rows(x[:, start:stop]) for start, stop in shared]
        longest = max((f for f in found if f is not None), key=lambda f: len(f[0]), default=None)
        if longest is not None:
            order = np.argsort(longest[1], kind="stable")
            x, y = x[order], y[order]
            found = [f and (f[0], f[1][order]) for f in found]
        rest = _dense_columns(width, shared, [f is not None for f in found])
        own, free = [], np.ones(width, bool)
        # A range that is not held by number here has too many values, so that only the columns beside it are tried.
        for columns in np.split(rest, np.flatnonzero(np.diff(rest) > 1) + 1):
            for low, high, number, table in numbered_columns(x[:, columns], min(len(x) // _ROWS_EACH, 1 << 16)):
                start, stop = int(columns[low]), int(columns[high - 1]) + 1
                own.append({"start": start, "stop": stop, "codes": number.tobytes(), "table": table.tobytes()})
                free[start:stop] = False
        dense = np.ascontiguousarray(x[:, rest[free[rest]]])
        codes = [b"" if f is None else f[1].tobytes() for f in found]
        tables = [b"" if f is None else np.ascontiguousarray(f[0]).tobytes() for f in found]
        arrays = [pa.array([slot], pa.int32()), pa.array([y.astype(np.int8).tobytes()], pa.binary()), pa.array([dense.tobytes()], pa.binary())]
        lists = (pa.array([held], pa.list_(pa.binary())) for held in (codes, tables))
        part = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("codes", pa.binary()), ("table", pa.binary())])
        return pa.RecordBatch.from_arrays([*arrays, *lists, pa.array([own], pa.list_(part))], ["slot", "y", "dense", "codes", "tables", "own"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, slot = [], 0, 0
        for batch in batches:
            slot = batch.column(2)[0].as_py()
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            held.append((x, batch.column(0).to_numpy(zero_copy_only=False)))
            count += len(x)
            if count >= BLOCK_ROWS:
                yield packed(*(np.concatenate(side) for side in zip(*held)), slot)
                held, count = [], 0
        if held:
            yield packed(*(np.concatenate(side) for side in zip(*held)), slot)

    rows = df.select(label.cast("double").alias("y"), vector_to_array(features).alias("x"), F.spark_partition_id().alias("slot"))
    return rows.mapInArrow(pack, _PACKED)


def block_loss_and_gradient(
    y: np.ndarray, dense: np.ndarray, codes: Sequence[np.ndarray | None], tables: Sequence[np.ndarray | None],
    layers: Sequence[int], shared: Sequence[tuple[int, int]], flat: np.ndarray,
) -> tuple[float, np.ndarray]:
    """Summed cross-entropy and gradient of a block: sigmoids in the hidden layers, softmax in the last.

    ``flat`` has, layer by layer, the weights input by input, then the biases. Numbered parts of the input go through
    the first layer once for each different one. If all parts are numbered, so do their exponentials: those of a row
    are the products of its parts'.
    """
    weights, gradient, at = [], np.zeros(len(flat)), 0
    for width, out in zip(layers, layers[1:]):
        end = at + width * out
        weights.append((flat[at:end].reshape(width, out), flat[end : end + out], gradient[at:end].reshape(width, out), gradient[end : end + out]))
        at = end + out
    first, bias, d_first, d_bias = weights[0]
    columns = _dense_columns(layers[0], shared, [c is not None for c in codes])
    parts = [(slice(start, stop), c, t) for (start, stop), c, t in zip(shared, codes, tables) if c is not None]
    through, hidden = [t @ first[own] for own, _, t in parts], len(layers) > 2
    by_product = hidden and parts and not len(columns) and sum(np.abs(p).max() for p in through) + np.abs(bias).max() < _EXPONENTS
    if by_product:
        through[0] += bias
        through = [np.exp(-p) for p in through]
    two_classes = len(layers) == 3 and layers[-1] == 2
    pull = weights[-1][0][:, 1] - weights[-1][0][:, 0] if two_classes else None
    narrow = [part for part in parts if part[2].shape[1] <= _NARROW]
    wide = [part for part in parts if part[2].shape[1] > _NARROW]
    positions = np.concatenate([columns, *(np.arange(own.start, own.stop) for own, _, _ in narrow)])
    d_rows = np.zeros((len(positions), layers[1]))
    kept = np.empty((layers[1], len(y))) if wide else None
    loss, most = 0.0, min(CHUNK_ROWS, len(y))
    room, spare = np.empty((most, layers[1])), np.empty((most, layers[1]))
    for low in range(0, len(y), CHUNK_ROWS):
        rows = slice(low, min(low + CHUNK_ROWS, len(y)))
        target = y[rows]
        z, other = room[: len(target)], spare[: len(target)]
        if by_product:
            np.take(through[0], parts[0][1][rows], axis=0, out=z, mode="clip")
        else:
            np.matmul(dense[rows], first[columns], out=z)
            z += bias
        for (_, c, _), p in list(zip(parts, through))[1 if by_product else 0 :]:
            np.take(p, c[rows], axis=0, out=other, mode="clip")
            (np.multiply if by_product else np.add)(z, other, out=z)
        held = []
        if hidden:
            held.append(_logistic_of(z) if by_product else _sigmoid(z))
        for w, b, _, _ in weights[1:-1]:
            held.append(_sigmoid(held[-1] @ w + b))
        if two_classes:
            # The softmax of two values is the sigmoid of their difference; ``pull`` comes in at the end, once.
            (_, b, d_w, d_b), h = weights[1], held[0]
            margin = h @ pull + (b[1] - b[0])
            loss += float(np.logaddexp(0.0, np.where(target == 1, -margin, margin)).sum())
            excess = _sigmoid(margin) - target
            d_w += np.outer(excess @ h, (-1.0, 1.0))
            d_b += excess.sum() * np.array((-1.0, 1.0))
            np.multiply(h, h, out=other)
            delta = np.subtract(h, other, out=h)
            delta *= excess[:, None]
        else:
            # The last layer is laid out unit by unit, as its units are few.
            z = weights[-1][0].T @ held[-1].T + weights[-1][1][:, None] if hidden else np.ascontiguousarray(z.T)
            z -= z.max(axis=0)
            each = np.arange(len(target))
            norm = np.log(np.exp(z).sum(axis=0))
            loss += float((norm - z[target, each]).sum())
            delta = np.exp(z - norm)
            delta[target, each] -= 1.0
            delta = delta.T
            for (w, _, d_w, d_b), h in zip(weights[:0:-1], held[::-1]):
                d_w += h.T @ delta
                d_b += delta.sum(axis=0)
                delta = delta @ w.T
                delta *= h
                delta *= np.subtract(1.0, h, out=h)
        d_bias += np.ones(len(target)) @ delta
        if len(positions):
            d_rows += np.hstack([dense[rows], *(t[c[rows]] for _, c, t in narrow)]).T @ delta
        if wide:
            kept[:, rows] = delta.T
    d_first[positions] += d_rows
    for own, c, t in wide:
        d_first[own] += t.T @ _sums_by_number(kept, c, len(t))
    if two_classes:
        d_first *= pull
        d_bias *= pull
    return loss, gradient


def _sums_by_number(by_unit: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each number, for each unit; rows in the order of their numbers are summed as they stand."""
    if (codes[1:] >= codes[:-1]).all():
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        sums = np.zeros((size, len(by_unit)))
        sums[codes[starts]] = np.add.reduceat(by_unit, starts, axis=1).T
        return sums
    return np.stack([np.bincount(codes, weights=unit, minlength=size) for unit in by_unit], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        np.exp(np.negative(z, out=z), out=z)
    return _logistic_of(z)


def _logistic_of(e: np.ndarray) -> np.ndarray:
    e += 1.0
    return np.reciprocal(e, out=e)


@contextmanager
def kept_blocks(blocks: DataFrame) -> Iterator[RDD]:
    """The rows of a table of blocks, kept as they go to Python: a step that reads them plans nothing anew."""
    rows = blocks.rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def summed_blocks(blocks: DataFrame | RDD, partial: Callable[[Iterator], np.ndarray], size: int, depth: int) -> np.ndarray:
    """The sum over the partitions of ``partial``, a vector of ``size``.

    The driver gets the vectors of few partitions as they are; more of them meet on the executors first.
    """
    rows = blocks if isinstance(blocks, RDD) else blocks.rdd
    parts = rows.mapPartitions(lambda held: iter([partial(held)]))
    if parts.getNumPartitions() * size <= DIRECT * BLOCK:
        return np.sum(parts.collect(), axis=0, initial=0.0) if parts.getNumPartitions() else np.zeros(size)
    return parts.treeReduce(np.add, depth)


def block_evaluator(blocks: DataFrame | RDD, layers: Sequence[int], shared: Sequence[tuple[int, int]], depth: int = 2) -> Evaluate:
    """Like ``fm.row_evaluator``, over blocks of ``pack_blocks``: mean loss, mean gradient and rows for weight vectors."""
    size = sum((width + 1) * out for width, out in zip(layers, layers[1:]))

    def evaluate(candidates: Sequence[np.ndarray], iteration: int) -> list[tuple[float, np.ndarray, int]]:
        points = [np.asarray(c) for c in candidates]

        def partial(held: Iterator[Row]) -> np.ndarray:
            totals = np.zeros((len(points), size + 2))
            for block in held:
                y = np.frombuffer(block.y, np.int8).astype(np.intp)
                dense = np.frombuffer(block.dense).reshape(len(y), -1)
                ranges = [*shared, *((p.start, p.stop) for p in block.own)]
                codes = [np.frombuffer(c, np.int32).astype(np.intp) if c else None for c in block.codes]
                codes += [np.frombuffer(p.codes, np.uint16).astype(np.intp) for p in block.own]
                held_once = [*block.tables, *(p.table for p in block.own)]
                tables = [np.frombuffer(t).reshape(-1, stop - start) for t, (start, stop) in zip(held_once, ranges)]
                for total, flat in zip(totals, points):
                    loss, gradient = block_loss_and_gradient(y, dense, codes, tables, layers, ranges, flat)
                    total[:2] += loss, len(y)
                    total[2:] += gradient
            return totals.ravel()

        totals = summed_blocks(blocks, partial, len(points) * (size + 2), depth).reshape(len(points), -1)
        return [(t[0] / max(t[1], 1), t[2:] / max(t[1], 1), int(t[1])) for t in totals]

    return evaluate


def machine_evaluator(blocks: DataFrame | RDD, shape: Shape, depth: int = 2) -> Evaluate:
    """Like ``fm.row_evaluator`` with log-loss over all rows, over blocks of ``pack_blocks`` without shared ranges."""

    def evaluate(candidates: Sequence[np.ndarray], iteration: int) -> list[tuple[float, np.ndarray, int]]:
        points = [np.asarray(c) for c in candidates]

        def partial(held: Iterator[Row]) -> np.ndarray:
            totals = np.zeros((len(points), shape.size + 2))
            for block in held:
                x, y = block_features(block, shape.num_features), 2.0 * np.frombuffer(block.y, np.int8) - 1.0
                for total, flat in zip(totals, points):
                    loss, gradient = loss_and_gradient(x, y, shape, flat, CLASSIFICATION)
                    total[:2] += loss, len(y)
                    total[2:] += gradient
            return totals.ravel()

        totals = summed_blocks(blocks, partial, len(points) * (shape.size + 2), depth).reshape(len(points), -1)
        return [(t[0] / max(t[1], 1), t[2:] / max(t[1], 1), int(t[1])) for t in totals]

    return evaluate


def block_features(block: Row, width: int) -> np.ndarray:
    """The features of a block without shared ranges, row by row."""
    n, free = len(block.y), np.ones(width, bool)
    x = np.empty((n, width))
    for p in block.own:
        x[:, p.start : p.stop] = np.frombuffer(p.table).reshape(-1, p.stop - p.start)[np.frombuffer(p.codes, np.uint16)]
        free[p.start : p.stop] = False
    x[:, free] = np.frombuffer(block.dense).reshape(n, -1)
    return x


class SearchFailed(ArithmeticError):
    """No step length along a direction meets the conditions."""


def wolfe_step(along: Callable[[float], tuple[float, float]], value: float, slope: float, first: float) -> float:
    """A step length that meets the strong Wolfe conditions, by widening a bracket and cubic interpolation within it.

    ``along`` gives objective and slope at a length; ``value`` and ``slope`` are those at 0.
    """

    def between(left: tuple, right: tuple) -> float:
        (s, f, d), (t, g, e) = sorted((left, right))
        turn = d + e - 3 * (f - g) / (s - t)
        root = np.sqrt(max(turn * turn - d * e, 0.0))
        bend = e - d + 2 * root
        length = t - (t - s) * (e + root - turn) / bend if bend else (s + t) / 2
        return min(max(length, s + 0.1 * (t - s)), s + 0.9 * (t - s))

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(_TRIES):
            at = between(low, high)
            found = (at, *along(at))
            if found[1] > value + _DECREASE * at * slope or found[1] >= low[1]:
                high = found
                continue
            if abs(found[2]) <= _CURVATURE * abs(slope):
                return at
            if found[2] * (high[0] - low[0]) >= 0:
                high = low
            low = found
        raise SearchFailed

    low, at = (0.0, value, slope), first
    for attempt in range(_TRIES):
        found = (at, *along(at))
        if not np.isfinite(found[1]):
            at /= 2
            continue
        if found[1] > value + _DECREASE * at * slope or (attempt and found[1] >= low[1]):
            return zoom(low, found)
        if abs(found[2]) <= _CURVATURE * abs(slope):
            return at
        if found[2] >= 0:
            return zoom(found, low)
        low, at = found, at * 1.5
    raise SearchFailed


def minimise(evaluate: Evaluate, start: np.ndarray, iterations: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS with the stopping rule of Spark ML; also the objective before and after each step.

    It ends when the last ``_MEMORY`` values gained at most ``tol`` of the first one, when the gradient vanishes, or when
    the search fails along the gradient as well.
    """

    def at(point: np.ndarray, iteration: int) -> tuple[float, np.ndarray]:
        # The search ends on a point that it has been at.
        if not seen or not np.array_equal(seen[0], point):
            seen[:] = point, *evaluate([point], iteration)[0][:2]
        return seen[1], seen[2]

    seen: list = []
    weights, pairs, done, failed = start, [], 0, False
    value, gradient = at(weights, 0)
    history = [value]
    while done < iterations and np.linalg.norm(gradient) > max(tol * abs(value), 1e-8):
        direction = -_inverse_hessian_times(gradient, pairs)

        def along(length: float) -> tuple[float, float]:
            found, slopes = at(weights + length * direction, done + 1)
            return found, float(slopes @ direction)

        try:
            length = wolfe_step(along, value, float(gradient @ direction), 1.0 if done else 1.0 / np.linalg.norm(direction))
        except SearchFailed:
            if failed:
                break
            pairs, failed = [], True
            continue
        shift = length * direction
        value, changed = at(weights + shift, done + 1)
        pairs = [*pairs, (shift, changed - gradient)][-_CORRECTIONS:]
        weights, gradient, done, failed = weights + shift, changed, done + 1, False
        history.append(value)
        if abs(value - max(history[-_MEMORY:])) <= tol * abs(history[0]):
            break
    return weights, history


def _one_row(dataset: DataFrame, features: str, label: str, width: int) -> DataFrame:
    schema = T.StructType([T.StructField(features, VectorUDT()), T.StructField(label, T.DoubleType())])
    return dataset.sparkSession.createDataFrame([(Vectors.dense(np.zeros(width)), 0.0)], schema)


class BlockNetwork(MultilayerPerceptronClassifier):
    """A multilayer perceptron trained by L-BFGS on blocks of rows; small tables and other solvers are left to Spark ML.

    Gives Spark ML's own model. First weights, objective (mean over rows), number of steps, search and stopping rule are
    its as well. ``shared``: see ``pack_blocks``.
    """

    shared: Sequence[tuple[int, int]] = ()
    least_rows = LEAST_ROWS

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        if self.getSolver() != "l-bfgs" or dataset.count() < self.least_rows:
            return super()._fit(dataset)
        ship_package(dataset.sparkSession)
        features, label, layers, shared = self.getFeaturesCol(), self.getLabelCol(), self.getLayers(), list(self.shared)
        width = vector_width(dataset, features)
        if width != layers[0]:
            raise ValueError(f"column {features} has {width} values, the first layer {layers[0]}")
        # Spark ML draws the first weights, and wraps the last ones, at a fit without steps.
        one = _one_row(dataset, features, label, width)
        start = super(BlockNetwork, self.copy({self.maxIter: 0}))._fit(one).weights.toArray()
        blocks = pack_blocks(dataset, features, as_double(label), layers[-1], shared)
        with kept_blocks(blocks) as held:
            evaluate = block_evaluator(held, layers, shared)
            flat, _ = minimise(evaluate, start, self.getMaxIter(), self.getTol())
        given = self.copy({self.maxIter: 0, self.initialWeights: Vectors.dense(flat)})
        # A copy has no summary, which would be that of the one row.
        model = super(BlockNetwork, given)._fit(one).copy()
        model.clear(model.initialWeights)
        return model._set(maxIter=self.getMaxIter())


class BlockFM(FMClassifier):
    """A factorization machine trained by gradient descent on packed rows; small tables and "adamW" are left to Spark ML.

    First weights, objective, steps and stopping rule are those of Spark ML; the model is the library's own.
    """

    least_rows = LEAST_ROWS

    def _fit(self, dataset: DataFrame):
        if self.getSolver() != "gd" or dataset.count() < self.least_rows:
            return super()._fit(dataset)
        ship_package(dataset.sparkSession)
        features, label = self.getFeaturesCol(), self.getLabelCol()
        shape = Shape(vector_width(dataset, features), self.getFactorSize(), self.getFitIntercept(), self.getFitLinear())
        # Spark ML draws the first weights.
        drawn = super(BlockFM, self.copy({self.maxIter: 0}))._fit(_one_row(dataset, features, label, shape.num_features))
        start = shape.pack(drawn.factors.toArray(), drawn.linear.toArray(), drawn.intercept)
        penalties = np.full(len(start), self.getRegParam())
        if self.getMiniBatchFraction() == 1.0:
            with kept_blocks(pack_blocks(dataset, features, as_double(label), 2)) as held:
                flat, history = descend(machine_evaluator(held, shape), start, penalties, self.getStepSize(), self.getMaxIter(), self.getTol())
        else:
            rows = pack_rows(dataset, features, as_sign(label))
            with cached(rows):
                evaluate = row_evaluator(rows, shape, CLASSIFICATION, None, self.getMiniBatchFraction(), self.getSeed())
                flat, history = descend(evaluate, start, penalties, self.getStepSize(), self.getMaxIter(), self.getTol())
        factors, linear, bias = shape.unpack(flat)
        model = FactorizationMachineModel(factors, linear if shape.use_linear else None, bias, history=history)
        return model._set(featuresCol=features, labelCol=label, predictionCol=self.getPredictionCol(), probabilityCol=self.getProbabilityCol())
