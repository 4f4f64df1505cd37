"""Training steps of a factorization machine over active entries alone.

Rows keep their entries as two arrays. An Arrow batch of such rows is a compressed sparse matrix as it
stands: the list offsets are the row pointers, the flat children are the positions and values. A step
touches the weights of active positions only, whatever the width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.active import active
from clickloom.operators.fm_math import CLASSIFICATION, Shape

# Numbers of a gradient that travel, and are summed, as one row.
BLOCK = 1 << 16
# So many partitions send their blocks to the driver as they are.
DIRECT = 16
_DRAWS = 1 << 31


def pack_active(df: DataFrame, features: str, label: Column) -> DataFrame:
    """Rows to (y double, positions array<int>, values array<double>, key long), JVM-side; ``key`` is a hash of the row."""
    rows = df.select(label.cast("double").alias("y"), active(df, features).alias("entries"))
    key = F.xxhash64("y", "entries").alias("key")
    return rows.select("y", F.col("entries.position").alias("positions"), F.col("entries.value").alias("values"), key)


def sparse_loss_and_gradient(
    pointers: np.ndarray, positions: np.ndarray, values: np.ndarray, y: np.ndarray, shape: Shape, flat: np.ndarray, task: int,
    bounds: tuple[float, float] | None = None,
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
    """Summed loss and gradient of a block: loss, the touched positions, their factor and linear parts, the bias part.

    Row r has the entries from ``pointers[r]`` to ``pointers[r + 1]``. The loss is that of the dense block.
    """
    factors, linear, bias = shape.unpack(flat)
    rows = np.repeat(np.arange(len(y)), np.diff(pointers))
    touched, local = np.unique(positions, return_inverse=True)
    own = factors[touched]
    spread = values[:, None] * own[local]

    def per_row(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=x, minlength=len(y))

    sums = np.stack([per_row(spread[:, f]) for f in range(shape.num_factors)], axis=1)
    squares = per_row((spread**2).sum(axis=1))
    score = bias + per_row(values * linear[positions]) + 0.5 * ((sums**2).sum(axis=1) - squares)
    if task == CLASSIFICATION:
        margin = y * score
        loss = np.logaddexp(0.0, -margin).sum()
        pull = -y * np.exp(-np.logaddexp(0.0, margin))
    else:
        if bounds is not None:
            score = np.clip(score, *bounds)
        pull = score - y
        loss = 0.5 * (pull**2).sum()
    weighted = pull[rows] * values

    def per_position(x: np.ndarray) -> np.ndarray:
        return np.bincount(local, weights=x, minlength=len(touched))

    by_factor = np.stack([per_position(weighted * sums[rows, f]) for f in range(shape.num_factors)], axis=1) if len(touched) else own
    by_factor = by_factor - own * per_position(weighted * values)[:, None]
    return float(loss), touched, by_factor, per_position(weighted), float(pull.sum())


def blocks_of(total: np.ndarray, slot: int, block: int = BLOCK) -> pa.RecordBatch:
    """A vector of sums as rows (slot, block, sums); blocks of zeros alone are left out."""
    starts = [b for b in range(0, len(total), block) if total[b : b + block].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([slot] * len(starts), pa.int32()), pa.array([b // block for b in starts], pa.int32()), pa.array([total[b : b + block].tobytes() for b in starts], pa.binary())],
        ["slot", "block", "sums"],
    )


BLOCKS = "slot int, block int, sums binary"


def combine(partials: DataFrame, slots: int, depth: int, direct: int = DIRECT) -> DataFrame:
    """The sum of all slots for each block, over ``depth`` levels; up to ``direct`` slots stay as they are.

    On each level, slots that share a number meet in one task, block by block: no task holds more than
    one block and its running sum. As many meet on every level, so that none gets a row from every task.
    """
    fan_in = max(2, math.ceil(slots ** (1 / depth)))
    while slots > direct:
        slots = math.ceil(slots / fan_in) if slots > fan_in else 1
        met = partials.select((F.col("slot") % slots).cast("int").alias("slot"), "block", "sums")
        partials = met.repartition("slot", "block").sortWithinPartitions("slot", "block").mapInArrow(_add, BLOCKS)
    return partials


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, total = None, None
    for batch in batches:
        for slot, block, sums in zip(*[column.to_pylist() for column in batch.columns]):
            if (slot, block) != own:
                if own is not None:
                    yield _row(own, total)
                own, total = (slot, block), np.frombuffer(sums).copy()
            else:
                total += np.frombuffer(sums)
    if own is not None:
        yield _row(own, total)


def _row(own: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([own[0]], pa.int32()), pa.array([own[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "block", "sums"])


def summed(partials: DataFrame, slots: int, depth: int, size: int, block: int = BLOCK) -> np.ndarray:
    """The whole vector of sums on the driver, which gets at most ``DIRECT`` rows for each block.

    Of vectors shorter than a block it gets as many more, which are no more numbers.
    """
    total, combined = np.zeros(size), combine(partials, slots, depth, max(DIRECT, DIRECT * block // size))
    # Many blocks come partition by partition, never all at once.
    for row in combined.collect() if size <= DIRECT * block else combined.toLocalIterator():
        part = np.frombuffer(row["sums"])
        total[row["block"] * block : row["block"] * block + len(part)] += part
    return total


def numbered_partitions(rows: DataFrame) -> int:
    return max(1, rows.rdd.getNumPartitions())


def active_evaluator(
    rows: DataFrame, shape: Shape, task: int, bounds: tuple[float, float] | None = None, fraction: float = 1.0, seed: int = 0, depth: int = 2, block: int = BLOCK
):
    """Like ``fm.row_evaluator``, over rows of ``pack_active``: mean loss, mean gradient and rows for weight vectors."""
    slots = numbered_partitions(rows)

    def evaluate(candidates: Sequence[np.ndarray], iteration: int) -> list[tuple[float, np.ndarray, int]]:
        points, each = [np.asarray(c) for c in candidates], shape.size + 2

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, slot = np.zeros(len(points) * each), 0
            for batch in batches:
                slot = batch.column(3)[0].as_py()
                y = batch.column(0).to_numpy(zero_copy_only=False)
                pointers = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))])
                positions = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                if len(positions) and not 0 <= positions.min() <= positions.max() < shape.num_features:
                    raise ValueError(f"positions have to be from 0 to {shape.num_features - 1}")
                for number, flat in enumerate(points):
                    loss, touched, by_factor, by_linear, by_bias = sparse_loss_and_gradient(pointers, positions, values, y, shape, flat, task, bounds)
                    total = totals[number * each : (number + 1) * each]
                    total[:2] += loss, len(y)
                    factors = total[2 : 2 + shape.num_features * shape.num_factors].reshape(shape.num_features, -1)
                    factors[touched] += by_factor
                    if shape.use_linear:
                        total[2 + factors.size : 2 + factors.size + shape.num_features][touched] += by_linear
                    if shape.use_bias:
                        total[-1] += by_bias
            yield blocks_of(totals, slot, block)

        draw = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(iteration)), F.lit(_DRAWS))
        batch = rows if fraction == 1.0 else rows.filter(draw < int(fraction * _DRAWS))
        partials = batch.select("y", "positions", "values", F.spark_partition_id().alias("slot")).mapInArrow(partial, BLOCKS)
        totals = summed(partials, slots, depth, len(points) * each, block).reshape(len(points), -1)
        return [(t[0] / max(t[1], 1), t[2:] / max(t[1], 1), int(t[1])) for t in totals]

    return evaluate
