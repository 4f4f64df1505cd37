"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one more coordinate that makes all norms equal; then the highest inner products with a
query are the nearest vectors to it, and distances obey the triangle inequality. Each vector is
keyed by its nearest pivot and its distance to it, and sorted by that key over the cluster. A run of
one pivot's vectors (a segment) is cut into annuli. A query's search expands the annuli from its own
distance to the pivot outwards and stops where the triangle inequality rules out its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import scratch_path, ship_package

SAMPLE, PIVOTS = 2048, 64  # rows that pivots are chosen from, and how many are chosen
SEGMENT, ANNULUS, CHUNK = 4096, 256, 256  # vectors in a segment and in an annulus, queries in a chunk
_EXACT = 2.0**52


def scaled(vector: str | Column, factor: float = 256.0) -> Column:
    """``floor(factor * x)`` of each component; null where the vector is null or has a null, infinite or NaN one."""
    column = F.col(vector) if isinstance(vector, str) else vector
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(column.isNotNull() & ~odd, F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(factor))))


@dataclass(frozen=True)
class Space:
    """Pivots in the widened space, the square of the common norm, and the width of the vectors."""

    pivots: np.ndarray
    square: float
    width: int

    def widened(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - (vectors * vectors).sum(axis=1), 0.0))
        return np.column_stack([vectors, rest])

    def distances(self, points: np.ndarray) -> np.ndarray:
        inner = points @ self.pivots.T
        squares = (points * points).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)[None] - 2 * inner
        return np.sqrt(np.maximum(squares, 0.0))

    def query_distances(self, queries: np.ndarray) -> np.ndarray:
        return self.distances(np.column_stack([queries, np.zeros(len(queries))]))

    def bound(self, query_squares: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """The highest inner product of points at least ``apart`` from the query, with room for rounding."""
        return (query_squares + self.square - apart * apart) / 2 + 1e-6 * (self.square + query_squares + 1)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """An array column as a matrix; shorter rows end in zeros."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    lengths = np.diff(bounds)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(bounds[:-1] - bounds[0], lengths)] = values
    return out


def _farthest(points: np.ndarray, n: int) -> np.ndarray:
    """Points chosen one by one, each the farthest from those before."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    chosen = [points[0]]
    away = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(points[away.argmax()])
        away = np.minimum(away, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "vector", key: str = "vec_id", pivots: int = PIVOTS) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k best other rows.

    ``vectors`` has an integer key and an array of whole numbers; ``is_query`` says by the column
    ``vec_id`` which rows ask. Scores are exact inner products; ties go to the smaller key; a query has
    fewer rows if there are fewer others. Rows with a null key or vector take no part. Of rows with
    the same key, the one with the smallest vector counts. Shorter vectors count as ending in zeros, an
    empty one as zero. Components too large for exact sums raise. Other columns are not read.

    Pivots are chosen from a sample of 2,048 rows; all rows are indexed and nothing is left out.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    own = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<long>").alias("vector"))
    path = scratch_path(spark, "vectors")
    own.filter("vec_id is not null and vector is not null").groupBy("vec_id").agg(F.min("vector").alias("vector")).write.parquet(path)
    base = spark.read.parquet(path)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    stats = base.agg(F.max(squares).alias("square"), F.max(F.size("vector")).alias("width")).first()
    width, square = stats["width"] or 0, stats["square"] or 0.0
    if square >= _EXACT:
        raise ValueError("components are too large for exact inner products")
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("vector").combine_chunks()
    space = Space(np.zeros((0, width + 1)), square, width)
    chosen = _farthest(space.widened(_rows(sample, width)), pivots)
    space = Space(chosen, square, width)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = space.distances(space.widened(_rows(batch.column(1), width)))
            nearest = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(away)), nearest])], ["vec_id", "vector", "pivot", "dist"]
            )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def emit() -> Iterator[pa.RecordBatch]:
            ids, rows, near, away = (np.concatenate(c) for c in zip(*held))
            held.clear()
            out = []
            for p in np.unique(near):
                one = np.flatnonzero(near == p)
                for low in range(0, len(one), SEGMENT):
                    at = one[low : low + SEGMENT]
                    out.append((int(p), float(away[at[0]]), float(away[at[-1]]), int(ids[at].min()), ids[at].tobytes(), rows[at].tobytes(), away[at].tobytes()))
            names = ["pivot", "low", "high", "least_id", "ids", "vectors", "dists"]
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        n = 0
        for batch in batches:
            if len(batch):
                held.append((batch.column(0).to_numpy(), _rows(batch.column(1), width), batch.column(2).to_numpy(), batch.column(3).to_numpy()))
                n += len(batch)
            if n >= 4 * SEGMENT:
                yield from emit()
                n = 0
        if n:
            yield from emit()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = base.mapInArrow(keyed, "vec_id long, vector array<long>, pivot int, dist double").repartitionByRange(parts, "pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")
    path = scratch_path(spark, "segments")
    sorted_rows.mapInArrow(segments, "pivot int, low double, high double, least_id long, ids binary, vectors binary, dists binary").write.parquet(path)
    index = spark.read.parquet(path)
    # The range of distances of each pivot: as many rows as pivots.
    ranges = index.groupBy("pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    near, low, high = ranges["pivot"].to_numpy(int), ranges["low"].to_numpy(), ranges["high"].to_numpy()

    members = base.filter(is_query).mapInArrow(keyed, "vec_id long, vector array<long>, pivot int, dist double")

    def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(row["ids"], np.int64)
        return ids, np.frombuffer(row["vectors"], np.float64).reshape(len(ids), width), np.frombuffer(row["dists"], np.float64)

    def expand(query_ids, queries, floors, row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each query in one segment, as far as they can reach its floor."""
        ids, rows, dists = unpack(row)
        squares = (queries * queries).sum(axis=1)
        own = np.sqrt(np.maximum(squares + (space.pivots[row["pivot"]] ** 2).sum() - 2 * (queries @ space.pivots[row["pivot"], :width]), 0.0))
        starts = np.arange(0, len(ids), ANNULUS)
        inner, outer = dists[starts], dists[np.minimum(starts + ANNULUS, len(ids)) - 1]
        gap = np.maximum(np.maximum(inner[None] - own[:, None], own[:, None] - outer[None]), 0.0)
        bounds = space.bound(squares[:, None], gap)
        floors = floors.copy()
        best_scores = np.full((len(queries), k), -np.inf)
        best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        nearest = np.argsort(gap, axis=1, kind="stable")
        for step in range(len(starts)):  # each query's annuli from the nearest outwards
            ring = nearest[:, step]
            going = bounds[np.arange(len(queries)), ring] >= floors
            for r in np.unique(ring[going]):
                who = np.flatnonzero(going & (ring == r))
                at = slice(starts[r], starts[r] + ANNULUS)
                scores = queries[who] @ rows[at].T
                scores[query_ids[who][:, None] == ids[at][None]] = -np.inf
                every = np.concatenate([best_scores[who], scores], axis=1)
                names = np.concatenate([best_ids[who], np.broadcast_to(ids[at], scores.shape)], axis=1)
                order = np.lexsort((names, -every), axis=1)[:, :k]
                best_scores[who], best_ids[who] = np.take_along_axis(every, order, 1), np.take_along_axis(names, order, 1)
                floors[who] = np.maximum(floors[who], best_scores[who, -1])
        q, place = np.nonzero(best_scores > -np.inf)
        return query_ids[q], best_ids[q, place], best_scores[q, place]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["queries"], np.float64).reshape(len(ids), width)
                found = expand(ids, queries, np.frombuffer(row["floors"], np.float64), row)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    def visits(queries: DataFrame, opening: bool) -> DataFrame:
        """What queries find in the segments they visit: those of their nearest pivot at the opening, then
        those of each other pivot that the triangle inequality doesn't rule out as a whole."""

        def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, len(batch), CHUNK):
                    part = batch.slice(start, CHUNK)
                    ids, points = part.column(0).to_numpy(), _rows(part.column(1), width)
                    home = part.column(2).to_numpy()[:, None] == near[None]
                    floors = part.column(3).fill_null(-np.inf).to_numpy()
                    own = space.query_distances(points)[:, near]
                    gap = np.maximum(np.maximum(low[None] - own, own - high[None]), 0.0)
                    reach = space.bound((points * points).sum(axis=1)[:, None], gap) >= floors[:, None]
                    visit = home if opening else reach & ~home
                    out = [(int(near[p]), ids[w].tobytes(), points[w].tobytes(), floors[w].tobytes()) for p in range(len(near)) if len(w := np.flatnonzero(visit[:, p]))]
                    if out:
                        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["pivot", "query_ids", "queries", "floors"])

        chunks = queries.mapInArrow(chunk, "pivot int, query_ids binary, queries binary, floors binary")
        return chunks.join(index, "pivot").mapInArrow(search, "query_id long, vec_id long, score double")

    path = scratch_path(spark, "opening")
    visits(members.withColumn("floor", F.lit(None).cast("double")), True).write.parquet(path)
    opened = spark.read.parquet(path)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    floors = ranked(opened).filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    asking = members.join(floors, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "vector", "pivot", "floor")
    found = ranked(opened.unionByName(visits(asking, False)))
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
