"""Running totals per key that stay balanced when one key holds much of the table.

A plain window ``PARTITION BY key ORDER BY time`` puts a whole key into one task. Here the order
axis is cut into chunks of about equal row count, and keys with more rows than a chunk (there can't
be more of them than chunks) are split by chunk: the window runs inside each (key, chunk), and a
chunk starts from one carried row that holds the totals of the key's earlier chunks. All other keys
stay whole. The result is exact whatever the cuts are: they only decide how the work is spread.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import materialise, small

CHUNK = "_chunk"
_CARRY, _OWN = "_carry", "_own"
# What a task can sort at ease; 10**12 rows make 10**6 chunks.
ROWS_PER_CHUNK = 1_000_000


def chunks_for(rows: int) -> int:
    """As many chunks as the rows fill."""
    return max(1, math.ceil(rows / ROWS_PER_CHUNK))


def _as_number(df: DataFrame, name: str) -> Column:
    """A double that never decreases along the column's order; nulls come first, as they sort."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        col = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    elif isinstance(kind, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif not isinstance(kind, T.NumericType):
        raise ValueError(f"cannot cut {name} of type {kind.simpleString()} into ordered chunks")
    return F.coalesce(col.cast("double"), F.lit(float("-inf")))


def _cuts(df: DataFrame, name: str, chunks: int) -> list[float]:
    """Approximate quantiles, repeats included: a value listed twice holds more than a chunk."""
    grid = [i / chunks for i in range(1, chunks)]
    if not grid:
        return []
    return sorted(q for q in df.approxQuantile(name, grid, 0.5 / chunks) if q < math.inf)


def _bucket(df: DataFrame, source: str, target: str, cuts: Sequence[float]) -> DataFrame:
    splits = sorted({float("-inf"), *cuts, float("inf")})
    if len(splits) == 2:
        return df.withColumn(target, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=source, outputCol=target, handleInvalid="keep").transform(df)


def with_chunks(df: DataFrame, order_by: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Add ``_chunk``, a number that never decreases along ``order_by`` (at most two columns count).

    One pass finds the cuts. When a single value of the first column holds more than a chunk, rows
    of that value are cut further along the second column.
    """
    chunks = chunks or chunks_for(df.count())
    first = df.withColumn("_x1", _as_number(df, order_by[0]))
    cuts = _cuts(first, "_x1", chunks)
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b}) if len(order_by) > 1 else []
    # A heavy value gets a bucket of its own, closed by the next representable number.
    cuts += [math.nextafter(h, math.inf) for h in heavy]
    out = _bucket(first, "_x1", "_b1", cuts)
    inner: Column = F.lit(0)
    width = 1
    if heavy:
        is_heavy = F.col("_x1").isin(heavy)
        out = out.withColumn("_x2", _as_number(df, order_by[1]))
        inner_cuts = _cuts(out.filter(is_heavy), "_x2", chunks)
        width = len(inner_cuts) + 2
        out = _bucket(out, "_x2", "_b2", inner_cuts)
        inner = F.when(is_heavy, F.col("_b2").cast("bigint")).otherwise(0)
    chunk = F.col("_b1").cast("bigint") * width + inner
    return out.withColumn(CHUNK, chunk).drop("_x1", "_x2", "_b1", "_b2")


def totals_before(
    df: DataFrame,
    order_by: Sequence[str],
    groups: Sequence[tuple[Sequence[str], Mapping[str, Column]]],
    rows_per_key: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add, for each group, the totals over the rows of the same key that come strictly before.

    ``df`` carries ``_chunk`` from :func:`with_chunks` over the same ``order_by``, which must order
    rows uniquely. ``groups`` lists (key columns, {new column: value to sum}); a row with nothing
    before it gets 0. Keys of more than ``rows_per_key`` rows are split by chunk. A group whose keys
    include those of the group before is split like it, so that both windows share one exchange.
    """
    hot = _hot_keys(df, groups, rows_per_key)
    # Keys that are split read the table several times.
    out, base = materialise(df, "chunked") if any(hot.values()) else df, None
    for keys, totals in groups:
        if base is None or not base or not set(base) <= set(keys):
            base = list(keys)
            out = _split(out, base, hot[tuple(base)])
        values = {f"_v_{name}": value for name, value in totals.items()}
        if hot[tuple(base)] is None:
            before = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
            out = out.withColumns({name: F.coalesce(F.sum(value).over(before), F.lit(0)) for name, value in totals.items()})
            continue
        # Only split keys have rows outside chunk 0, and only they carry anything on.
        split = out.filter(F.col(_OWN).isNotNull())
        per_chunk = split.groupBy(*keys, _OWN).agg(*[F.sum(v).alias(n) for n, v in values.items()])
        along = Window.partitionBy(*keys).orderBy(_OWN)
        carry = per_chunk.select(
            *keys, _OWN, F.lit(True).alias(_CARRY),
            *[F.sum(n).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias(n) for n in values],
            F.row_number().over(along).alias("_nth"),
        ).filter("_nth > 1").drop("_nth")
        rows = out.withColumns({**values, _CARRY: F.lit(False)}).unionByName(carry, allowMissingColumns=True)
        before = (
            Window.partitionBy(*keys, _OWN)
            .orderBy(F.desc(_CARRY), *order_by)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        out = (
            rows.withColumns({
                name: F.coalesce(F.sum(f"_v_{name}").over(before), F.lit(0)) for name in totals
            })
            .filter(~F.col(_CARRY))
            .drop(_CARRY, *values)
        )
    return out.drop(_OWN)


def _bases(groups: Sequence[tuple[Sequence[str], Mapping[str, Column]]]) -> list[tuple[str, ...]]:
    """The keys by which groups are split: their own, or those of an earlier group that they include."""
    found: list[tuple[str, ...]] = []
    for keys, _ in groups:
        if not found or not found[-1] or not set(found[-1]) <= set(keys):
            found.append(tuple(keys))
    return found


def _hot_keys(df: DataFrame, groups: Sequence[tuple[Sequence[str], Mapping[str, Column]]], rows_per_key: int) -> dict[tuple[str, ...], DataFrame | None]:
    """For each base, its keys of more than ``rows_per_key`` rows, or None if there are none: one pass for all bases."""
    bases = list(dict.fromkeys(_bases(groups)))
    columns = list(dict.fromkeys(c for base in bases for c in base))
    rows = df.select(*columns, F.lit(1).alias("_one"))
    if columns:
        sets = [[F.col(c) for c in base] for base in bases]
        counts = rows.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), F.count("*").alias("_n"))
    else:
        counts = rows.agg(F.lit(0).alias("_set"), F.count("*").alias("_n"))
    # At most one key for each rows_per_key rows of the table.
    found = materialise(counts.filter(F.col("_n") > rows_per_key), "hot-keys")
    held = {row["_set"] for row in found.select("_set").distinct().collect()}
    # A column's bit is set where it isn't among the keys.
    number = {base: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in base) for base in bases}
    return {base: found.filter(F.col("_set") == number[base]).select(*base, "_n") if number[base] in held else None for base in bases}


def _split(df: DataFrame, keys: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Add ``_own``: the chunk for rows of hot keys, null for the rest."""
    df = df.drop(_OWN)
    if hot is None:
        return df.withColumn(_OWN, F.lit(None).cast("bigint"))
    if not keys:
        return df.withColumn(_OWN, F.col(CHUNK))
    named = hot.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], F.lit(True).alias("_hot"))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)]
    joined = df.join(small(named), same, "left")
    return joined.withColumn(_OWN, F.when(F.col("_hot"), F.col(CHUNK))).drop("_hot", *[f"_hot_{i}" for i in range(len(keys))])
