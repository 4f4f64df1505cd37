"""Active entries of feature vectors: what a sparse vector holds, as arrays or as rows.

A feature column is an ML vector, dense or sparse, or a struct of ``indices`` (array of int) and ``values``
(array of double). Zeros are left out, since a factorization machine doesn't see them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.embeddings import is_vector
from clickloom.operators.features import vector_width


def is_active_struct(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, T.StructType) and set(kind.fieldNames()) == {"indices", "values"}


def width_of(df: DataFrame, column: str, num_features: int = 0) -> int:
    """Number of positions: as given, or as the vector's metadata says."""
    if num_features:
        return num_features
    if is_active_struct(df, column):
        raise ValueError(f"column {column} carries no width; set numFeatures")
    return vector_width(df, column)


def active(df: DataFrame, column: str) -> Column:
    """The entries that aren't zero, as an array of (position int, value double); the job fails on a null vector."""
    if is_active_struct(df, column):
        indices, values = F.col(column)["indices"], F.col(column)["values"]
    elif is_vector(df, column):
        inner = F.unwrap_udt(column)
        values = inner["values"]
        every = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
        # A dense vector has no indices.
        indices = F.coalesce(inner["indices"], every)
    else:
        raise ValueError(f"column {column} is neither a vector nor a struct of indices and values")
    pairs = F.zip_with(indices, values, lambda i, v: F.struct(i.cast("int").alias("position"), v.cast("double").alias("value")))
    held = F.filter(pairs, lambda e: e["value"] != 0.0)
    return F.when(F.col(column).isNull(), F.raise_error(F.lit(f"features {column} are null"))).otherwise(held)


def active_rows(df: DataFrame, column: str, key: str, num_features: int) -> DataFrame:
    """``key``, ``position``, ``value``: one row for each active entry. A position out of range fails the job."""
    rows = df.select(F.col(key).alias("key"), F.explode(active(df, column)).alias("entry"))
    position = F.col("entry.position")
    outside = F.raise_error(F.concat(F.lit(f"a position is not below {num_features}: "), position.cast("string")))
    return rows.select("key", F.when(position.between(0, num_features - 1), position).otherwise(outside).alias("position"), F.col("entry.value").alias("value"))
