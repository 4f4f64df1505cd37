"""The sample table: one row per impression, with the history features and the click label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SAMPLE_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_item_click", T.LongType()),
    T.StructField("user_item_imp", T.DoubleType()),
    T.StructField("item_ctr", T.DoubleType()),
    T.StructField("is_new_user", T.IntegerType()),
    T.StructField("user_embedding", T.ArrayType(T.DoubleType())),
    T.StructField("item_embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()),
])

FORMATS = ("orc", "parquet")


def read_samples(
    spark: SparkSession, path: str, fmt: str = "orc", extra: T.StructType | None = None
) -> DataFrame:
    """Scan a sample table. ``extra`` names further columns to carry, such as a row key."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    schema = T.StructType(SAMPLE_SCHEMA.fields + (extra.fields if extra else []))
    return spark.read.schema(schema).format(fmt).load(path)


def write_samples(samples: DataFrame, path: str, fmt: str = "orc", mode: str = "errorifexists") -> None:
    """Write a sample table, snappy-compressed."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    samples.write.mode(mode).option("compression", "snappy").format(fmt).save(path)


def check_schema(samples: DataFrame, labelled: bool = True) -> DataFrame:
    """Refuse a table that lacks a sample column or holds it under another type.

    Extra columns are welcome; array and numeric widths may differ where Spark can widen them.
    """
    have = {f.name: f.dataType for f in samples.schema.fields}
    wanted = [f for f in SAMPLE_SCHEMA.fields if labelled or f.name != "label"]
    missing = [f.name for f in wanted if f.name not in have]
    if missing:
        raise ValueError(f"sample table lacks columns: {', '.join(missing)}")
    wrong = [
        f"{f.name} is {have[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in wanted
        if not _compatible(have[f.name], f.dataType)
    ]
    if wrong:
        raise ValueError("sample table has wrong types: " + "; ".join(wrong))
    return samples


def _compatible(have: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.ArrayType):
        # An embedding may already be an ML vector.
        return have.typeName() == "vector" or (
            isinstance(have, T.ArrayType) and isinstance(have.elementType, T.NumericType)
        )
    if isinstance(wanted, T.NumericType):
        return isinstance(have, T.NumericType)
    return have == wanted


def preview(samples: DataFrame, rows: int = 10) -> DataFrame:
    """Print the schema and return the first rows as a table."""
    samples.printSchema()
    return samples.limit(rows)
