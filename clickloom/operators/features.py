"""Feature stages: three vector layouts out of the sample table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSizeHint,
)
from pyspark.sql import DataFrame

from clickloom.operators.quantiles import QuantileCuts
from clickloom.operators.transformers import EmbeddingCosine, EmbeddingHadamard, EmbeddingsToVectors
from clickloom.session import VECTOR_ROWS, materialise

EMBEDDINGS = ["user_embedding", "item_embedding"]
RAW_INPUTS = ["content_type", "item_ctr", "user_item_click", "user_item_imp", "is_new_user", *EMBEDDINGS]
LAYOUTS = ("base", "inner", "outer")
FEATURES = "scaledFeatures"
_COMMON = ["content_type_onehot", "ctr_bucket", "user_item_click", "user_item_imp", "is_new_user"]


def embedding_stages(layout: str, dim: int) -> tuple[list, list[str]]:
    """The stages that prepare the embeddings of a layout, and the columns they add to the vector."""
    if layout == "base":
        hints = [VectorSizeHint(inputCol=c, size=dim, handleInvalid="error") for c in EMBEDDINGS]
        return [EmbeddingsToVectors(inputCols=EMBEDDINGS), *hints], EMBEDDINGS
    if layout == "inner":
        out = "embedding_inner_product"
        return [EmbeddingCosine(inputCols=EMBEDDINGS, outputCol=out)], [out]
    if layout == "outer":
        out = "embedding_outer_product"
        hint = VectorSizeHint(inputCol=out, size=dim, handleInvalid="error")
        return [EmbeddingHadamard(inputCols=EMBEDDINGS, outputCol=out), hint], [out]
    raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def embedding_ranges(layout: str, width: int, dim: int) -> list[tuple[int, int]]:
    """Where the embeddings, or their product, are in a layout's vector of that width."""
    count = {"base": 2, "inner": 0, "outer": 1}[layout]
    return [(width - n * dim, width - (n - 1) * dim) for n in range(count, 0, -1)]


def feature_stages(
    layout: str,
    dim: int,
    num_buckets: int = 100,
    relative_error: float = 0.001,
    scaler: str = "minmax",
    unseen: str = "error",
) -> list:
    """Unfitted stages of a layout.

    ``dim`` is the embedding width: it sizes the vectors up front, so that no job runs to find it
    and the same stages work on a stream. ``unseen`` is "error" or "keep" for content types that
    were not in the training table.
    """
    stages, tail = embedding_stages(layout, dim)
    scalers = {
        "minmax": lambda: MinMaxScaler(inputCol="vectorFeature", outputCol=FEATURES),
        "standard": lambda: StandardScaler(
            inputCol="vectorFeature", outputCol=FEATURES, withMean=True, withStd=True
        ),
    }
    if scaler not in scalers:
        raise ValueError(f"scaler must be one of {sorted(scalers)}, not {scaler!r}")
    return [
        *stages,
        StringIndexer(inputCol="content_type", outputCol="content_type_index", handleInvalid=unseen),
        OneHotEncoder(inputCols=["content_type_index"], outputCols=["content_type_onehot"], dropLast=False),
        QuantileCuts("item_ctr", "ctr_bucket", num_buckets, relative_error),
        VectorAssembler(inputCols=[*_COMMON, *tail], outputCol="vectorFeature"),
        scalers[scaler](),
    ]


def fit_features(samples: DataFrame, layout: str, dim: int, **options) -> PipelineModel:
    """Fit the stages of a layout. Only the columns the layout reads are scanned."""
    return Pipeline(stages=feature_stages(layout, dim, **options)).fit(samples.select(*RAW_INPUTS))


def fit_and_prepare(samples: DataFrame, layout: str, dim: int, label: str, **options) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages of a layout, and feature vector and label of every sample.

    The vectors are made once: they are stored before the scaler, which is fitted on the stored table and applied
    as it is read. Both are those of :func:`fit_features`.
    """
    *making, scaler = feature_stages(layout, dim, **options)
    made = Pipeline(stages=making).fit(samples.select(*RAW_INPUTS))
    inputs = samples.select(*dict.fromkeys([*RAW_INPUTS, label]))
    stored = materialise(made.transform(inputs).select(scaler.getInputCol(), label), "prepared", VECTOR_ROWS)
    scaled = scaler.fit(stored)
    return PipelineModel(stages=[*made.stages, scaled]), scaled.transform(stored).select(FEATURES, label)


def vector_width(df: DataFrame, column: str = FEATURES) -> int:
    """Width of a vector column, read from its metadata."""
    width = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if width is None:
        raise ValueError(f"column {column} carries no width; put a VectorSizeHint before it")
    return int(width)


def require_width(df: DataFrame, column: str, width: int) -> None:
    found = vector_width(df, column)
    if found != width:
        raise ValueError(f"column {column} has {found} values, the model expects {width}")


def categorical_features(df: DataFrame, column: str = FEATURES) -> dict[int, int]:
    """Position -> number of categories, as tree learners read it from a vector column's metadata."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: 2 for a in groups.get("binary", [])}
    for attr in groups.get("nominal", []):
        size = attr.get("num_vals", len(attr.get("vals", [])))
        if not size:
            raise ValueError(f"feature {attr['idx']} is nominal but names no number of values")
        found[attr["idx"]] = size
    return found
