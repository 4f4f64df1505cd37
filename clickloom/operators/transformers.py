"""Pipeline stages for the embedding columns. They save and load with the pipeline."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.embeddings import as_array, as_vector, cosine, hadamard, to_vectors


class EmbeddingsToVectors(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Array embeddings to ML vectors, in place."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return to_vectors(dataset, tuple(self.getInputCols()))


class _EmbeddingProduct(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A new column from two embeddings, which are then dropped."""

    def __init__(self, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if outputCol is not None:
            self._set(outputCol=outputCol)

    def _product(self, a: Column, b: Column) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getInputCols()
        arrays = {f"_{name}_array": as_array(dataset, name) for name in names}
        product = self._product(*[F.col(a) for a in arrays])
        return dataset.withColumns(arrays).withColumn(self.getOutputCol(), product).drop(*arrays, *names)


class EmbeddingCosine(_EmbeddingProduct):
    """Cosine similarity of the two embeddings."""

    def _product(self, a: Column, b: Column) -> Column:
        return cosine(a, b)


class EmbeddingHadamard(_EmbeddingProduct):
    """Element-wise product of the two embeddings, as a vector."""

    def _product(self, a: Column, b: Column) -> Column:
        return as_vector(hadamard(a, b))
