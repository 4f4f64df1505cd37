"""The nine click models: a feature layout each, and an estimator on top of it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.sql import DataFrame

from clickloom.operators.features import FEATURES, RAW_INPUTS, embedding_ranges, feature_stages, vector_width
from clickloom.operators.features import fit_and_prepare as fit_features
from clickloom.operators.gbtlr import GBTLRClassifier
from clickloom.operators.network import BlockFM, BlockNetwork
from clickloom.session import VECTOR_ROWS, materialise

SEED = 1234


@dataclass(frozen=True)
class ModelSpec:
    """``make(width, label)`` gives the unfitted estimator for a feature vector of that width."""

    name: str
    layout: str
    make: Callable[[int, str], Estimator]


def _network(width: int, label: str) -> Estimator:
    return BlockNetwork(
        featuresCol=FEATURES, labelCol=label, layers=[width, width // 2, 2], blockSize=128, seed=SEED,
        maxIter=150, stepSize=0.005,
    )


def _logistic(width: int, label: str) -> Estimator:
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=label, maxIter=20, regParam=0.0, elasticNetParam=0.0
    )


def _bayes(width: int, label: str) -> Estimator:
    return NaiveBayes(featuresCol=FEATURES, labelCol=label)


def _forest(width: int, label: str) -> Estimator:
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=10, maxDepth=4, seed=SEED)


def _boosted(width: int, label: str) -> Estimator:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, maxIter=10, featureSubsetStrategy="auto", seed=SEED
    )


def _boosted_logistic(width: int, label: str) -> Estimator:
    return GBTLRClassifier(
        featuresCol=FEATURES, labelCol=label, gbtMaxIter=10, lrMaxIter=100, regParam=0.01, elasticNetParam=0.5,
        seed=SEED,
    )


def _factorization(width: int, label: str) -> Estimator:
    return BlockFM(
        featuresCol=FEATURES, labelCol=label, factorSize=2, fitIntercept=True, fitLinear=True, regParam=0.0,
        miniBatchFraction=1.0, initStd=0.1, maxIter=200, stepSize=0.15, tol=0.0, solver="gd", seed=SEED,
    )


MODELS = {
    spec.name: spec
    for spec in (
        ModelSpec("lr", "base", _logistic),
        ModelSpec("nb", "base", _bayes),
        ModelSpec("fm", "inner", _factorization),
        ModelSpec("rf", "base", _forest),
        ModelSpec("gbdt", "base", _boosted),
        ModelSpec("gbtlr", "inner", _boosted_logistic),
        ModelSpec("nn", "base", _network),
        ModelSpec("ipnn", "inner", _network),
        ModelSpec("opnn", "outer", _network),
    )
}


class CtrModel:
    """An unfitted click model over a raw sample table.

    ``layout`` and ``estimator`` replace the registered ones; ``dim`` is the embedding width, and
    further options go to the feature stages.
    """

    def __init__(
        self,
        name: str,
        dim: int,
        label: str = "label",
        layout: str | None = None,
        estimator: Callable[[int, str], Estimator] | None = None,
        **feature_options,
    ):
        if name not in MODELS:
            raise ValueError(f"model must be one of {sorted(MODELS)}, not {name!r}")
        self.name, self.dim, self.label = name, dim, label
        self.layout = layout or MODELS[name].layout
        self.make = estimator or MODELS[name].make
        self.feature_options = feature_options

    def feature_stages(self) -> list:
        return feature_stages(self.layout, self.dim, **self.feature_options)

    def fit(self, samples: DataFrame) -> PipelineModel:
        """Fit features, then the estimator, into one pipeline from raw samples to probabilities.

        ``samples`` had best be a stored table: a few passes read it, each only its own columns.
        """
        return self.fit_prepared(*fit_features(samples, self.layout, self.dim, self.label, **self.feature_options))

    def fit_prepared(self, features: PipelineModel, prepared: DataFrame) -> PipelineModel:
        """Fit the estimator alone, on the table that fitted features have prepared."""
        width = vector_width(prepared)
        estimator = self.make(width, self.label)
        if isinstance(estimator, BlockNetwork):
            estimator.shared = embedding_ranges(self.layout, width, self.dim)
        return PipelineModel(stages=[*features.stages, estimator.fit(prepared)])


def fit_models(samples: DataFrame, dim: int, names: Sequence[str], label: str = "label", **feature_options) -> Iterator[tuple[str, PipelineModel]]:
    """Each model of ``names``, fitted like ``CtrModel.fit``.

    The features of a layout are fitted once for all its models, and its vectors are written once.
    """
    prepared = {}
    for model in (CtrModel(name, dim, label, **feature_options) for name in names):
        if model.layout not in prepared:
            prepared[model.layout] = fit_features(samples, model.layout, dim, label, **feature_options)
        yield model.name, model.fit_prepared(*prepared[model.layout])


def prepared_table(features: PipelineModel, samples: DataFrame, label: str) -> DataFrame:
    """Feature vector and label of every sample, written out for the iterations to read."""
    inputs = samples.select(*dict.fromkeys([*RAW_INPUTS, label]))
    prepared = features.transform(inputs).select(FEATURES, label)
    return materialise(prepared, "prepared", VECTOR_ROWS)
