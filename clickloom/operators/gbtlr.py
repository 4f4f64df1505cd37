"""Boosted trees whose leaves become features of a logistic regression.

Trees are grown on the features; each row is then described by the leaf it reaches in every tree.
The logistic regression reads the original features followed by one 0/1 entry per leaf, kept sparse.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasAggregationDepth,
    HasCheckpointInterval,
    HasElasticNetParam,
    HasFeaturesCol,
    HasFitIntercept,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasRegParam,
    HasSeed,
    HasStandardization,
    HasStepSize,
    HasThreshold,
    HasThresholds,
    HasTol,
    HasWeightCol,
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
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.labels import require_binary
from clickloom.operators.checks import at_least, between, one_of, positive_whole
from clickloom.operators.features import vector_width
from clickloom.operators.leaf_rules import leaf_rules, with_weights
from clickloom.session import VECTOR_ROWS, cached, materialise, scratch_path

_LEAVES, _TOKENS, _ONE_HOT, _LABEL = "_gbt_leaves", "_gbt_tokens", "_gbt_one_hot", "_gbt_label"


def _own(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, converter)


class _GBTLRParams(
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasWeightCol,
    HasThreshold, HasThresholds, HasElasticNetParam, HasRegParam, HasTol, HasFitIntercept, HasStandardization,
    HasAggregationDepth, HasCheckpointInterval, HasSeed, HasStepSize,
):
    whole = TypeConverters.toInt
    maxDepth = _own("maxDepth", "depth of each tree", between(0, 30, whole))
    maxBins = _own("maxBins", "bins per continuous feature", at_least(2, whole))
    minInstancesPerNode = _own("minInstancesPerNode", "fewest rows in a child node", positive_whole)
    minInfoGain = _own("minInfoGain", "smallest gain that splits a node", at_least(0.0))
    maxMemoryInMB = _own("maxMemoryInMB", "memory for one round of node statistics", at_least(0, whole))
    cacheNodeIds = _own("cacheNodeIds", "keep the node of every row between levels", TypeConverters.toBoolean)
    subsamplingRate = _own("subsamplingRate", "share of rows for each tree", between(0.0, 1.0, open_low=True))
    lossType = _own("lossType", "loss of the boosting", one_of("logistic", convert=TypeConverters.toString))
    gbtMaxIter = _own("gbtMaxIter", "number of trees", positive_whole)
    lrMaxIter = _own("lrMaxIter", "iterations of the logistic regression", at_least(0, whole))
    family = _own(
        "family", "label distribution of the logistic regression",
        one_of("auto", "binomial", "multinomial", convert=TypeConverters.toString),
    )
    gbtGeneratedFeaturesCol = _own(
        "gbtGeneratedFeaturesCol", "column of features plus leaves", TypeConverters.toString
    )
    weightTrees = _own("weightTrees", "use the row weights for the trees too", TypeConverters.toBoolean)
    # Shared params, with ranges.
    stepSize = _own("stepSize", "learning rate of the boosting", between(0.0, 1.0, open_low=True))
    regParam = _own("regParam", "penalty of the logistic regression", at_least(0.0))
    elasticNetParam = _own("elasticNetParam", "0 for L2, 1 for L1", between(0.0, 1.0))
    tol = _own("tol", "tolerance of the logistic regression", at_least(0.0))
    threshold = _own("threshold", "P(1) above which the prediction is 1", between(0.0, 1.0))
    aggregationDepth = _own("aggregationDepth", "depth of the tree aggregate", at_least(2, whole))

    def __init__(self):
        super().__init__()
        self._setDefault(
            maxDepth=5, maxBins=32, minInstancesPerNode=1, minInfoGain=0.0, maxMemoryInMB=256, cacheNodeIds=False,
            subsamplingRate=1.0, lossType="logistic", gbtMaxIter=20, lrMaxIter=100, family="auto", stepSize=0.1,
            regParam=0.0, elasticNetParam=0.0, tol=1e-6, threshold=0.5, aggregationDepth=2, checkpointInterval=10,
            fitIntercept=True, standardization=True, gbtGeneratedFeaturesCol="gbt_generated_features",
            weightTrees=False, seed=17,
        )

    def setParams(self, **params):
        """Set any params by name; ``threshold`` and ``thresholds`` replace one another."""
        if "threshold" in params and "thresholds" in params:
            raise ValueError("set either threshold or thresholds")
        if "threshold" in params:
            self.clear(self.thresholds)
        if "thresholds" in params:
            self.clear(self.threshold)
        return self._set(**params)

    def _set(self, **params):
        pair = params.get("thresholds")
        if pair is not None and (any(t < 0 for t in pair) or sum(t == 0 for t in pair) > 1):
            raise ValueError(f"thresholds must be at least 0, with one 0 at most, not {pair}")
        interval = params.get("checkpointInterval")
        if interval is not None and interval != -1 and interval < 1:
            raise ValueError(f"checkpointInterval must be -1 or at least 1, not {interval}")
        return super()._set(**params)

    def setThreshold(self, value: float):
        return self.setParams(threshold=value)

    def setThresholds(self, value: list[float]):
        return self.setParams(thresholds=value)

    def getThreshold(self) -> float:
        """The threshold, also where it was given as a pair of thresholds."""
        if self.isSet(self.thresholds):
            pair = self.getOrDefault(self.thresholds)
            if len(pair) != 2:
                raise ValueError("thresholds must hold two values")
            # P(1) wins where p / pair[1] > (1 - p) / pair[0]; a zero in second place means always.
            return 0.0 if pair[1] == 0.0 else 1.0 / (1.0 + pair[0] / pair[1])
        return self.getOrDefault(self.threshold)

    def getThresholds(self) -> list[float]:
        if self.isSet(self.thresholds):
            return self.getOrDefault(self.thresholds)
        t = self.getOrDefault(self.threshold)
        return [1.0 - t, t]


def leaf_counts(trees: GBTClassificationModel) -> list[int]:
    """Leaves of each fitted tree; a binary tree of n nodes has (n + 1) / 2."""
    return [(tree.numNodes + 1) // 2 for tree in trees.trees]


def add_leaf_features(dataset: DataFrame, trees: GBTClassificationModel, features: str, output: str) -> DataFrame:
    """Append the vector [features, leaves of tree 0, leaves of tree 1, ...]."""
    vocabulary = [f"{t}:{leaf}" for t, count in enumerate(leaf_counts(trees)) for leaf in range(count)]
    one_hot = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=_TOKENS, outputCol=_ONE_HOT)
    assembler = VectorAssembler(inputCols=[features, _ONE_HOT], outputCol=output)
    reached = _leaf_only(trees, features).transform(dataset)
    tokens = F.transform(
        vector_to_array(_LEAVES),
        lambda leaf, t: F.concat(t.cast("string"), F.lit(":"), leaf.cast("int").cast("string")),
    )
    described = one_hot.transform(reached.withColumn(_TOKENS, tokens))
    return assembler.transform(described).drop(_LEAVES, _TOKENS, _ONE_HOT)


def _leaf_only(trees: GBTClassificationModel, features: str) -> GBTClassificationModel:
    """The trees set to output nothing but leaf positions."""
    silent = {p: "" for p in (trees.predictionCol, trees.probabilityCol, trees.rawPredictionCol)}
    return trees.copy({**silent, trees.featuresCol: features, trees.leafCol: _LEAVES})


class GBTLRClassifier(Estimator, _GBTLRParams, DefaultParamsReadable, DefaultParamsWritable):
    """Trees first, then the logistic regression; all params are named at :class:`_GBTLRParams`."""

    def __init__(self, **params):
        super().__init__()
        self.setParams(**params)

    def _trees(self) -> GBTClassifier:
        get = self.getOrDefault
        trees = GBTClassifier(
            featuresCol=get("featuresCol"), labelCol=_LABEL, maxDepth=get("maxDepth"), maxBins=get("maxBins"),
            minInstancesPerNode=get("minInstancesPerNode"), minInfoGain=get("minInfoGain"),
            maxMemoryInMB=get("maxMemoryInMB"), cacheNodeIds=get("cacheNodeIds"),
            checkpointInterval=get("checkpointInterval"), lossType=get("lossType"), impurity="variance",
            maxIter=get("gbtMaxIter"), stepSize=get("stepSize"), subsamplingRate=get("subsamplingRate"),
            seed=get("seed"),
        )
        if self.isSet(self.weightCol) and get("weightTrees"):
            trees.setWeightCol(get("weightCol"))
        return trees

    def _regression(self) -> LogisticRegression:
        get = self.getOrDefault
        regression = LogisticRegression(
            featuresCol=get("gbtGeneratedFeaturesCol"), labelCol=_LABEL, predictionCol=get("predictionCol"),
            probabilityCol=get("probabilityCol"), rawPredictionCol=get("rawPredictionCol"),
            maxIter=get("lrMaxIter"), regParam=get("regParam"), elasticNetParam=get("elasticNetParam"),
            tol=get("tol"), fitIntercept=get("fitIntercept"), family=get("family"),
            standardization=get("standardization"), aggregationDepth=get("aggregationDepth"),
        )
        if self.isSet(self.weightCol):
            regression.setWeightCol(get("weightCol"))
        if self.isSet(self.thresholds):
            regression.setThresholds(get("thresholds"))
        elif self.isSet(self.threshold):
            regression.setThreshold(get("threshold"))
        return regression

    def _fit(self, dataset: DataFrame) -> GBTLRClassificationModel:
        features, output = self.getFeaturesCol(), self.getOrDefault("gbtGeneratedFeaturesCol")
        weight = [self.getOrDefault("weightCol")] if self.isSet(self.weightCol) else []
        points = dataset.select(require_binary(self.getLabelCol()).alias(_LABEL), features, *weight)
        with cached(points):
            trees = self._trees().fit(points)
            described = materialise(add_leaf_features(points, trees, features, output), "leaves", VECTOR_ROWS)
            regression = self._regression().fit(described)
        model = self._copyValues(GBTLRClassificationModel(trees, regression))
        model._resetUid(self.uid)
        model._training_summary = GBTLRTrainingSummary(described, regression.summary, trees)
        return model


class GBTLRTrainingSummary:
    """What training left behind: the described rows, the regression's summary, the trees."""

    def __init__(self, dataset: DataFrame, regression, trees: GBTClassificationModel):
        self.dataset = dataset
        self.regression = regression
        self.trees = trees.trees
        self.tree_weights = trees.treeWeights


class GBTLRClassificationModel(Model, _GBTLRParams, MLWritable, MLReadable):
    """Scores rows: adds features plus leaves, raw prediction, probability and prediction."""

    def __init__(self, trees: GBTClassificationModel, regression: LogisticRegressionModel):
        super().__init__()
        self.trees, self.regression = trees, regression
        self._training_summary: GBTLRTrainingSummary | None = None

    @property
    def hasSummary(self) -> bool:
        return self._training_summary is not None

    @property
    def summary(self) -> GBTLRTrainingSummary:
        if self._training_summary is None:
            raise RuntimeError("this model carries no training summary")
        return self._training_summary

    def with_leaves(self, dataset: DataFrame) -> DataFrame:
        """The table with the combined feature vector, as the regression reads it."""
        return add_leaf_features(
            dataset, self.trees, self.getFeaturesCol(), self.getOrDefault("gbtGeneratedFeaturesCol")
        )

    def _configured(self) -> LogisticRegressionModel:
        """The regression with this model's column names and threshold."""
        get = self.getOrDefault
        regression = self.regression.copy({
            self.regression.featuresCol: get("gbtGeneratedFeaturesCol"),
            self.regression.predictionCol: get("predictionCol"),
            self.regression.probabilityCol: get("probabilityCol"),
            self.regression.rawPredictionCol: get("rawPredictionCol"),
        })
        if self.isSet(self.thresholds):
            regression.setThresholds(get("thresholds"))
        elif self.isSet(self.threshold):
            regression.setThreshold(get("threshold"))
        return regression

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._configured().transform(self.with_leaves(dataset))

    def evaluate(self, dataset: DataFrame):
        """The logistic regression's summary on a test table."""
        labelled = dataset.withColumn(_LABEL, require_binary(self.getLabelCol()))
        return self._configured().evaluate(self.with_leaves(labelled))

    def rules(self, spark: SparkSession | None = None) -> DataFrame:
        """One row per leaf: treeID, leaf, rule, and the weight the regression gives the leaf.

        The trees are saved to the shared folder and their node table is read back by Spark.
        """
        spark = spark or SparkSession.active()
        path = scratch_path(spark, "trees")
        self.trees.write().save(path)
        rules = leaf_rules(spark.read.parquet(f"{path}/data"))
        return with_weights(rules, leaf_counts(self.trees), self.regression.coefficients.toArray())

    def copy(self, extra=None) -> GBTLRClassificationModel:
        that = super().copy(extra)
        that._training_summary = self._training_summary
        return that

    def write(self) -> MLWriter:
        return _GBTLRWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _GBTLRReader()


class _GBTLRWriter(MLWriter):
    def __init__(self, model: GBTLRClassificationModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.trees.write().save(f"{path}/trees")
        self.model.regression.write().save(f"{path}/regression")


class _GBTLRReader(MLReader):
    def load(self, path: str) -> GBTLRClassificationModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GBTLRClassificationModel(
            GBTClassificationModel.load(f"{path}/trees"), LogisticRegressionModel.load(f"{path}/regression")
        )
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
