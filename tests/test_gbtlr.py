"""Boosted trees with logistic regression: leaves, rules, thresholds, saving."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickloom.operators.features import FEATURES, vector_width
from clickloom.operators.gbtlr import GBTLRClassificationModel, GBTLRClassifier, leaf_counts
from clickloom.plans.evaluation import evaluate

LABEL = "label_planted"


@pytest.fixture(scope="module")
def fitted(inner_small):
    train, _ = inner_small
    return GBTLRClassifier(
        featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=5, maxDepth=3, lrMaxIter=30, regParam=0.01, elasticNetParam=0.5
    ).fit(train)


def test_one_leaf_per_tree_behind_the_features(fitted, inner_small):
    _, validation = inner_small
    counts, width = leaf_counts(fitted.trees), 15
    out = fitted.with_leaves(validation)
    assert vector_width(out, "gbt_generated_features") == width + sum(counts)
    rows = out.select(FEATURES, "gbt_generated_features").take(50)
    for row in rows:
        values = row["gbt_generated_features"].toArray()
        assert (values[:width] == row[FEATURES].toArray()).all()
        at = width
        for count in counts:
            assert values[at : at + count].sum() == 1.0
            at += count
    assert type(rows[0]["gbt_generated_features"]).__name__ == "SparseVector"


def test_rules_hold_for_the_rows_of_their_leaf(fitted, inner_small, spark):
    _, validation = inner_small
    rules = fitted.rules(spark).orderBy("treeID", "leaf").collect()
    counts = leaf_counts(fitted.trees)
    assert [(r["treeID"], r["leaf"]) for r in rules] == [(t, n) for t, c in enumerate(counts) for n in range(c)]
    described = fitted.with_leaves(validation).withColumn("_f", vector_to_array("gbt_generated_features")).cache()
    offset = 15
    for position, rule in enumerate(rules[:20]):
        condition = F.lit(True)
        for part in filter(None, rule["rule"].split(" and ")):
            _, index, sign, bound = part.split(" ")
            value = F.col("_f")[int(index)]
            condition &= (value <= float(bound)) if sign == "<=" else (value > float(bound))
        in_leaf = F.col("_f")[offset + position] == 1.0
        assert described.filter(in_leaf != condition).count() == 0
    weights = fitted.regression.coefficients.toArray()[-sum(counts):]
    assert [r["weight"] for r in rules] == pytest.approx(list(weights))


def test_categorical_split_rule(spark):
    rows = [(float(i % 4), 1 if i % 4 in (1, 3) else 0) for i in range(200)]
    from pyspark.ml.feature import VectorAssembler, VectorIndexer

    df = VectorAssembler(inputCols=["c"], outputCol="raw").transform(spark.createDataFrame(rows, "c double, label int"))
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(df).transform(df)
    model = GBTLRClassifier(gbtMaxIter=1, maxDepth=1).fit(df)
    rules = {r["rule"] for r in model.rules(spark).collect()}
    assert rules == {"feature 0 in {0.0, 2.0}", "feature 0 not in {0.0, 2.0}"}


def test_single_leaf_trees(spark, inner_small):
    train, _ = inner_small
    model = GBTLRClassifier(featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=2, maxDepth=0, lrMaxIter=3).fit(train)
    assert leaf_counts(model.trees) == [1, 1]
    assert [r["rule"] for r in model.rules(spark).collect()] == ["", ""]
    assert vector_width(model.with_leaves(train), "gbt_generated_features") == 17


def test_scores_and_summaries(fitted, inner_small):
    train, validation = inner_small
    out = fitted.transform(validation)
    for name in ("gbt_generated_features", "rawPrediction", "probability", "prediction"):
        assert name in out.columns
    area = evaluate(out, LABEL)["auc_roc"]
    assert area > 0.66
    assert fitted.evaluate(validation).areaUnderROC == pytest.approx(area, abs=1e-3)
    assert fitted.hasSummary and fitted.copy().hasSummary
    assert len(fitted.summary.trees) == len(fitted.summary.tree_weights) == 5
    assert fitted.summary.dataset.count() == train.count()


def test_bad_labels_are_refused(inner_small):
    train, _ = inner_small
    bad = train.withColumn(LABEL, F.when(F.rand(1) < 0.1, 2).otherwise(F.col(LABEL)))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        GBTLRClassifier(featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=1).fit(bad)


def test_save_and_load_model_and_estimator(fitted, inner_small, tmp_path):
    _, validation = inner_small
    fitted.write().overwrite().save(str(tmp_path / "model"))
    back = GBTLRClassificationModel.load(str(tmp_path / "model"))
    assert back.uid == fitted.uid and not back.hasSummary
    with pytest.raises(RuntimeError):
        _ = back.summary
    pairs = [m.transform(validation).select("event_id", vector_to_array("probability")[1].alias("p")) for m in (fitted, back)]
    joined = pairs[0].join(pairs[1].withColumnRenamed("p", "q"), "event_id")
    assert joined.filter("abs(p - q) > 1e-12").count() == 0
    estimator = GBTLRClassifier(maxDepth=4, thresholds=[0.4, 0.6])
    estimator.save(str(tmp_path / "estimator"))
    again = GBTLRClassifier.load(str(tmp_path / "estimator"))
    assert again.getOrDefault("maxDepth") == 4 and again.getThresholds() == [0.4, 0.6]


def test_threshold_and_thresholds_replace_each_other(inner_small):
    estimator = GBTLRClassifier(threshold=0.3)
    assert estimator.getThresholds() == pytest.approx([0.7, 0.3])
    estimator.setThresholds([1.0, 3.0])
    assert estimator.getThreshold() == pytest.approx(1.0 / (1.0 + 1.0 / 3.0))
    estimator.setThreshold(0.8)
    assert not estimator.isSet(estimator.thresholds) and estimator.getThreshold() == 0.8
    with pytest.raises(ValueError):
        GBTLRClassifier(threshold=0.3, thresholds=[0.5, 0.5])
    train, validation = inner_small
    params = dict(featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=1, maxDepth=1, lrMaxIter=2)
    never = GBTLRClassifier(threshold=1.0, **params).fit(train).transform(validation)
    assert never.filter("prediction = 1").count() == 0


def test_weights_reach_the_regression_only_unless_asked(inner_small):
    train, _ = inner_small
    weighted = train.withColumn("w", F.when(F.col(LABEL) == 1, 5.0).otherwise(1.0))
    params = dict(featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=2, maxDepth=2, lrMaxIter=10)
    plain = GBTLRClassifier(**params).fit(weighted)
    some = GBTLRClassifier(weightCol="w", **params).fit(weighted)
    both = GBTLRClassifier(weightCol="w", weightTrees=True, **params).fit(weighted)
    assert some.trees.toDebugString.split("\n")[1:] == plain.trees.toDebugString.split("\n")[1:]
    assert some.regression.intercept != plain.regression.intercept
    assert both.trees.toDebugString.split("\n")[1:] != plain.trees.toDebugString.split("\n")[1:]


@pytest.mark.parametrize(
    "params",
    [
        {"maxDepth": -1}, {"maxBins": 1}, {"gbtMaxIter": 0}, {"stepSize": 0.0}, {"subsamplingRate": 0.0},
        {"elasticNetParam": 1.5}, {"regParam": -1.0}, {"lossType": "hinge"}, {"family": "poisson"},
        {"threshold": 2.0}, {"aggregationDepth": 1}, {"minInstancesPerNode": 0},
    ],
)
def test_settings_are_checked(params):
    with pytest.raises(ValueError):
        GBTLRClassifier(**params)


def test_defaults():
    estimator = GBTLRClassifier()
    want = dict(
        maxDepth=5, maxBins=32, gbtMaxIter=20, lrMaxIter=100, stepSize=0.1, regParam=0.0, tol=1e-6, threshold=0.5,
        checkpointInterval=10, gbtGeneratedFeaturesCol="gbt_generated_features", aggregationDepth=2,
    )
    assert {k: estimator.getOrDefault(k) for k in want} == want
    assert estimator.copy({estimator.maxDepth: 2}).getOrDefault("maxDepth") == 2


def test_settings_of_a_fitted_model_act(fitted, inner_small):
    _, validation = inner_small
    model = fitted.copy()
    assert fitted.transform(validation).filter("prediction = 1").count() > 0
    model.setThreshold(1.0)
    assert model.transform(validation).filter("prediction = 1").count() == 0
    model.setThresholds([1.0, 0.0])
    assert model.getThreshold() == 0.0
    assert model.transform(validation).filter("prediction = 0").count() == 0
    renamed = fitted.copy()
    renamed._set(gbtGeneratedFeaturesCol="described")
    assert renamed.evaluate(validation).areaUnderROC > 0.5


def test_thresholds_and_interval_are_checked():
    for bad in ({"thresholds": [0.0, 0.0]}, {"thresholds": [-1.0, 1.0]}, {"checkpointInterval": 0}):
        with pytest.raises(ValueError):
            GBTLRClassifier(**bad)
