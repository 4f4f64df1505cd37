"""Factorization machines: formulas, trainers, regression, saving."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickloom.operators.features import FEATURES
from clickloom.operators.fm import (
    MODEL_SCHEMA,
    FactorizationMachine,
    FactorizationMachineModel,
    descend,
    label_range,
    pack_rows,
    row_evaluator,
)
from clickloom.operators.fm_math import CLASSIFICATION, REGRESSION, Shape, loss_and_gradient, scores
from clickloom.functions.labels import as_sign
from clickloom.plans.evaluation import evaluate

LABEL = "label_planted"


def machine(**params):
    settings = dict(featuresCol=FEATURES, labelCol=LABEL, numFactors=2, initStd=0.1, regLinear=0.0, regFactors=0.0)
    return FactorizationMachine(**{**settings, **params})


def model_with(factors, linear, bias, **kwargs):
    model = FactorizationMachineModel(factors, linear, bias, **kwargs)
    return model._set(featuresCol=FEATURES, probabilityCol="probability", predictionCol="prediction")


@pytest.fixture(scope="module")
def train(inner_small):
    return inner_small[0]


@pytest.mark.parametrize("use_bias", [True, False])
@pytest.mark.parametrize("use_linear", [True, False])
@pytest.mark.parametrize("task", [CLASSIFICATION, REGRESSION])
def test_gradient_matches_differences(use_bias, use_linear, task):
    rng = np.random.default_rng(1)
    shape = Shape(5, 3, use_bias, use_linear)
    x, y = rng.normal(size=(40, 5)), rng.choice([-1.0, 1.0], 40)
    flat = rng.normal(size=shape.size) * 0.3
    _, gradient = loss_and_gradient(x, y, shape, flat, task)
    for i in range(shape.size):
        nudge = np.zeros(shape.size)
        nudge[i] = 1e-6
        up, down = (loss_and_gradient(x, y, shape, flat + s * nudge, task)[0] for s in (1, -1))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def test_pairwise_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    shape = Shape(4, 2)
    x, flat = rng.normal(size=(6, 4)), rng.normal(size=Shape(4, 2).size)
    v, w, b = shape.unpack(flat)
    want = [
        b + row @ w + sum(v[i] @ v[j] * row[i] * row[j] for i in range(4) for j in range(i + 1, 4)) for row in x
    ]
    assert scores(x, shape, flat)[0] == pytest.approx(want)
    assert shape.pack(v, w, b) == pytest.approx(flat)


def test_initial_weights_are_seeded():
    shape = Shape(6, 2)
    assert (shape.initial(0.1, 5) == shape.initial(0.1, 5)).all()
    assert (shape.initial(0.1, 5) != shape.initial(0.1, 6)).any()
    assert (shape.initial(0.1, 5)[12:] == 0).all() and shape.size == 6 * 2 + 6 + 1


def test_column_score_equals_numpy_and_spark_machine(spark, inner_small):
    train, validation = inner_small
    theirs = FMClassifier(featuresCol=FEATURES, labelCol=LABEL, factorSize=2, maxIter=3, seed=1).fit(train)
    factors = theirs.factors.toArray()
    ours = model_with(factors, theirs.linear.toArray(), theirs.intercept)
    keep = vector_to_array("probability")[1]
    a = ours.transform(validation).select("event_id", keep.alias("a"))
    b = theirs.transform(validation).select("event_id", keep.alias("b"))
    rows = a.join(b, "event_id").collect()
    assert max(abs(r["a"] - r["b"]) for r in rows) < 1e-12 and len(rows) == validation.count()


def test_distributed_gradient_is_independent_of_partitioning(train):
    shape = Shape(15, 2)
    flat = shape.initial(0.3, 1)
    found = []
    for parts in (1, 6):
        rows = pack_rows(train.repartition(parts), FEATURES, as_sign(LABEL))
        found.append(row_evaluator(rows, shape, CLASSIFICATION)([flat, flat * 0.5], 0))
    for (l1, g1, n1), (l2, g2, n2) in zip(*found):
        assert (l1, n1) == pytest.approx((l2, n2)) and g1 == pytest.approx(g2, abs=1e-12)
    assert found[0][0][0] != found[0][1][0]


def test_mini_batches_are_independent_of_partitioning(train):
    shape = Shape(15, 2)
    flat = shape.initial(0.3, 1)
    found = []
    for parts in (3, 13):
        rows = pack_rows(train.repartition(parts), FEATURES, as_sign(LABEL))
        found.append(row_evaluator(rows, shape, CLASSIFICATION, fraction=0.2, seed=5)([flat], 4)[0])
    (l1, g1, n1), (l2, g2, n2) = found
    assert n1 == n2 and 0.1 * train.count() < n1 < 0.3 * train.count()
    assert l1 == pytest.approx(l2) and g1 == pytest.approx(g2, abs=1e-12)


def test_null_labels_fail(train):
    unlabelled = train.withColumn(LABEL, F.when(F.rand(3) < 0.5, F.col(LABEL)))
    for task in (CLASSIFICATION, REGRESSION):
        with pytest.raises(Exception, match="is null"):
            machine(task=task, maxIter=1).fit(unlabelled)


def test_packing_keeps_rows_and_needs_room(spark, train):
    rows = pack_rows(train, FEATURES, as_sign(LABEL))
    assert rows.count() == train.count()
    assert rows.selectExpr("max(length(x))").first()[0] == 15 * 8
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(2**30))
        with pytest.raises(ValueError, match="maxRecordsPerBatch"):
            pack_rows(train, FEATURES, as_sign(LABEL))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_both_solvers_lower_the_loss_and_rank_well(inner_small):
    train, validation = inner_small
    descent = machine(solver="gd", maxIter=25, stepSize=1.0, tol=0.0).fit(train)
    newton = machine(solver="lbfgs", maxIter=30).fit(train)
    for model in (descent, newton):
        history = model.objective_history
        assert history[-1] < history[0]
    assert all(b <= a for a, b in zip(newton.objective_history, newton.objective_history[1:]))
    assert newton.objective_history[-1] < descent.objective_history[-1]
    assert len(descent.objective_history) == 25
    assert evaluate(newton.transform(validation), LABEL)["auc_roc"] > 0.68
    out = newton.transform(validation)
    assert set(validation.columns) < set(out.columns)


def test_penalties_shrink_their_own_part(train):
    strong = machine(solver="lbfgs", maxIter=20, regLinear=10.0).fit(train)
    free = machine(solver="lbfgs", maxIter=20).fit(train)
    assert np.abs(strong.linear).max() < 0.05 < np.abs(free.linear).max()


def test_parts_can_be_switched_off(train):
    bare = machine(maxIter=2, useBias=False, useLinear=False).fit(train)
    assert bare.linear is None and bare.bias == 0.0
    assert bare.transform(train).select("probability").count() == train.count()


def test_mini_batches_are_repeatable(train):
    a, b = (machine(maxIter=3, miniBatchFraction=0.3, tol=0.0, seed=4).fit(train) for _ in range(2))
    assert (a.factors == b.factors).all()
    full = machine(maxIter=3, tol=0.0, seed=4).fit(train)
    assert (a.factors != full.factors).any()


def test_empty_sample_leaves_the_weights_alone():
    start = np.ones(3)
    weights, history = descend(lambda points, i: [(0.0, np.zeros(3), 0)], start, np.zeros(3), 1.0, 5, 0.0)
    assert (weights == start).all() and history == []


def test_regression_predictions_stay_in_range(spark, train):
    df = train.withColumn("y", vector_to_array(FEATURES)[14] * 3.0 + 1.0)
    for solver in ("gd", "lbfgs"):
        model = machine(task=REGRESSION, labelCol="y", solver=solver, maxIter=20, stepSize=0.2).fit(df)
        low, high = label_range(df, "y")
        out = model.transform(df).agg(F.min("prediction"), F.max("prediction"), F.avg(F.abs(F.col("prediction") - F.col("y")))).first()
        assert (model.low, model.high) == (low, high) and low <= out[0] and out[1] <= high
        assert model.objective_history[-1] < model.objective_history[0]


def test_save_and_load(spark, inner_small, tmp_path):
    train, validation = inner_small
    model = machine(maxIter=2).fit(train)
    path = str(tmp_path / "fm")
    model.save(path)
    back = FactorizationMachineModel.load(path)
    assert back.uid == model.uid and (back.factors == model.factors).all()
    assert back.transform(validation).select("probability").exceptAll(model.transform(validation).select("probability")).count() == 0
    assert spark.read.parquet(f"{path}/data").schema.fieldNames() == MODEL_SCHEMA.fieldNames()


@pytest.mark.parametrize(
    "change,message",
    [
        ({"format_version": "9.9"}, "format"),
        ({"num_factors": 7}, "factors are"),
        ({"task": 0}, "task"),
    ],
)
def test_damaged_files_are_refused(spark, train, tmp_path, change, message):
    path, broken = str(tmp_path / "fm"), str(tmp_path / "broken")
    model = machine(maxIter=1).fit(train)
    model.save(path)
    model.write().save(broken)
    columns = {name: F.lit(value) for name, value in change.items()}
    spark.read.parquet(f"{path}/data").withColumns(columns).write.mode("overwrite").parquet(f"{broken}/data")
    with pytest.raises(ValueError, match=message):
        FactorizationMachineModel.load(broken)


@pytest.mark.parametrize(
    "params",
    [
        {"numFactors": 0}, {"regLinear": -1.0}, {"regBias": -0.1}, {"initStd": 0.0}, {"miniBatchFraction": 0.0},
        {"miniBatchFraction": 1.5}, {"maxIter": 0}, {"stepSize": -1.0}, {"task": 2}, {"solver": "newton"},
        {"numCorrections": 0},
    ],
)
def test_settings_are_checked(params):
    with pytest.raises(ValueError):
        FactorizationMachine(**params)


def test_grouped_setters_and_dimensions():
    estimator = FactorizationMachine().setDim(False, True, 3).setRegParam(0.1, 0.2, 0.3)
    assert estimator.getOrDefault("numFactors") == 3 and estimator.getOrDefault("regFactors") == 0.3
    with pytest.raises(ValueError):
        Shape(0, 2)
    with pytest.raises(ValueError):
        FactorizationMachineModel(np.zeros((0, 2)), np.zeros(0))


def test_width_mismatch_is_refused(spark, train):
    model = model_with(np.zeros((3, 2)), np.zeros(3), 0.0)
    with pytest.raises(ValueError, match="expects 3"):
        model.transform(train)
