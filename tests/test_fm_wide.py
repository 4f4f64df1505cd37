"""Sparse and wide factorization machines: gradients, combining, weight tables, restart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import OneHotEncoder, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import fm, fm_sparse
from clickloom.operators.active import active
from clickloom.operators.fm import FactorizationMachine, FactorizationMachineModel
from clickloom.operators.fm_math import CLASSIFICATION, REGRESSION, Shape, loss_and_gradient
from clickloom.operators.fm_table import WeightTable, gradient_table, score_table, train_table, training_rows

WIDTH = 30


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([(CLASSIFICATION, None), (REGRESSION, None), (REGRESSION, (-0.3, 0.4))]), st.booleans(), st.booleans())
def test_sparse_gradient_equals_the_dense_one(seed, case, use_bias, use_linear):
    task, bounds = case
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(draw.integers(1, 20), 12)) * (draw.random((1, 12)) < 0.4)
    y = np.where(draw.random(len(x)) < 0.5, 1.0, -1.0)
    shape = Shape(12, 3, use_bias, use_linear)
    flat = draw.normal(size=shape.size)
    rows, positions = np.nonzero(x)
    pointers = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(x)))])
    loss, touched, by_factor, by_linear, by_bias = fm_sparse.sparse_loss_and_gradient(pointers, positions, x[rows, positions], y, shape, flat, task, bounds)
    factors, linear = np.zeros((12, 3)), np.zeros(12)
    factors[touched], linear[touched] = by_factor, by_linear
    want_loss, want = loss_and_gradient(x, y, shape, flat, task, bounds)
    assert loss == pytest.approx(want_loss)
    np.testing.assert_allclose(shape.pack(factors, linear, by_bias), want, atol=1e-9)


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
@pytest.mark.parametrize("direct", [1, 4])
def test_partial_sums_meet_over_any_levels(spark, depth, direct):
    draw = np.random.default_rng(5)
    vectors = draw.integers(-9, 9, size=(23, 100)).astype(float)
    vectors[:, 40:64] = 0
    rows = [tuple(r.values()) for slot, v in enumerate(vectors) for r in fm_sparse.blocks_of(v, slot, 16).to_pylist()]
    partials = spark.createDataFrame(rows, fm_sparse.BLOCKS).repartition(5)
    out = fm_sparse.combine(partials, 23, depth, direct).collect()
    assert max(r["slot"] for r in out) < direct
    total = np.zeros(100)
    for r in out:
        total[r["block"] * 16 : r["block"] * 16 + 16][: len(r["sums"]) // 8] += np.frombuffer(r["sums"])
    np.testing.assert_array_equal(total, vectors.sum(axis=0))
    np.testing.assert_array_equal(fm_sparse.summed(partials, 23, depth, 100, 16), vectors.sum(axis=0))
    # Blocks that are 0 in every slot aren't sent at all.
    assert 3 not in {r["block"] for r in out}


def test_no_task_of_a_level_holds_more_than_one_block():
    batches = [pa.RecordBatch.from_pylist([{"slot": 0, "block": b, "sums": np.full(2, 1.0).tobytes()}]) for b in (0, 0, 1, 1, 1)]
    made = fm_sparse._add(iter(batches))
    first = next(made)
    assert first.num_rows == 1 and np.frombuffer(first.column(2)[0].as_py()).tolist() == [2.0, 2.0]
    assert np.frombuffer(next(made).column(2)[0].as_py()).tolist() == [3.0, 3.0] and next(made, None) is None


@pytest.fixture(scope="module")
def table(spark):
    """Sparse rows of two features, some with none, from a planted machine."""
    draw = np.random.default_rng(3)
    rows = []
    for k in range(600):
        held = sorted(draw.choice(WIDTH, size=int(draw.integers(0, 4)), replace=False).tolist())
        values = draw.normal(size=len(held)).tolist()
        rows.append((k, float(draw.random() < 1 / (1 + np.exp(-3 * sum(values)))), SparseVector(WIDTH, held, values)))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.DoubleType()), T.StructField("plain", VectorUDT())])
    df = VectorSizeHint(inputCol="plain", size=WIDTH, handleInvalid="error").transform(spark.createDataFrame(rows, schema).repartition(4))
    df = df.withColumn("features", F.col("plain").alias("features", metadata=df.schema["plain"].metadata)).drop("plain")
    return df.cache()


def test_active_entries_of_every_form(spark, table):
    dense = spark.createDataFrame([(Vectors.dense([0.0, 2.0, 0.0]),), (Vectors.sparse(3, [2], [0.0]),), (Vectors.sparse(3, [0], [5.0]),), (Vectors.dense([]),)], ["v"])
    assert [[(e.position, e.value) for e in r[0]] for r in dense.select(active(dense, "v")).collect()] == [[(1, 2.0)], [], [(0, 5.0)], []]
    struct = dense.select(F.struct(F.array(F.lit(7), F.lit(9)).alias("indices"), F.array(F.lit(0.5), F.lit(0.0)).alias("values")).alias("v"))
    assert [(e.position, e.value) for e in struct.select(active(struct, "v")).first()[0]] == [(7, 0.5)]
    with pytest.raises(Exception, match="null"):
        nulls = dense.select(F.when(F.size(vector_to_array("v")) > 0, F.col("v")).alias("v"))
        nulls.select(active(nulls, "v")).collect()
    with pytest.raises(ValueError, match="neither"):
        active(table, "id")


def machine(**params):
    return FactorizationMachine(numFactors=2, seed=4, **params)


@pytest.mark.parametrize("solver", ["gd", "lbfgs"])
@pytest.mark.parametrize("task", [CLASSIFICATION, REGRESSION])
def test_sparse_and_dense_training_agree_at_any_depth(table, solver, task):
    options = {"solver": solver, "task": task, "maxIter": 6, "initStd": 0.1, "tol": 0.0}
    dense = machine(storage="dense", **options).fit(table)
    for depth in (2, 3):
        sparse = machine(storage="sparse", aggregationDepth=depth, **options).fit(table)
        np.testing.assert_allclose(sparse.factors, dense.factors, atol=1e-9)
        np.testing.assert_allclose(sparse.linear, dense.linear, atol=1e-9)
        assert sparse.bias == pytest.approx(dense.bias)


def test_structs_train_without_a_vector(table):
    inner = F.unwrap_udt("features")
    structs = table.select("id", "label", F.struct(inner["indices"].alias("indices"), inner["values"].alias("values")).alias("features"))
    a = machine(maxIter=3, numFeatures=WIDTH).fit(structs)
    b = machine(maxIter=3).fit(table)
    np.testing.assert_allclose(a.factors, b.factors, atol=1e-9)
    with pytest.raises(ValueError, match="numFeatures"):
        machine(maxIter=3).fit(structs)
    with pytest.raises(Exception, match="positions have to be"):
        machine(maxIter=1, numFeatures=3).fit(structs)
    scored = {r.id: r for r in a.transform(structs).collect()}
    for r in b.transform(table).collect():
        assert scored[r.id].probability.toArray() == pytest.approx(r.probability.toArray()) and scored[r.id].prediction == r.prediction


def test_one_hot_vectors_of_a_wide_encoder(spark):
    df = spark.range(400).select((F.col("id") * 37 % 5000).cast("double").alias("i"), (F.col("id") % 2).cast("double").alias("label"))
    wide = OneHotEncoder(inputCols=["i"], outputCols=["features"], dropLast=False).fit(df).transform(df).drop("i")
    model = machine(maxIter=5, stepSize=50.0).fit(wide)
    assert model.num_features > fm.DENSE_WIDTH
    out = model.transform(wide)
    assert out.filter((F.col("prediction") != F.col("label"))).count() == 0


@pytest.mark.parametrize("solver", ["gd", "lbfgs"])
def test_a_training_that_is_cut_off_goes_on(table, tmp_path, solver):
    options = {"solver": solver, "initStd": 0.1, "tol": 0.0, "storage": "sparse"}
    whole = machine(maxIter=9, **options).fit(table)
    path = str(tmp_path / "state")
    machine(maxIter=5, checkpointPath=path, checkpointInterval=2, **options).fit(table)
    resumed = machine(maxIter=9, checkpointPath=path, checkpointInterval=2, **options).fit(table)
    np.testing.assert_allclose(resumed.factors, whole.factors, atol=1e-9)
    np.testing.assert_allclose(resumed.objective_history, whole.objective_history, atol=1e-9)
    with pytest.raises(ValueError, match="other settings"):
        machine(maxIter=9, checkpointPath=path, regLinear=0.5, **options).fit(table)


def test_a_lost_step_repeats_nothing_that_was_stored(table, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "state"), []
    real = fm.active_evaluator

    def failing(*args, **kwargs):
        evaluate = real(*args, **kwargs)

        def step(points, iteration):
            calls.append(iteration)
            if iteration == 6 and calls.count(6) == 1:
                raise RuntimeError("the driver is gone")
            return evaluate(points, iteration)

        return step

    monkeypatch.setattr(fm, "active_evaluator", failing)
    options = {"maxIter": 7, "initStd": 0.1, "tol": 0.0, "storage": "sparse", "checkpointPath": path, "checkpointInterval": 1}
    with pytest.raises(RuntimeError):
        machine(**options).fit(table)
    machine(**options).fit(table)
    assert calls == [1, 2, 3, 4, 5, 6, 6, 7]


@pytest.fixture(scope="module")
def model():
    draw = np.random.default_rng(8)
    made = FactorizationMachineModel(draw.normal(size=(WIDTH, 3)), draw.normal(size=WIDTH), 0.3)
    made._set(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
    return made


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("key", ["id", None])
def test_weight_tables_score_like_the_model(spark, table, model, broadcast, key, monkeypatch, tmp_path):
    from clickloom import session

    monkeypatch.setattr(session, "BROADCAST_ROWS", 300_000 if broadcast else 0)
    WeightTable.of_model(spark, model).save(str(tmp_path / "w"))
    weights = WeightTable.load(spark, str(tmp_path / "w"))
    named = table.withColumns({"ctr": F.lit("mine"), "position": F.lit(1), "_key": F.lit(2)})
    out = score_table(named, weights, key=key)
    assert sorted(out.columns) == sorted(named.columns) and out.count() == 600
    got = {r.id: r.ctr for r in out.collect()}
    for r in model.transform(table).collect():
        assert got[r.id] == pytest.approx(r.probability[1], abs=1e-12)


def test_unknown_positions_and_missing_keys(spark, table):
    weights = WeightTable(spark.createDataFrame([(1, 1.0, [0.5])], "position int, linear double, factors array<double>"), 1, 0.0)
    row = F.struct(F.array(F.lit(999), F.lit(1)).alias("indices"), F.array(F.lit(4.0), F.lit(2.0)).alias("values")).alias("features")
    assert score_table(spark.range(1).select("id", row), weights, key="id").first().ctr == pytest.approx(1 / (1 + np.exp(-2.0)))
    with pytest.raises(Exception, match="null"):
        score_table(spark.range(1).select(F.lit(None).cast("long").alias("id"), row), weights, key="id").collect()
    assert score_table(spark.range(0).select("id", row), weights, key="id").count() == 0


@pytest.mark.parametrize("task", [CLASSIFICATION, REGRESSION])
def test_table_gradient_equals_the_dense_one(spark, table, model, task):
    weights = WeightTable.of_model(spark, model)
    weights = WeightTable(weights.rows, 3, weights.bias, task, -0.5, 0.5)
    rows = training_rows(table, "features", "label", task)
    got = {r.position: r for r in gradient_table(rows, weights).collect()}
    x = np.array([r.features.toArray() for r in table.orderBy("id").collect()])
    labels = np.array([r.label for r in table.orderBy("id").collect()])
    y = np.where(labels > 0, 1.0, -1.0) if task == CLASSIFICATION else labels
    shape = Shape(WIDTH, 3)
    loss, want = loss_and_gradient(x, y, shape, shape.pack(model.factors, model.linear, 0.3), task, (-0.5, 0.5) if task == REGRESSION else None)
    factors, linear, bias = shape.unpack(want)
    assert (got[-1].loss, got[-1].n, got[-1].linear) == (pytest.approx(loss), 600, pytest.approx(bias))
    for i in range(WIDTH):
        assert got[i].linear == pytest.approx(linear[i]) and got[i].factors == pytest.approx(factors[i].tolist())


def test_table_training_goes_on_where_it_was_cut_off(spark, table, tmp_path):
    start = WeightTable.initial(spark.range(WIDTH).select(F.col("id").cast("int").alias("position")), 2, 0.1, 7)
    draws = np.array([r.factors for r in start.rows.collect()])
    assert abs(draws.mean()) < 0.05 and 0.05 < draws.std() < 0.2
    rows = training_rows(table, "features", "label", CLASSIFICATION)
    regs = (0.01, 0.001, 0.0001)
    whole, losses = train_table(rows, start, 4, 0.5, str(tmp_path / "a"), *regs)
    train_table(rows, start, 2, 0.5, str(tmp_path / "b"), *regs)
    resumed, again = train_table(rows, start, 4, 0.5, str(tmp_path / "b"), *regs)
    assert losses == pytest.approx(again) and losses[-1] < losses[0] and resumed.bias == pytest.approx(whole.bias)
    a, b = ({r.position: r for r in w.rows.collect()} for w in (whole, resumed))
    assert all(a[i].linear == pytest.approx(b[i].linear) and a[i].factors == pytest.approx(b[i].factors) for i in range(WIDTH))
    with pytest.raises(ValueError, match="no rows"):
        train_table(rows.limit(0), start, 1, 0.5, str(tmp_path / "c"))
