"""Networks and machines trained on blocks of rows, against Spark ML's own and against differences."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import FMClassifier, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import VectorSizeHint
from pyspark.sql import functions as F

from clickloom.functions.labels import as_double, as_sign
from clickloom.operators import network
from clickloom.operators.features import FEATURES, embedding_ranges
from clickloom.operators.fm import pack_rows, row_evaluator
from clickloom.operators.fm_math import CLASSIFICATION, Shape
from clickloom.operators.network import (
    BlockFM, BlockNetwork, SearchFailed, block_evaluator, block_features, block_loss_and_gradient, distinct_rows, kept_blocks,
    machine_evaluator, numbered_columns, pack_blocks, wolfe_step,
)
from clickloom.plans.models import MODELS, CtrModel

LAYERS, SHARED = [10, 5, 2], [(2, 6), (6, 10)]


def matrix(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of a row's own, then one of seven and one of five vectors of four."""
    draw = np.random.default_rng(3)
    x = np.hstack([draw.random((n, 2)), draw.random((7, 4))[draw.integers(0, 7, n)], draw.random((5, 4))[draw.integers(0, 5, n)]])
    return x, (x[:, 0] + x[:, 3] * x[:, 7] + 0.3 * draw.random(n) > 0.9).astype(int)


@pytest.fixture(scope="module")
def rows(spark):
    """512 rows in one partition: whole stacks of Spark ML, whose objective is then the mean over rows."""
    x, y = matrix(512)
    df = spark.createDataFrame([(v.tolist(), float(c)) for v, c in zip(x, y)], "v array<double>, label double")
    df = df.coalesce(1).select(array_to_vector("v").alias(FEATURES), "label")
    return VectorSizeHint(inputCol=FEATURES, size=10).transform(df).cache()


def test_a_gradient_is_that_of_differences_however_the_block_is_held():
    x, y = matrix(300)
    flat = np.random.default_rng(5).normal(0, 0.5, 11 * 6 + 7 * 3 + 4 * 2)
    layers = [10, 6, 3, 2]
    loss, gradient = block_loss_and_gradient(y, x, [None, None], [None, None], layers, SHARED, flat)
    for k in range(0, len(flat), 7):
        step = np.eye(len(flat))[k] * 1e-5
        above, below = (block_loss_and_gradient(y, x, [None, None], [None, None], layers, SHARED, flat + s)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((above - below) / 2e-5, rel=1e-5, abs=1e-5)
    found = [distinct_rows(x[:, a:b]) for a, b in SHARED]
    for coded in ((True, True), (True, False), (False, True)):
        codes, tables = ([f[side].astype(np.intp) if side and c else f[side] if c else None for f, c in zip(found, coded)] for side in (1, 0))
        dense = x[:, network._dense_columns(10, SHARED, coded)]
        other, also = block_loss_and_gradient(y, dense, codes, tables, layers, SHARED, flat)
        assert other == pytest.approx(loss, rel=1e-12)
        np.testing.assert_allclose(also, gradient, rtol=1e-9, atol=1e-9)


def test_distinct_rows_are_exact_or_left():
    x, _ = matrix(300)
    table, codes = distinct_rows(x[:, 2:6])
    assert table.shape == (7, 4) and np.array_equal(table[codes], x[:, 2:6])
    assert distinct_rows(x[:, :2]) is None
    zeros = np.array([[0.0, 1.0], [-0.0, 1.0]] * 4)
    assert np.array_equal(np.signbit(distinct_rows(zeros)[0][distinct_rows(zeros)[1]]), np.signbit(zeros))


@pytest.mark.parametrize("steps", [1, 12])
def test_a_network_is_that_of_spark_ml(rows, steps):
    settings = dict(featuresCol=FEATURES, labelCol="label", layers=LAYERS, blockSize=128, seed=7, maxIter=steps)
    own = BlockNetwork(**settings)
    own.least_rows, own.shared = 0, SHARED
    model, theirs = own.fit(rows), MultilayerPerceptronClassifier(**settings).fit(rows)
    np.testing.assert_allclose(model.weights.toArray(), theirs.weights.toArray(), rtol=1e-5, atol=1e-6)
    assert model.getMaxIter() == steps and not model.hasSummary and model.getLayers() == LAYERS


def test_a_machine_is_that_of_spark_ml(rows):
    settings = dict(featuresCol=FEATURES, labelCol="label", factorSize=2, maxIter=20, stepSize=0.15, tol=0.0, solver="gd", seed=7)
    own = BlockFM(**settings)
    own.least_rows = 0
    model, theirs = own.fit(rows), FMClassifier(**settings).fit(rows)
    np.testing.assert_allclose(model.factors, theirs.factors.toArray(), rtol=1e-9)
    np.testing.assert_allclose(model.linear, theirs.linear.toArray(), rtol=1e-9)
    assert model.bias == pytest.approx(theirs.intercept, rel=1e-9)


def test_vectors_that_rows_share_are_held_once(rows):
    blocks = pack_blocks(rows, FEATURES, as_double("label"), 2, SHARED)
    (block,) = blocks.collect()
    assert len(block.y) == 512 and len(block.dense) == 512 * 2 * 8
    assert [len(t) for t in block.tables] == [7 * 32, 5 * 32] and [len(c) for c in block.codes] == [512 * 4] * 2
    plain = pack_blocks(rows, FEATURES, as_double("label"), 2)
    flat = np.random.default_rng(5).normal(0, 0.5, 11 * 5 + 6 * 2)
    (one,), (other,) = (block_evaluator(b, LAYERS, s)([flat], 0) for b, s in ((blocks, SHARED), (plain, [])))
    assert one[2] == other[2] == 512 and one[0] == pytest.approx(other[0], rel=1e-12)
    np.testing.assert_allclose(one[1], other[1], rtol=1e-9, atol=1e-12)


def test_bad_rows_are_refused(rows):
    for change, message in ((F.lit(None), "labels"), (F.lit(2.0), "labels"), (F.lit(0.5), "labels")):
        with pytest.raises(Exception, match=message):
            pack_blocks(rows.withColumn("label", change.cast("double")), FEATURES, as_double("label"), 2).collect()


def test_a_step_length_meets_both_conditions():
    def along(t: float) -> tuple[float, float]:
        return (t - 30) ** 2, 2 * (t - 30)

    length = wolfe_step(along, 900.0, -60.0, 1.0)
    assert along(length)[0] <= 900 - 1e-4 * length * 60 and abs(along(length)[1]) <= 0.9 * 60
    with pytest.raises(SearchFailed):
        wolfe_step(lambda t: (t, 1.0), 0.0, -1.0, 1.0)


def test_registered_networks_share_their_embeddings(tiny_samples, monkeypatch):
    assert embedding_ranges("base", 142, 64) == [(14, 78), (78, 142)] and embedding_ranges("outer", 78, 64) == [(14, 78)]
    assert embedding_ranges("inner", 15, 64) == []
    seen = []

    def trained(blocks, layers, shared, depth=2):
        seen.append((layers, shared, [max(map(len, r.tables)) for r in blocks.collect()]))
        return block_evaluator(blocks, layers, shared, depth)

    monkeypatch.setattr(network, "block_evaluator", trained)
    monkeypatch.setattr(BlockNetwork, "least_rows", 0)
    monkeypatch.setattr(BlockNetwork, "getMaxIter", lambda self: 2)
    model = CtrModel("nn", 64, "label_planted").fit(tiny_samples)
    assert isinstance(model, PipelineModel) and isinstance(MODELS["fm"].make(15, "label"), BlockFM)
    (layers, shared, tables), = seen
    width = layers[0]
    assert shared == [(width - 128, width - 64), (width - 64, width)] and max(tables) > 0


def few_valued(n: int) -> np.ndarray:
    """Three columns that are one of five rows, one of its own, a bucket and a count."""
    draw = np.random.default_rng(9)
    return np.hstack([draw.random((5, 3))[draw.integers(0, 5, n)], draw.random((n, 1)), draw.integers(0, 9, (n, 1)) / 9, draw.integers(0, 4, (n, 1)) * 1.0])


def test_columns_of_few_values_are_numbered_exactly():
    x = few_valued(2000)
    runs = numbered_columns(x, 100)
    assert [r[:2] for r in runs] == [(0, 3), (4, 6)]
    for start, stop, codes, table in runs:
        assert np.array_equal(table[codes], x[:, start:stop]) and len(table) == len(np.unique(x[:, start:stop], axis=0))
    assert [r[:2] for r in numbered_columns(x, 20)] == [(0, 3), (4, 5), (5, 6)]
    assert numbered_columns(x[:, 3:4], 100) == []


@pytest.mark.parametrize("layers", [[14, 6, 2], [14, 6, 3, 2], [14, 20, 3], [14, 2]])
@pytest.mark.parametrize("scale", [0.5, 400.0])
def test_a_gradient_is_the_same_when_all_parts_are_numbered(layers, scale):
    """Exponentials are multiplied where they are small enough, else sums are taken; rows in order or not."""
    draw, n = np.random.default_rng(4), 5000
    parts = [(0, 10, draw.random((7, 10))), (10, 14, draw.random((40, 4)))]
    flat = draw.normal(0, scale, sum((a + 1) * b for a, b in zip(layers, layers[1:])))
    y, codes = draw.integers(0, layers[-1], n), [np.sort(draw.integers(0, 7, n)), draw.integers(0, 40, n)]
    x = np.hstack([t[c] for (_, _, t), c in zip(parts, codes)])
    wide = [(0, 10, np.hstack([parts[0][2], np.zeros((7, 0))]))]
    plain = block_loss_and_gradient(y, x, [], [], layers, [], flat)
    numbered = block_loss_and_gradient(y, np.empty((n, 0)), codes, [t for _, _, t in parts], layers, [p[:2] for p in parts], flat)
    half = block_loss_and_gradient(y, x[:, 10:], codes[:1], [wide[0][2]], layers, [(0, 10)], flat)
    for other in (numbered, half):
        assert other[0] == pytest.approx(plain[0], rel=1e-9)
        np.testing.assert_allclose(other[1], plain[1], rtol=1e-7, atol=1e-7 * np.abs(plain[1]).max())


def test_sums_by_number_are_the_same_in_any_order():
    draw = np.random.default_rng(6)
    by_unit, codes = draw.random((3, 500)), np.sort(draw.choice([0, 2, 3, 7], 500))
    shuffled = draw.permutation(500)
    one, other = network._sums_by_number(by_unit, codes, 9), network._sums_by_number(by_unit[:, shuffled], codes[shuffled], 9)
    np.testing.assert_allclose(one, other)
    assert one.shape == (9, 3) and not one[[1, 4, 5, 6, 8]].any()


def test_blocks_hold_few_valued_columns_by_number_and_steps_plan_nothing(spark, monkeypatch):
    monkeypatch.setattr(network, "BLOCK_ROWS", 1000)
    x, y = few_valued(3000), np.random.default_rng(2).integers(0, 2, 3000)
    df = spark.createDataFrame([(v.tolist(), float(c)) for v, c in zip(x, y)], "v array<double>, label double").repartition(3)
    df = VectorSizeHint(inputCol=FEATURES, size=6).transform(df.select(array_to_vector("v").alias(FEATURES), "label"))
    shape = Shape(6, 2)
    flat = np.random.default_rng(1).normal(0, 0.3, shape.size)
    (rows,) = row_evaluator(pack_rows(df, FEATURES, as_sign("label")), shape, CLASSIFICATION)([flat], 1)
    with kept_blocks(pack_blocks(df, FEATURES, as_double("label"), 2)) as held:
        blocks = held.collect()
        assert all(len(b.dense) == 8 * len(b.y) and [(p.start, p.stop) for p in b.own] == [(0, 3), (4, 6)] for b in blocks)
        found = np.vstack([np.hstack([block_features(b, 6), np.frombuffer(b.y, np.int8)[:, None]]) for b in blocks])
        assert sorted(map(tuple, found)) == sorted(map(tuple, np.hstack([x, y[:, None]])))
        monkeypatch.setattr(type(df), "mapInArrow", lambda *_: pytest.fail("a step makes a new plan"))
        (one,) = machine_evaluator(held, shape)([flat], 1)
    assert one[2] == rows[2] == 3000 and one[0] == pytest.approx(rows[0], rel=1e-12)
    np.testing.assert_allclose(one[1], rows[1], rtol=1e-9, atol=1e-12)
