"""Exported models score like the models they come from."""

from __future__ import annotations

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators.fm import FactorizationMachine
from clickloom.plans import portable_tables
from clickloom.plans.models import CtrModel
from clickloom.plans.portable_tables import Tables, export_model, read_tables, score_tables
from clickloom.plans.scoring import score
from verification.fixtures import DIM, LABEL

SETTINGS = {
    "lr": {}, "nb": {}, "rf": {}, "gbdt": {}, "gbtlr": {}, "ipnn": {}, "opnn": {},
    "own_fm": {"estimator": lambda width, label: FactorizationMachine(featuresCol="scaledFeatures", labelCol=label, maxIter=4, initStd=0.1)},
    "standard": {"scaler": "standard"},
}
BASE = {"own_fm": "fm", "standard": "lr"}


def through(spark, model, path):
    export_model(model, path)
    return read_tables(spark, path)


@pytest.mark.parametrize("name", sorted(SETTINGS))
def test_scores_equal_those_of_the_model(spark, tiny_samples, tmp_path, name):
    model = CtrModel(BASE.get(name, name), DIM, LABEL, **SETTINGS[name]).fit(tiny_samples)
    tables = through(spark, model, str(tmp_path / "m"))
    both = score_tables(score(model, tiny_samples).withColumnRenamed("ctr", "direct"), tables)
    worst = both.agg(F.max(F.abs(F.col("ctr") - F.col("direct"))), F.count("ctr"), F.count("*")).first()
    assert worst[0] < 1e-9 and worst[1] == worst[2] == 1000
    assert set(both.columns) == {*tiny_samples.columns, "direct", "ctr"}
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rows_that_cannot_be_scored_get_a_null(spark, tiny_samples, tmp_path):
    model = CtrModel("lr", DIM, LABEL, layout="inner").fit(tiny_samples)
    tables = through(spark, model, str(tmp_path / "m"))
    spoilt = tiny_samples.withColumn("n", F.row_number().over(Window.orderBy("event_id"))).withColumns({
        "content_type": F.when(F.col("n") == 1, "never seen").when(F.col("n") == 2, None).otherwise(F.col("content_type")),
        "item_ctr": F.when(F.col("n") == 3, float("nan")).when(F.col("n") == 4, None).otherwise(F.col("item_ctr")),
        "user_embedding": F.when(F.col("n") == 5, None).otherwise(F.col("user_embedding")),
        "user_item_click": F.when(F.col("n") == 6, None).otherwise(F.col("user_item_click")),
    })
    out = score_tables(spoilt, tables)
    assert sorted(r.n for r in out.filter("ctr is null").collect()) == [1, 2, 3, 4, 5, 6]
    assert out.count() == 1000


def test_nominal_splits_and_unseen_categories(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 7).cast("string").alias("c"), (F.col("id") % 7).isin(1, 3, 5).cast("double").alias("label"))
    indexer = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df)
    assembler = VectorAssembler(inputCols=["i"], outputCol="features")
    ready = assembler.transform(indexer.transform(df))
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).fit(ready)
    model = PipelineModel(stages=[indexer, assembler, forest])
    tables = through(spark, model, str(tmp_path / "m"))
    assert any(n[5] for n in tables.nodes)
    new = df.unionByName(df.limit(1).withColumn("c", F.lit("new")))
    direct = {r.c: r.probability[1] for r in model.transform(new).collect()}
    assert {r.c: pytest.approx(r.ctr) for r in score_tables(new, tables).collect()} == direct


def test_tables_are_plain_and_strangers_are_refused(spark, tiny_samples, tmp_path):
    model = CtrModel("nb", DIM, LABEL).fit(tiny_samples)
    export_model(model, str(tmp_path / "m"))
    numbers = spark.read.parquet(str(tmp_path / "m" / "numbers"))
    assert numbers.columns == ["stage", "part", "i", "j", "value"] and numbers.filter("part = 'weight'").count() == 2 * 142
    odd = PipelineModel(stages=[PCA(k=1, inputCol="scaledFeatures", outputCol="x").fit(model.transform(tiny_samples)), model.stages[-1]])
    with pytest.raises(ValueError, match="can't export a PCAModel"):
        export_model(odd, str(tmp_path / "odd"))
    other = PipelineModel(stages=[NaiveBayes(modelType="gaussian", featuresCol="scaledFeatures", labelCol=LABEL).fit(model.transform(tiny_samples).drop("prediction", "probability", "rawPrediction"))])
    with pytest.raises(ValueError, match="gaussian"):
        export_model(other, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="missing"):
        score_tables(tiny_samples.drop("item_ctr"), read_tables(spark, str(tmp_path / "m")))


def test_features_are_made_once_for_all_outputs_of_a_layer(spark):
    tables = Tables()
    scaler = tables.add("standard", ["raw"], "x")
    tables.vector(scaler, "mean", [7.25, 7.25])
    tables.vector(scaler, "std", [2.0, 2.0])
    network = tables.add("network", ["x"], "ctr")
    tables.matrix(network, "weight0", [[0.4375, 1.0], [2.0, -1.0]])
    tables.vector(network, "bias0", [0.5, 0.25])
    out = score_tables(spark.createDataFrame([([1.0, 2.0],), ([7.25, 7.25],)], "raw array<double>"), tables)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The scaler's numbers stand before the weights, as the array that all outputs share, not inside of their function.
    assert plan.index("7.25") < plan.index("0.4375")
    x = [[-3.125, -2.625], [0.0, 0.0]]
    raws = [(0.4375 * a + b + 0.5, 2.0 * a - b + 0.25) for a, b in x]
    assert [r.ctr for r in out.collect()] == [pytest.approx(1 / (1 + math.exp(no - yes))) for no, yes in raws]


def test_layers_that_are_written_out_give_the_same_scores_and_are_compiled(spark, monkeypatch):
    tables = Tables()
    network = tables.add("network", ["x"], "ctr")
    tables.matrix(network, "weight0", [[((7 * i + 3 * j) % 11 - 5) / 20 for j in range(20)] for i in range(16)])
    tables.vector(network, "bias0", [i / 40 for i in range(16)])
    tables.matrix(network, "weight1", [[(i + j) % 3 - 1.0 for j in range(16)] for i in range(2)])
    tables.vector(network, "bias1", [0.1, -1e-7])
    whole = [[math.sin(k * j + 1) for j in range(20)] for k in range(30)]
    odd = [None, [], whole[0][:19], [*whole[0], 1.0], [*whole[0][:19], None], [*whole[0][:19], 1e300]]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate([*whole, *odd])], "k long, x array<double>")
    out = score_tables(rows, tables)
    assert out.columns == ["k", "x", "ctr"]
    # The sums are a step of their own; inside of the function over them they would be walked through value by value.
    assert "transform(_sums0" in out._jdf.queryExecution().optimizedPlan().toString()
    written = {r.k: r.ctr for r in out.collect()}
    monkeypatch.setattr(portable_tables, "WRITTEN_OUT", (math.inf, 0))
    assert {r.k: r.ctr for r in score_tables(rows, tables).collect()} == written
    assert [k for k, v in written.items() if v is None] == [30, 31, 32, 33, 34]
