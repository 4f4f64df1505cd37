"""One query per operator. Each reads the given tables whole and returns a table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.embeddings import to_vectors
from clickloom.functions.labels import as_double, as_sign, is_binary, require_binary
from clickloom.functions.probability import click_probability
from clickloom.operators.features import FEATURES, embedding_ranges, feature_stages, fit_features, vector_width
from clickloom.operators.fm import FactorizationMachine, FactorizationMachineModel, label_range, pack_rows, row_evaluator
from clickloom.operators.fm_math import CLASSIFICATION, REGRESSION, Shape
from clickloom.operators.fm_sparse import active_evaluator, pack_active
from clickloom.operators.fm_table import WeightTable, gradient_table, score_table, train_table, training_rows
from clickloom.operators.gbtlr import GBTLRClassificationModel, GBTLRClassifier
from clickloom.operators.network import BlockNetwork
from clickloom.operators.quantiles import QuantileCuts, exact_quantiles
from clickloom.operators.split import hash_bucket, hash_split, in_training, mini_batch, random_split
from clickloom.operators.transformers import EmbeddingCosine, EmbeddingHadamard
from clickloom.plans.comparison import compare_models
from clickloom.plans.evaluation import evaluate
from clickloom.plans.models import CtrModel, fit_models
from clickloom.plans.portable_net import score_portable_net
from clickloom.plans.portable_tables import export_model, read_tables, score_tables
from clickloom.plans.scoring import load_and_score, save_model, score
from clickloom.session import VECTOR_ROWS, cached, materialise, scratch_path, ship_package
from clickloom.sources import impressions
from clickloom.sources.samples import read_samples, write_samples
from clickloom.streaming.scoring import write_scores
from verification.fixtures import (
    DIM,
    FM_BIAS,
    FM_FACTORS,
    FM_INIT_STD,
    FM_REG,
    FM_STEP_SIZE,
    FM_STEPS,
    LABEL,
    NET,
    SEED,
    WIDE,
    fm_factor,
    fm_linear,
    net_weight,
    planted_samples,
    wide_entries,
)

Query = Callable[[SparkSession, str], DataFrame]
KEYS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField(LABEL, T.IntegerType())])
EMBEDDINGS = ["user_embedding", "item_embedding"]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return planted_samples(events, embeddings)


def stored_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample table written out, for queries that pass over it several times."""
    return _stored(spark, sf_dir)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The parts of ``hash_split``, drawn once, when the samples are written."""
    stored = _stored(spark, sf_dir, lambda df: in_training(df, "event_id").cast("int"))
    return stored.filter("part = 1").drop("part"), stored.filter("part = 0").drop("part")


def _stored(spark: SparkSession, sf_dir: str, parts: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    ship_package(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return impressions.stored_samples(embeddings, lambda vectors, number: planted_samples(events, vectors, references=number), parts)


def r6(value: Column | str) -> Column:
    return F.round(value, 6)


def exploded(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """One row per position of a vector or array column."""
    values = F.col(column) if isinstance(df.schema[column].dataType, T.ArrayType) else vector_to_array(column)
    return df.select(*keys, F.posexplode(values).alias("position", "value")).withColumn("value", r6("value"))


# Sources


def sample_columns(df: DataFrame) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
    return df.select(
        "event_id", "user_id", "item_id", "category_id", "content_type", "timestamp", "user_item_click",
        r6("user_item_imp").alias("user_item_imp"), r6("item_ctr").alias("item_ctr"), "is_new_user",
        r6(total("user_embedding")).alias("user_embedding_sum"),
        r6(total("item_embedding")).alias("item_embedding_sum"), "label", LABEL,
    )


def q_sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_columns(samples(spark, sf_dir))


def q_sample_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "samples-orc")
    write_samples(samples(spark, sf_dir), path, "orc")
    return sample_columns(read_samples(spark, path, "orc", extra=KEYS))


# Embeddings


def q_embedding_to_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = to_vectors(samples(spark, sf_dir))
    arrays = vectors.select("event_id", *[vector_to_array(c).alias(c) for c in EMBEDDINGS])
    rows = arrays.select("event_id", F.posexplode(F.arrays_zip(*EMBEDDINGS)).alias("position", "pair"))
    user, item = (r6(f"pair.{c}") for c in EMBEDDINGS)
    return rows.select("event_id", "position", user.alias("user_value"), item.alias("item_value"))


def q_embedding_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = EmbeddingCosine(inputCols=EMBEDDINGS, outputCol="embedding_inner_product")
    out = stage.transform(samples(spark, sf_dir))
    return out.select("event_id", r6("embedding_inner_product").alias("embedding_inner_product"))


def q_embedding_hadamard(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = EmbeddingHadamard(inputCols=EMBEDDINGS, outputCol="embedding_outer_product")
    return exploded(stage.transform(samples(spark, sf_dir)), "embedding_outer_product", "event_id")


# Splits and labels


def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation = hash_split(samples(spark, sf_dir), "event_id")
    parts = [df.select("event_id", F.lit(n).alias("part")) for df, n in ((train, "train"), (validation, "validation"))]
    return parts[0].unionAll(parts[1]).withColumn("bucket", hash_bucket(parts[0], "event_id"))


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts each event is in."""
    parts = random_split(samples(spark, sf_dir).select("event_id"), (0.7, 0.3), SEED)
    return parts[0].unionAll(parts[1]).groupBy("event_id").agg(F.count("*").alias("parts"))


def q_mini_batch_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mini_batch(samples(spark, sf_dir).select("event_id"), 1.0, SEED)


def q_mini_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mini_batch(samples(spark, sf_dir).select("event_id"), 0.1, SEED)


def q_label_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select(
        "event_id", as_double("label").alias("as_double"), as_sign("label").alias("as_sign"),
        is_binary("label").alias("valid"), is_binary("user_item_click").alias("clicks_valid"),
        require_binary("label").alias("required"),
    )


# Feature stages


def q_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).select("event_id", "content_type")
    index = StringIndexer(inputCol="content_type", outputCol="content_type_index")
    return index.fit(df).transform(df)


def q_category_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = q_category_index(spark, sf_dir)
    encoder = OneHotEncoder(inputCols=["content_type_index"], outputCols=["onehot"], dropLast=False)
    return exploded(encoder.fit(df).transform(df), "onehot", "event_id")


def q_ctr_quantile_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).select("item_ctr")
    with cached(df):
        cuts = exact_quantiles(df, "item_ctr", 100)
    return spark.createDataFrame([(i + 1, round(c, 9)) for i, c in enumerate(cuts)], "i int, cut double")


def q_ctr_quantile_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).select("event_id", "item_ctr")
    with cached(df):
        bucketizer = QuantileCuts("item_ctr", "ctr_bucket", 100, 0.0).fit(df)
    return bucketizer.transform(df).select("event_id", "ctr_bucket")


def prepared(spark: SparkSession, sf_dir: str, layout: str, **options) -> DataFrame:
    df = stored_samples(spark, sf_dir)
    return fit_features(df, layout, DIM, relative_error=0.0, **options).transform(df)


def features_query(layout: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return exploded(prepared(spark, sf_dir, layout, **options), FEATURES, "event_id")

    return query


# Naive Bayes, whose fit has a closed form


def fitted_bayes(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    train, validation = split(spark, sf_dir)
    return CtrModel("nb", DIM, LABEL, relative_error=0.0).fit(train), validation


def q_nb_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = fitted_bayes(spark, sf_dir)
    bayes = model.stages[-1]
    theta = bayes.theta.toArray()
    rows = [
        (c, j, float(bayes.pi[c]), float(theta[c, j])) for c in range(theta.shape[0]) for j in range(theta.shape[1])
    ]
    table = spark.createDataFrame(rows, "class int, position int, pi double, theta double")
    return table.select("class", "position", r6("pi").alias("pi"), r6("theta").alias("theta"))


def ctr_only(scored: DataFrame) -> DataFrame:
    return scored.select("event_id", r6("ctr").alias("ctr"))


def q_nb_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, validation = fitted_bayes(spark, sf_dir)
    return ctr_only(score(model, validation))


def q_batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the pipeline, load it again, score a table."""
    model, validation = fitted_bayes(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(model, path)
    return ctr_only(load_and_score(path, validation))


def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores from a stream over the validation table's files."""
    model, validation = fitted_bayes(spark, sf_dir)
    source = scratch_path(spark, "stream-source")
    validation.write.parquet(source)
    stream = spark.readStream.schema(validation.schema).parquet(source)
    sink = scratch_path(spark, "stream-out")
    write_scores(model, stream, sink, scratch_path(spark, "stream-state")).awaitTermination()
    return ctr_only(spark.read.parquet(sink))


# Factorization machines


def fm_weights(width: int) -> tuple[np.ndarray, np.ndarray]:
    factors = np.array([[fm_factor(i, f) for f in range(FM_FACTORS)] for i in range(width)])
    return factors, np.array([fm_linear(i) for i in range(width)])


def q_fm_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = prepared(spark, sf_dir, "inner")
    factors, linear = fm_weights(vector_width(df))
    model = FactorizationMachineModel(factors, linear, FM_BIAS)
    model._set(featuresCol=FEATURES, probabilityCol="probability", predictionCol="prediction")
    out = model.transform(df)
    return out.select("event_id", r6(click_probability()).alias("ctr"), "prediction")


def q_fm_gradient_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = prepared(spark, sf_dir, "inner").select(FEATURES, LABEL)
    shape = Shape(vector_width(df), FM_FACTORS)
    rows = pack_rows(df, FEATURES, as_sign(LABEL))
    flat = shape.pack(*fm_weights(shape.num_features), FM_BIAS)
    with cached(rows):
        loss, gradient, count = row_evaluator(rows, shape, CLASSIFICATION)([flat], 1)[0]
    out = [("loss", 0, 0, float(loss)), ("rows", 0, 0, float(count)), *_weight_rows(shape, gradient)]
    return _weight_table(spark, out)


def _weight_rows(shape: Shape, flat: np.ndarray) -> list[tuple[str, int, int, float]]:
    factors, linear, bias = shape.unpack(flat)
    rows = [("bias", 0, 0, bias)]
    rows += [("linear", i, 0, float(w)) for i, w in enumerate(linear)]
    rows += [("factor", i, f, float(factors[i, f])) for i in range(shape.num_features) for f in range(FM_FACTORS)]
    return rows


def _weight_table(spark: SparkSession, rows: list[tuple[str, int, int, float]]) -> DataFrame:
    table = spark.createDataFrame(rows, "part string, position int, factor int, value double")
    return table.withColumn("value", r6("value"))


def machine(**params) -> FactorizationMachine:
    return FactorizationMachine(
        featuresCol=FEATURES, numFactors=FM_FACTORS, initStd=FM_INIT_STD, seed=SEED, **params
    )


def fm_steps(task: int, label: str, **options) -> Query:
    """A few full-batch steps from known initial weights, which SQL can follow."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = prepared(spark, sf_dir, "inner").select(FEATURES, label)
        bias, linear, factors = FM_REG
        model = machine(
            labelCol=label, task=task, solver="gd", maxIter=FM_STEPS, stepSize=FM_STEP_SIZE, tol=0.0,
            regBias=bias, regLinear=linear, regFactors=factors, **options,
        ).fit(df)
        shape = Shape(model.num_features, model.num_factors)
        return _weight_table(spark, _weight_rows(shape, shape.pack(model.factors, model.linear, model.bias)))

    return query


def q_fm_label_range_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression's raw score under fixed weights, held within the range of the labels."""
    df = prepared(spark, sf_dir, "inner")
    low, high = label_range(df, "item_ctr")
    model = FactorizationMachineModel(*fm_weights(vector_width(df)), FM_BIAS, low, high)
    model._set(featuresCol=FEATURES, predictionCol="prediction", task=REGRESSION)
    out = model.transform(df)
    return out.select(
        "event_id", r6("prediction").alias("prediction"),
        r6(F.lit(low)).alias("low"), r6(F.lit(high)).alias("high"),
    )


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_samples(spark, sf_dir).select("event_id", LABEL, wide_entries().alias("entries"))


def fixed_weight_table(spark: SparkSession, width: int) -> WeightTable:
    """The fixed weights by their rule, for any width."""
    at = F.col("id")
    factors = F.array(*[((2 * at + f) % 7 - 3) / 20 for f in range(FM_FACTORS)])
    rows = spark.range(width).select(at.cast("int").alias("position"), ((at % 5 - 2) / 10).alias("linear"), factors.alias("factors"))
    return WeightTable(rows, FM_FACTORS, FM_BIAS)


def q_fm_wide_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot ids of more than 100,000 positions, scored from a stored weight table."""
    path = scratch_path(spark, "weight-table")
    fixed_weight_table(spark, WIDE).save(path)
    return ctr_only(score_table(wide_rows(spark, sf_dir), WeightTable.load(spark, path), "entries", "event_id"))


def touched_weights(gradient: DataFrame) -> DataFrame:
    """Rows of a gradient by part, position and factor."""
    parts = F.when(F.col("position") < 0, "bias").otherwise("linear")
    place = F.greatest("position", F.lit(0))
    linear = gradient.select(parts.alias("part"), place.alias("position"), F.lit(0).alias("factor"), F.col("linear").alias("value"))
    factors = gradient.filter("position >= 0").select(F.lit("factor").alias("part"), "position", F.posexplode("factors").alias("factor", "value"))
    return linear.unionByName(factors).withColumn("value", r6("value"))


def q_fm_wide_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gradient over sparse blocks: active entries only, of more than 100,000 positions."""
    df = wide_rows(spark, sf_dir)
    shape = Shape(WIDE, FM_FACTORS)
    rows = pack_active(df, "entries", as_sign(LABEL))
    with cached(rows):
        evaluate = active_evaluator(rows, shape, CLASSIFICATION, block=10_000)
        loss, gradient, count = evaluate([shape.pack(*fm_weights(WIDE), FM_BIAS)], 1)[0]
    factors, linear, bias = shape.unpack(gradient)
    touched = [(-1, float(bias), [0.0] * FM_FACTORS), *[(int(i), float(linear[i]), factors[i].tolist()) for i in np.flatnonzero(linear)]]
    out = spark.createDataFrame(touched, "position int, linear double, factors array<double>")
    first = _weight_table(spark, [("loss", 0, 0, float(loss)), ("rows", 0, 0, float(count))])
    return first.unionByName(touched_weights(out))


def q_fm_wide_gradient_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same gradient with the weights as a table, by joins and sums."""
    rows = training_rows(wide_rows(spark, sf_dir), "entries", LABEL, CLASSIFICATION)
    found = materialise(gradient_table(rows, fixed_weight_table(spark, WIDE)), "gradient")
    whole = found.filter("position = -1")
    n = whole.first()["n"]
    mean = found.select("position", (F.col("linear") / n).alias("linear"), F.transform("factors", lambda g: g / n).alias("factors"))
    tail = lambda part, value: whole.select(F.lit(part).alias("part"), F.lit(0).alias("position"), F.lit(0).alias("factor"), r6(value).alias("value"))
    return tail("loss", F.col("loss") / n).unionByName(tail("rows", F.col("n").cast("double"))).unionByName(touched_weights(mean))


def q_fm_table_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known training steps with weights that are a table from the start to the end."""
    df = prepared(spark, sf_dir, "inner").select(FEATURES, LABEL)
    shape = Shape(vector_width(df), FM_FACTORS)
    factors, linear, _ = shape.unpack(shape.initial(FM_INIT_STD, SEED))
    first = [(i, float(w), v) for i, (w, v) in enumerate(zip(linear, factors.tolist()))]
    start = WeightTable(spark.createDataFrame(first, "position int, linear double, factors array<double>"), FM_FACTORS)
    rows = training_rows(df, FEATURES, LABEL, CLASSIFICATION)
    weights, _ = train_table(rows, start, FM_STEPS, FM_STEP_SIZE, scratch_path(spark, "table-training"), *FM_REG)
    bias = spark.createDataFrame([(-1, weights.bias, [0.0] * FM_FACTORS)], weights.rows.schema)
    return touched_weights(bias.unionByName(weights.rows))


def fm_query(task: int, label: str, **params) -> Query:
    """Fit on the training part, predict the validation part."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, validation = split(spark, sf_dir)
        wanted = "ctr" if task == CLASSIFICATION else "prediction"
        estimator = lambda width, name: machine(labelCol=name, task=task, **params)
        model = CtrModel("fm", DIM, label, estimator=estimator).fit(train)
        if task == CLASSIFICATION:
            return score(model, validation).select("event_id", LABEL, wanted)
        return model.transform(validation).select("event_id", label, wanted)

    return query


def q_fm_saved_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed machine, saved and loaded again."""
    df = prepared(spark, sf_dir, "inner")
    model = FactorizationMachineModel(*fm_weights(vector_width(df)), FM_BIAS)
    model._set(featuresCol=FEATURES, probabilityCol="probability", predictionCol="prediction")
    path = scratch_path(spark, "machine")
    model.write().save(path)
    out = FactorizationMachineModel.read().load(path).transform(df)
    return out.select("event_id", r6(click_probability()).alias("ctr"), "prediction")


# Models under settings that SQL can follow


def q_lr_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At its optimum a logistic regression's expected feature sums are the observed ones."""
    df = prepared(spark, sf_dir, "inner").select("event_id", FEATURES, LABEL)
    model = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, maxIter=500, tol=1e-14).fit(df)
    out = model.transform(df).withColumn("ctr", click_probability())
    values = out.select("ctr", LABEL, F.posexplode(vector_to_array(FEATURES)).alias("position", "value"))
    sums = values.groupBy("position").agg(
        F.sum(F.col(LABEL) * F.col("value")).alias("observed"), F.sum(F.col("ctr") * F.col("value")).alias("expected"), F.count("*").alias("n")
    )
    met = F.abs(F.col("expected") - F.col("observed")) / F.col("n") < 1e-5
    # The fit ends some 1e-10 beside the observed mean; eight digits first, so that a mean halfway between two thousandths is rounded up.
    moment = F.round(F.round(F.col("expected") / F.col("n"), 8), 3)
    return sums.select("position", moment.alias("moment"), r6("observed").alias("observed"), met.alias("met"))


def network_query(layout: str) -> Query:
    """A network of the registered shape with given weights and no iteration of training."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = prepared(spark, sf_dir, layout).select("event_id", FEATURES, LABEL)
        width = vector_width(df)
        hidden = width // 2
        size = (width + 1) * hidden + (hidden + 1) * 2
        network = MultilayerPerceptronClassifier(
            featuresCol=FEATURES, labelCol=LABEL, layers=[width, hidden, 2], maxIter=0,
            initialWeights=Vectors.dense([net_weight(k) for k in range(size)]),
        )
        return ctr_only(network.fit(df).transform(df).withColumn("ctr", click_probability()))

    return query


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three features of 0 and 1, on which the best first split is plain to find."""
    df = samples(spark, sf_dir).select(
        "event_id", LABEL, F.col("is_new_user").cast("double").alias("f0"),
        (F.col("content_type") < "c5").cast("double").alias("f1"), (F.col("user_item_click") > 0).cast("double").alias("f2"),
    )
    return materialise(VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol=FEATURES).transform(df), "flags", VECTOR_ROWS)


def one_stump_forest() -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=SEED
    )


def q_rf_stump_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flags(spark, sf_dir)
    return ctr_only(one_stump_forest().fit(df).transform(df).withColumn("ctr", click_probability()))


def q_gbt_stump_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flags(spark, sf_dir)
    trees = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=1, maxDepth=1, seed=SEED)
    return ctr_only(trees.fit(df).transform(df).withColumn("ctr", click_probability()))


def stump_gbtlr(spark: SparkSession, df: DataFrame) -> GBTLRClassificationModel:
    """One stump and a regression on its leaves, saved and loaded again."""
    model = GBTLRClassifier(featuresCol=FEATURES, labelCol=LABEL, gbtMaxIter=1, maxDepth=1, lrMaxIter=20, seed=SEED).fit(df)
    path = scratch_path(spark, "gbtlr")
    model.write().save(path)
    return GBTLRClassificationModel.read().load(path)


def q_gbtlr_stump_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flags(spark, sf_dir)
    described = stump_gbtlr(spark, df).with_leaves(df)
    leaf = vector_to_array("gbt_generated_features")[4]
    return described.select("event_id", leaf.cast("int").alias("leaf"))


def q_gbtlr_stump_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stump_gbtlr(spark, flags(spark, sf_dir)).rules(spark).select("treeID", "leaf", "rule")


def q_gbtlr_leaf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many leaves are set for each row: one in each of the ten trees."""
    model, validation = fitted_gbtlr(spark, sf_dir)
    features = PipelineModel(stages=model.stages[:-1]).transform(validation)
    width = vector_width(features)
    described = model.stages[-1].with_leaves(features)
    values = vector_to_array("gbt_generated_features")
    leaves = F.slice(values, width + 1, vector_width(described, "gbt_generated_features") - width)
    return described.select("event_id", F.aggregate(leaves, F.lit(0.0), lambda s, v: s + v).cast("int").alias("leaves"))


# Trained models


def model_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, validation = split(spark, sf_dir)
        model = CtrModel(name, DIM, LABEL).fit(train)
        return score(model, validation).select("event_id", LABEL, "ctr")

    return query


def fitted_gbtlr(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    train, validation = split(spark, sf_dir)
    return CtrModel("gbtlr", DIM, LABEL).fit(train), validation


def q_gbtlr_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf positions, behind the original features, that are set for each row."""
    model, validation = fitted_gbtlr(spark, sf_dir)
    features = PipelineModel(stages=model.stages[:-1]).transform(validation)
    width = vector_width(features)
    described = model.stages[-1].with_leaves(features)
    values = vector_to_array("gbt_generated_features")
    rows = described.select("event_id", F.posexplode(values).alias("position", "value"))
    hot = rows.filter((F.col("position") >= width) & (F.col("value") == 1.0))
    return hot.select("event_id", (F.col("position") - width).alias("leaf_position"))


def q_gbtlr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = fitted_gbtlr(spark, sf_dir)
    return model.stages[-1].rules(spark)


# Exported models


def through_tables(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Scores from the number tables of a model that was written and read again."""
    path = scratch_path(df.sparkSession, "number-tables")
    export_model(model, path)
    return score_tables(df, read_tables(df.sparkSession, path))


def q_tables_nb_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctr_only(through_tables(*fitted_bayes(spark, sf_dir)))


def given_network(df: DataFrame, layout: str) -> PipelineModel:
    features = fit_features(df, layout, DIM, relative_error=0.0)
    prepared_rows = features.transform(df).select(FEATURES, LABEL)
    width = vector_width(prepared_rows)
    size = (width + 1) * (width // 2) + (width // 2 + 1) * 2
    network = BlockNetwork(
        featuresCol=FEATURES, labelCol=LABEL, layers=[width, width // 2, 2], maxIter=0, initialWeights=Vectors.dense([net_weight(k) for k in range(size)])
    )
    network.shared = embedding_ranges(layout, width, DIM)
    return PipelineModel(stages=[*features.stages, network.fit(prepared_rows)])


def tables_network_query(layout: str) -> Query:
    """The network of given weights, exported with its feature stages and scored from raw samples."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = stored_samples(spark, sf_dir)
        return ctr_only(through_tables(given_network(df, layout), df))

    return query


def tables_stump_query(make: Callable[[], object]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = flags(spark, sf_dir)
        return ctr_only(through_tables(PipelineModel(stages=[make().fit(df)]), df))

    return query


def q_tables_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For trained models of every kind: whether each row's score from the tables is that of the model."""
    train, validation = split(spark, sf_dir)
    parts = []
    for name, model in fit_models(train, DIM, ("lr", "rf", "gbdt", "gbtlr", "fm", "ipnn"), LABEL):
        both = through_tables(model, score(model, validation).withColumnRenamed("ctr", "direct"))
        parts.append(both.select("event_id", F.lit(name).alias("model"), (F.abs(F.col("ctr") - F.col("direct")) < 1e-9).alias("same")))
    return reduce(DataFrame.unionByName, parts)


# Evaluation


def scored_by_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score with many ties."""
    out = EmbeddingCosine(inputCols=EMBEDDINGS, outputCol="p").transform(samples(spark, sf_dir))
    return out.select(F.round("p", 2).alias("score"), LABEL)


def auc_query(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        area = evaluate(scored_by_cosine(spark, sf_dir), LABEL, "score")[metric]
        return spark.createDataFrame([(round(area, 6),)], f"{metric} double")

    return query


def q_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation = split(spark, sf_dir)
    return compare_models(train, validation, DIM, label=LABEL)


def net_inputs(df: DataFrame) -> DataFrame:
    """Samples as the exported network reads them."""
    df = EmbeddingCosine(inputCols=EMBEDDINGS, outputCol="embedding_inner_product").transform(df)
    kind = F.when(F.col("content_type") < "c4", "movie").when(F.col("content_type") < "c8", "series")
    # The test rates are far above the network's cuts; a tenth of them spreads over the buckets.
    return df.withColumns({"content_type": kind.otherwise("other"), "item_ctr": F.col("item_ctr") / 20.0})


def q_portable_net_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = net_inputs(samples(spark, sf_dir))
    return score_portable_net(NET, inputs).select("event_id", "ctr_bucket", r6("ctr").alias("ctr"))


QUERIES: dict[str, Query] = {
    "sample_table": q_sample_table,
    "sample_orc": q_sample_orc,
    "embedding_to_vector": q_embedding_to_vector,
    "embedding_cosine": q_embedding_cosine,
    "embedding_hadamard": q_embedding_hadamard,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "mini_batch": q_mini_batch,
    "mini_batch_whole": q_mini_batch_whole,
    "label_checks": q_label_checks,
    "category_index": q_category_index,
    "category_onehot": q_category_onehot,
    "ctr_quantile_cuts": q_ctr_quantile_cuts,
    "ctr_quantile_bucket": q_ctr_quantile_bucket,
    "features_base": features_query("base"),
    "features_inner": features_query("inner"),
    "features_outer": features_query("outer"),
    "standard_scaled": features_query("inner", scaler="standard"),
    "nb_parameters": q_nb_parameters,
    "nb_score": q_nb_score,
    "batch_score": q_batch_score,
    "stream_score": q_stream_score,
    "fm_score_fixed": q_fm_score_fixed,
    "fm_gradient_step": q_fm_gradient_step,
    "fm_gd_steps": fm_steps(CLASSIFICATION, LABEL),
    "fm_sparse_steps": fm_steps(CLASSIFICATION, LABEL, storage="sparse", aggregationDepth=3),
    "fm_table_steps": q_fm_table_steps,
    "fm_wide_score": q_fm_wide_score,
    "fm_wide_gradient": q_fm_wide_gradient,
    "fm_wide_gradient_table": q_fm_wide_gradient_table,
    "fm_regression_steps": fm_steps(REGRESSION, "item_ctr"),
    "fm_label_range_clamp": q_fm_label_range_clamp,
    "fm_gd": fm_query(CLASSIFICATION, LABEL, solver="gd", maxIter=50, stepSize=1.0, tol=0.0),
    "fm_lbfgs": fm_query(CLASSIFICATION, LABEL, solver="lbfgs", maxIter=30),
    "fm_regression": fm_query(REGRESSION, "item_ctr", solver="lbfgs", maxIter=30),
    "fm_saved_score": q_fm_saved_score,
    "lr_moments": q_lr_moments,
    "nn_forward": network_query("base"),
    "ipnn_forward": network_query("inner"),
    "opnn_forward": network_query("outer"),
    "tables_nb_score": q_tables_nb_score,
    "tables_nn_score": tables_network_query("base"),
    "tables_ipnn_score": tables_network_query("inner"),
    "tables_opnn_score": tables_network_query("outer"),
    "tables_rf_stump": tables_stump_query(one_stump_forest),
    "tables_gbt_stump": tables_stump_query(lambda: GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=1, maxDepth=1, seed=SEED)),
    "tables_trained": q_tables_trained,
    "rf_stump_score": q_rf_stump_score,
    "gbt_stump_score": q_gbt_stump_score,
    "gbtlr_stump_leaves": q_gbtlr_stump_leaves,
    "gbtlr_stump_rules": q_gbtlr_stump_rules,
    "gbtlr_leaf_counts": q_gbtlr_leaf_counts,
    "lr_score": model_query("lr"),
    "fm_score": model_query("fm"),
    "rf_score": model_query("rf"),
    "gbt_score": model_query("gbdt"),
    "nn_score": model_query("nn"),
    "ipnn_score": model_query("ipnn"),
    "opnn_score": model_query("opnn"),
    "gbtlr_score": model_query("gbtlr"),
    "gbtlr_leaves": q_gbtlr_leaves,
    "gbtlr_rules": q_gbtlr_rules,
    "auc_roc": auc_query("auc_roc"),
    "auc_pr": auc_query("auc_pr"),
    "model_comparison": q_model_comparison,
    "portable_net_score": q_portable_net_score,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every impression of the validation part and report the areas next to each score."""
    train, validation = split(spark, sf_dir)
    model = CtrModel("lr", DIM, LABEL, layout="inner").fit(train)
    scored = score(model, validation).select("event_id", "user_id", "item_id", LABEL, "ctr")
    areas = evaluate(scored, LABEL, "ctr")
    return scored.withColumns({name: F.lit(value) for name, value in areas.items()})
