"""Embedding products, labels, splits, feature stages and the sample source."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.functions.embeddings import to_vectors
from clickloom.functions.labels import as_sign, require_binary, require_double
from clickloom.operators.features import (
    FEATURES,
    LAYOUTS,
    categorical_features,
    embedding_stages,
    feature_stages,
    fit_features,
    require_width,
    vector_width,
)
from clickloom.operators.split import hash_split, mini_batch
from clickloom.operators.transformers import EmbeddingCosine, EmbeddingHadamard
from clickloom.sources.impressions import sample_table
from verification.fixtures import planted_samples
from clickloom.sources.samples import check_schema, preview, read_samples, write_samples

PAIR = ["user_embedding", "item_embedding"]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id int, user_embedding array<double>, item_embedding array<double>")


def cosine_of(df):
    out = EmbeddingCosine(inputCols=PAIR, outputCol="p").transform(df)
    assert not set(PAIR) & set(out.columns)
    return {r["id"]: r["p"] for r in out.collect()}


def test_cosine_is_normalised_and_zero_for_zero_norm(spark):
    got = cosine_of(pairs(spark, [(1, [3.0, 4.0], [3.0, 4.0]), (2, [0.0, 0.0], [1.0, 2.0]), (3, [1.0, 0.0], [-2.0, 0.0])]))
    assert got[1] == pytest.approx(1.0) and got[2] == 0.0 and got[3] == pytest.approx(-1.0)


def test_cosine_takes_vectors_too(spark):
    df = pairs(spark, [(1, [1.0, 2.0], [2.0, -1.0]), (2, [1.0, 1.0], [1.0, 0.0])])
    assert cosine_of(to_vectors(df)) == pytest.approx(cosine_of(df))


def test_hadamard_is_element_wise(spark):
    out = EmbeddingHadamard(inputCols=PAIR, outputCol="p").transform(pairs(spark, [(1, [1.0, 2.0], [3.0, 4.0])]))
    assert out.first()["p"] == Vectors.dense([3.0, 8.0])


def test_null_embedding_gives_null_product(spark):
    df = pairs(spark, [(1, None, [1.0]), (2, [1.0], None)])
    assert cosine_of(df) == {1: None, 2: None}
    assert [r["user_embedding"] for r in to_vectors(df).orderBy("id").collect()] == [None, Vectors.dense([1.0])]


@pytest.mark.parametrize("stage", [EmbeddingCosine, EmbeddingHadamard])
def test_unequal_lengths_fail(spark, stage):
    out = stage(inputCols=PAIR, outputCol="p").transform(pairs(spark, [(1, [1.0, 2.0], [1.0])]))
    with pytest.raises(Exception, match="differ in length"):
        out.collect()


def test_to_vectors_keeps_other_columns(spark, tiny_samples):
    out = to_vectors(tiny_samples)
    assert out.columns == tiny_samples.columns
    assert len(out.first()["user_embedding"]) == 64


def test_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "y int")
    signs = [r[0] for r in df.filter("y is not null").select(as_sign("y")).collect()]
    assert signs == [-1.0, 1.0, 1.0]
    for column in (as_sign("y"), require_double("y")):
        with pytest.raises(Exception, match="label y is null"):
            df.select(column).collect()
    assert [r[0] for r in df.filter("y < 2").select(require_binary("y")).collect()] == [0.0, 1.0]
    for bad in ("y = 2", "y IS NULL"):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            df.filter(bad).select(require_binary("y")).collect()


def test_text_keys_and_fine_shares_are_split(spark):
    df = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    train, rest = hash_split(df, "key")
    assert abs(train.count() - 14_000) < 300 and train.count() + rest.count() == 20_000
    assert abs(hash_split(df, "id", 0.9996)[1].count() - 8) < 12
    with_null = spark.createDataFrame([(None,), ("a",)], "key string")
    parts = hash_split(with_null, "key")
    assert parts[0].count() + parts[1].count() == 2


def test_cosine_of_tiny_vectors(spark):
    df = pairs(spark, [(1, [1e-90, 0.0], [1e-90, 0.0]), (2, [0.0, 0.0], [1.0, 0.0])])
    out = EmbeddingCosine(inputCols=PAIR, outputCol="p").transform(df)
    assert [r["p"] for r in out.orderBy("id").collect()] == [pytest.approx(1.0), 0.0]


def test_hash_split_ignores_partitioning(tiny_samples):
    train, validation = hash_split(tiny_samples, "event_id")
    again, _ = hash_split(tiny_samples.repartition(13), "event_id")
    ids = {r[0] for r in train.select("event_id").collect()}
    assert ids == {r[0] for r in again.select("event_id").collect()}
    assert len(ids) + validation.count() == tiny_samples.count()
    with pytest.raises(ValueError):
        mini_batch(tiny_samples, 0.0, 1)


@pytest.mark.parametrize("layout,width", [("base", 142), ("inner", 15), ("outer", 78)])
def test_layout_widths_come_from_metadata(tiny_samples, layout, width):
    out = fit_features(tiny_samples, layout, 64).transform(tiny_samples)
    assert vector_width(out) == width
    require_width(out, FEATURES, width)
    with pytest.raises(ValueError):
        require_width(out, FEATURES, width + 1)


def test_scaled_values_and_constant_dimension(spark, tiny_samples):
    constant = tiny_samples.withColumn("is_new_user", F.lit(1))
    out = fit_features(constant, "inner", 64).transform(constant)
    values = out.select(F.posexplode(vector_to_array(FEATURES)).alias("i", "v"))
    bounds = {r["i"]: (r["lo"], r["hi"]) for r in values.groupBy("i").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    assert bounds[13] == (0.5, 0.5)
    spread = [b for b in bounds.values() if b[0] != b[1]]
    assert len(spread) > 10 and all(b == pytest.approx((0.0, 1.0)) for b in spread)


def test_unseen_content_type(tiny_samples):
    known = tiny_samples.filter("content_type <> 'c3'")
    with pytest.raises(Exception, match="[Uu]nseen label"):
        fit_features(known, "inner", 64).transform(tiny_samples).select(FEATURES).collect()
    kept = fit_features(known, "inner", 64, unseen="keep")
    assert kept.transform(tiny_samples).filter("content_type = 'c3'").select(FEATURES).count() > 0


def test_categorical_features_are_read_from_metadata(tiny_samples):
    out = fit_features(tiny_samples, "inner", 64).transform(tiny_samples)
    before = categorical_features(out, "vectorFeature")
    assert before[0] == 2 and before[10] > 2 and 14 not in before
    # The scaler's output keeps only the width, so models see continuous features.
    assert categorical_features(out, FEATURES) == {}


def test_wrong_choices_are_refused():
    for bad in ({"layout": "middle"}, {"layout": "base", "scaler": "robust"}):
        with pytest.raises(ValueError):
            feature_stages(dim=4, **bad)
    assert {layout: embedding_stages(layout, 4)[1] for layout in LAYOUTS}["outer"] == ["embedding_outer_product"]


def test_feature_fit_reads_only_its_columns(spark, tiny_samples, tmp_path):
    path = str(tmp_path / "s")
    tiny_samples.write.parquet(path)
    table = spark.read.parquet(path)
    plan = fit_features(table, "inner", 64).transform(table).select(FEATURES)._jdf.queryExecution().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "category_id" not in schema and "user_item_click" in schema


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_sample_source_round_trip(spark, tiny_samples, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_samples(tiny_samples, path, fmt)
    back = read_samples(spark, path, fmt)
    check_schema(back)
    assert back.exceptAll(tiny_samples.select(back.columns)).count() == 0
    assert preview(back, 3).count() == 3


def test_schema_check_names_the_columns(spark, tiny_samples):
    with pytest.raises(ValueError, match="item_ctr"):
        check_schema(tiny_samples.drop("item_ctr"))
    with pytest.raises(ValueError, match="user_item_click is string"):
        check_schema(tiny_samples.withColumn("user_item_click", F.lit("x")))
    check_schema(tiny_samples.drop("label"), labelled=False)
    with pytest.raises(ValueError):
        read_samples(spark, "/nowhere", "csv")


def test_sample_table_is_the_same_however_it_is_cut(spark, tiny_samples):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = tiny_samples.drop("user_embedding", "item_embedding")
    for chunks, rows_per_key in ((1, 10**6), (40, 10**6), (40, 2)):
        got = planted_samples(events.repartition(7), embeddings, chunks, rows_per_key).select(want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_impressions_without_embedding_stay(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    some = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").filter("vec_id % 2 = 0")
    out = sample_table(events, some)
    assert out.count() == events.count() > out.filter("user_embedding is not null").count() > 0


def test_hot_user_and_item_join_is_split(spark):
    """With broadcasting off and one hot user and item, the merge joins split the hot partition."""
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    embeddings = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    hot = F.col("event_id") % 2 == 0
    events = events.withColumns({
        "user_id": F.when(hot, 3).otherwise(F.col("user_id")),
        "props": F.when(hot, F.lit('{"k": 5}')).otherwise(F.col("props")),
    })
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = planted_samples(events, embeddings).select("event_id", "user_id", "user_item_click", "item_ctr")
        rows = df.collect()
        assert "skew=true" in df._jdf.queryExecution().toString().lower()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(rows) == events.count()
    assert all(math.isfinite(r["item_ctr"]) for r in rows)
