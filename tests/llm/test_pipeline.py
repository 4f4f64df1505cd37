"""The pipeline's stages against plain versions, and all queries against their SQL texts."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from clickloom.llm import near_dedup, quality
from clickloom.llm.oracles import ORACLES
from clickloom.llm.queries import QUERIES
from .test_dedup import brute_lines, brute_passages
from verification.compare import differences, tables

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    ours = QUERIES[name](spark, TINY).toPandas()
    assert not differences(ours, tables(TINY).execute(ORACLES[name]).df())


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    results = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, results[-1], TINY).write.parquet(path)
        results.append(spark.read.parquet(path))
    assert all(r.columns == docs.columns for r in results[:-1])
    texts = [{r.doc_id: r.text for r in df.collect()} for df in results[:-1]]
    raw, good, lines, single, cut = texts
    labels = spark.read.parquet(f"{TINY}/labels.parquet")
    _, judged = quality.resample(docs, labels)
    assert set(good) == {r.doc_id for r in judged.filter("kept").collect()} and all(good[i] == raw[i] for i in good)
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    assert len(bad & set(good)) <= 0.1 * len(bad)
    assert lines == brute_lines(good, 30)
    components = {r.doc_id: r.component_id for r in near_dedup.component_ids(results[2]).collect()}
    assert single == {i: t for i, t in lines.items() if components[i] == i}
    assert {i: " ".join(t.split()) for i, t in cut.items()} == {i: t for i, (_, t) in brute_passages(single, 50).items()}
    packed = results[-1].collect()
    assert {r.doc_id for r in packed} == set(cut)
    total, bins = sum(r.length for r in packed), len({r.sequence_id for r in packed})
    assert bins <= -(-total // 4096) + 2
    assert all(r.n_chars == len(r.text) for r in results[-2].select("n_chars", "text").collect())


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, TINY)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= corpus_pipeline.CAPACITY


def test_own_columns_of_clashing_names_stay(awkward):
    docs = awkward.withColumn("n_words", F.col("doc_id")).withColumn("n_lines", F.lit("mine"))
    for stage in (corpus_pipeline.delete_lines, corpus_pipeline.delete_passages):
        out = stage(None, docs, "")
        assert out.columns == docs.columns and out.count() == docs.count()
        assert all(r.n_removed == "mine" and r.n_lines == "mine" and r.n_words == r.doc_id for r in out.collect())
