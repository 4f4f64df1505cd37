"""Language and quality: held-out accuracy, exact selection, awkward rows."""

from __future__ import annotations

import math
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import language_id, quality
from clickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_awkward_rows(spark, make, awkward, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = language_id.fit(docs.withColumn("nearest", F.lit("mine")))
    rows = language_id.identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    for no_letter in (3, 4, 7):
        assert (by_id[no_letter].nearest, by_id[no_letter].score, by_id[no_letter].lang) == ("und", 0.0, "und")
    far = language_id.identify(make(["漢字かな交じり文です"]), model).first()
    assert far.nearest in model.languages and far.lang == "und"
    assert language_id.identify(nothing, model).count() == 0
    none = language_id.fit(nothing)
    assert none.languages == () and language_id.identify(make(["text"]), none).first().nearest == "und"


def test_no_language_is_lost_to_repeated_texts(spark):
    """Many rows of a language in two texts only, beside many different ones of another."""
    few = spark.range(20_000).selectExpr("if(id % 2 = 0, 'der Hund und die Katze', 'ein Haus am See') text", "'de' lang")
    many = spark.range(40_000).selectExpr("concat('the house number ', id, ' is on the hill') text", "'en' lang")
    model = language_id.fit(few.unionByName(many))
    assert set(model.languages) == {"de", "en"}
    assert model.nearest("die Katze und der Hund")[0] == "de" and model.nearest("the hill is on the house")[0] == "en"
    with pytest.raises(ValueError, match="values of lang"):
        language_id.fit(spark.range(language_id.MOST_LANGUAGES + 1).selectExpr("'a' text", "string(id) lang"))


def test_counts_of_a_long_text_do_not_depend_on_its_parts(monkeypatch):
    text = "".join(random.Random(1).choice("ab c,d  é") for _ in range(5000))
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "_CHARACTERS", 97)
    parts = language_id.gram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def plain_buckets(text: str, buckets: int) -> int:
    """How many n-grams a text has: its words and marks, and the pairs of neighbours."""
    import re

    tokens = re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\s]+", text)
    return max(0, 2 * len(tokens) - 1)


def test_grams_of_rows_do_not_mix():
    texts = ["a b c", "", "b!! c|d", "   ", "é é É", "x"]
    encoded = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, encoded)])
    grams, first = quality.gram_buckets(np.frombuffer(b"".join(encoded), np.uint8), bounds)
    for row, text in enumerate(texts):
        own = grams[first[row] : first[row + 1]]
        alone, _ = quality.gram_buckets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        assert own.tolist() == alone.tolist() and len(own) == plain_buckets(text, 0)


def test_quality_parts_good_from_bad(spark):
    rows = {r.doc_id: r.kept for r in QUERIES["op2_quality"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [rows[r.doc_id] for r in labels if r.quality == 1]
    bad = [rows[r.doc_id] for r in labels if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05
    kept = quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, k in rows.items() if k} and kept.columns == docs.columns


def test_gumbel_top_k_is_exact_and_follows_the_weights(spark):
    values = [random.Random(2).gauss(0, 3) for _ in range(500)] + [1.5] * 20
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    for k in (1, 7, 250, 520):
        least = quality.kth_largest(df, "v", k)
        assert least == math.floor(sorted(values)[-k] * 2**32) / 2**32
    assert quality.kth_largest(df, "v", 0) == math.inf and quality.kth_largest(df, "v", 521) == -math.inf
    rows = spark.range(20_000).select("id", quality.gumbel_key(F.when(F.col("id") % 2 == 0, math.log(3.0)).otherwise(0.0), F.col("id"), 1.0, 3).alias("key"))
    top = rows.orderBy(F.desc("key")).limit(1000)
    assert 0.70 < top.filter("id % 2 = 0").count() / 1000 < 0.80  # three to one


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(9, 1), (5, 0), (2, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    _, rows = quality.resample(awkward, labels)
    assert rows.count() == awkward.count() and rows.filter("kept is null or log_weight is null").count() == 0
    _, some = quality.resample(awkward, labels, k=3)
    assert 3 <= some.filter("kept").count() <= 4  # the repeated row stands or falls as one
    assert quality.resample(nothing, labels)[1].count() == 0
    _, every = quality.resample(awkward, labels.filter("quality = 1"))
    assert every.filter("not kept").count() == 0
    assert quality.keep_good(awkward, labels).columns == awkward.columns


def test_best_threshold():
    assert quality.best_threshold(np.array([1.0, 2.0, 3.0]), np.array([False, True, True])) == pytest.approx(1.5)
    assert quality.best_threshold(np.array([1.0, 2.0]), np.array([True, True])) == -math.inf
    assert quality.best_threshold(np.empty(0), np.empty(0, bool)) == -math.inf
