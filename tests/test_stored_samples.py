"""Samples stored without their embeddings, and features that are made once."""

from __future__ import annotations

import pytest

from clickloom import session
from clickloom.operators import features
from clickloom.operators.features import fit_and_prepare, fit_features
from clickloom.operators.split import hash_split
from clickloom.sources import impressions
from conftest import TINY
from verification.fixtures import DIM, LABEL, planted_samples
from verification.queries import split


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _tables(spark):
    return spark.read.parquet(f"{TINY}/events.parquet"), spark.read.parquet(f"{TINY}/embeddings.parquet")


def _stored_bare(monkeypatch):
    """The columns of each table that is stored from now on."""
    seen = {}
    real = impressions.materialise

    def watching(df, name, *rest):
        seen[name] = df.columns
        return real(df, name, *rest)

    monkeypatch.setattr(impressions, "materialise", watching)
    return seen


@pytest.mark.parametrize("repeated", [False, True])
def test_stored_samples_are_the_samples(spark, monkeypatch, repeated):
    events, embeddings = _tables(spark)
    if repeated:
        # A number that two embeddings have gives two rows, not four; one that none has gives nulls.
        embeddings = embeddings.filter("vec_id <> 3").unionByName(embeddings.filter("vec_id = 5"))
    seen = _stored_bare(monkeypatch)
    stored = impressions.stored_samples(embeddings, lambda vectors, number: planted_samples(events, vectors, references=number))
    assert "user_embedding" not in seen["samples"] and "item_embedding" not in seen["samples"]
    assert stored.columns == planted_samples(events, embeddings).columns
    assert _rows(stored) == _rows(planted_samples(events, embeddings))


def test_embeddings_too_many_to_broadcast_stay_in_their_rows(spark, monkeypatch):
    events, embeddings = _tables(spark)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    seen = _stored_bare(monkeypatch)
    stored = impressions.stored_samples(embeddings, lambda vectors, number: planted_samples(events, vectors, references=number))
    assert "user_embedding" in seen["samples"]
    assert _rows(stored) == _rows(planted_samples(events, embeddings))


def test_split_is_drawn_once_and_is_the_hash_split(spark):
    events, embeddings = _tables(spark)
    for ours, theirs in zip(split(spark, TINY), hash_split(planted_samples(events, embeddings), "event_id")):
        assert _rows(ours.select("event_id", LABEL)) == _rows(theirs.select("event_id", LABEL))
        assert "md5" not in ours._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("layout", ["base", "inner", "outer"])
def test_vectors_made_once_are_those_of_the_fitted_stages(spark, tiny_samples, monkeypatch, layout):
    passes = []
    real = features.materialise

    def counting(df, *rest):
        passes.append(df.columns)
        return real(df, *rest)

    monkeypatch.setattr(features, "materialise", counting)
    model, prepared = fit_and_prepare(tiny_samples, layout, DIM, LABEL)
    plain = fit_features(tiny_samples, layout, DIM)
    assert passes == [["vectorFeature", LABEL]]
    assert _rows(prepared) == _rows(plain.transform(tiny_samples).select(features.FEATURES, LABEL))
    assert _rows(model.transform(tiny_samples).select(features.FEATURES)) == _rows(plain.transform(tiny_samples).select(features.FEATURES))
    assert features.vector_width(prepared) == features.vector_width(plain.transform(tiny_samples))
    # Nothing of the making is left in the plan that each pass reads.
    assert "zip_with" not in prepared._jdf.queryExecution().optimizedPlan().toString()
