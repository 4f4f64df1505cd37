"""Top-k search and fingerprints against brute force."""

from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import fingerprints, topk


def brute_top(vectors: dict[int, list[int]], step: int, k: int) -> list[tuple]:
    width = max(map(len, vectors.values()), default=0)
    padded = {i: v + [0] * (width - len(v)) for i, v in vectors.items()}
    out = []
    for q in padded:
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(padded[q], v)), i) for i, v in padded.items() if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, vectors: dict, step: int, k: int) -> list[tuple]:
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, vector array<long>").repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % step == 0, k).collect())


@pytest.mark.parametrize("kind", ["clusters", "copies", "lines"])
def test_search_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "SEGMENT", 40)
    monkeypatch.setattr(topk, "ANNULUS", 8)
    monkeypatch.setattr(topk, "CHUNK", 5)
    rng = np.random.default_rng(len(kind))
    if kind == "clusters":
        rows = rng.normal(rng.integers(-60, 60, (9, 6))[rng.integers(0, 9, 700)], 9).astype(int)
    elif kind == "copies":  # one vector a third of all, and ties
        rows = rng.integers(-3, 4, (400, 4))
        rows[rng.random(400) < 0.35] = [2, 1, 0, 3]
    else:
        rows = np.outer(np.arange(-150, 150), [1, 2])
    vectors = {3 * i + 1: r.tolist() for i, r in enumerate(rows)}
    assert found(spark, vectors, 10, 5) == brute_top(vectors, 10, 5)


def test_search_of_awkward_rows(spark):
    rows = [(0, [1.0, None]), (10, [1.0, float("nan")]), (20, [float("inf"), 0.0]), (30, None), (None, [1.0, 1.0]), (40, []), (50, [0.5]), (60, [0.5, -0.25]), (60, [0.5, -0.25]), (7, [1e-9, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("mine")).withColumn("rank", F.lit(0))
    got = sorted(tuple(r) for r in topk.top_k(df.select("*", topk.scaled("embedding").alias("vector")), F.col("vec_id") % 10 == 0).collect())
    assert got == brute_top({40: [], 50: [128], 60: [128, -64], 7: [0, 512]}, 10, 5)
    assert found(spark, {}, 1, 5) == [] and found(spark, {5: [1]}, 1, 5) == []
    with pytest.raises(ValueError, match="too large"):
        found(spark, {0: [1 << 40], 1: [1]}, 1, 5)


def plain_signature(text: str, size: int, picked: int, k: int) -> list[int]:
    """The same components with the k-mers' hashes sorted one hash function at a time."""
    hashes = fingerprints.numbered_kmers(text, k).tolist()
    flip, factor = fingerprints._seeds(size)
    out = []
    for f, m in zip(flip[:, 0].tolist(), factor[:, 0].tolist()):
        order = sorted(range(len(hashes)), key=lambda i: ((((hashes[i] >> 32) ^ f) * m) & 0xFFFFFFFF, i))[:picked]
        total = np.zeros(1, np.uint64)
        for i in sorted(order):
            total = fingerprints.mix(total * np.uint64(0x9E3779B97F4A7C15) + np.uint64(hashes[i]))
        out.append(int(total[0] >> np.uint64(32)) if hashes else 0)
    return out


def test_signature_of_blocks_equals_plain_one(monkeypatch):
    monkeypatch.setattr(fingerprints, "_BLOCK", 16)
    draw = random.Random(4)
    for n in (0, 1, 3, 8, 9, 40, 333):
        text = "".join(draw.choices("abcé ", k=n))
        assert fingerprints.OrderMinHash(8, 3, 4)(text).tolist() == plain_signature(text, 8, 3, 4)


def test_likeness_follows_edits():
    draw, sketch = random.Random(5), fingerprints.OrderMinHash()
    text = "".join(draw.choices("abcdefghij ", k=2000))
    near = sketch.likeness(sketch(text), sketch(text[:1000] + "X" + text[1000:]))
    half = sketch.likeness(sketch(text), sketch(fingerprints.edited(text, "".join(draw.choices("klmnop", k=2000)))))
    moved = sketch.likeness(sketch(text), sketch(" ".join(reversed(text.split(" ")))))
    assert sketch.likeness(sketch(text), sketch(text)) == 1.0 > near > 0.9 > half > 0.1 and moved < near


def test_repeats_are_numbered():
    sketch = fingerprints.OrderMinHash()
    assert sketch.likeness(sketch("ab" * 400), sketch("ab" * 40)) < 0.6


def test_documents_against_the_next(make, awkward):
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcé🙂 \n", k=draw.randint(0, 300))) for _ in range(60)] + [None]
    df = make([(5 * i, t, "en", "s", 0) for i, t in enumerate(texts)])
    rows = {r.doc_id: r for r in fingerprints.compare_with_next(df).collect()}
    own = {r.doc_id: r for r in fingerprints.fingerprints(df).collect()}
    ids, sketch = sorted(rows, reverse=True), fingerprints.OrderMinHash()
    assert len(rows) == len(texts)
    for at, i in enumerate(ids):
        text, other = texts[i // 5] or "", texts[ids[(at + 1) % len(ids)] // 5] or ""
        changed = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert rows[i].n_chars == len(text) and rows[i].fingerprint == own[i].fingerprint
        assert rows[i].edited_sha256 == sha256(changed.encode()).hexdigest()
        assert rows[i].edited_fingerprint == fingerprints.hexadecimal(sketch(changed))
        assert rows[i].near_next == sketch.likeness(sketch(text), sketch(other))
    got = fingerprints.compare_with_next(awkward).collect()
    assert len(got) == awkward.count()
    none = [r for r in got if r.doc_id is None][0]
    assert none.edited_sha256 is None and none.near_next is None and none.n_chars == 10


def test_one_document_and_none(make, nothing):
    row = fingerprints.compare_with_next(make(["abcdef"])).first()
    assert row.edited_sha256 == sha256(b"abcabc").hexdigest() and row.near_next == 1.0
    assert fingerprints.compare_with_next(nothing).count() == 0
