"""The conversation trie against a plain one built from nested paths."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows) -> list[tuple]:
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, d == len(path)))
    out = {}
    for path in sorted(members, key=len, reverse=True):
        children = [out[p] for p in members if len(p) == len(path) + 1 and p[:-1] == path]
        held = [c for c, _ in members[path]]
        out[path] = {
            "conv_id": min(held), "depth": len(path), "parent_conv_id": min(c for c, _ in members[path[:-1]]) if path else None,
            "n_convs": len(held), "n_children": len(children), "n_leaves": sum(c["n_leaves"] for c in children) or 1,
            "saved_tokens": sum(c["saved_tokens"] for c in children) + (len(held) - 1) * (len(path[-1][1]) if path else 0),
            "ends_sha256": hashlib.sha256(",".join(map(str, sorted(c for c, ends in members[path] if ends))).encode()).hexdigest(),
        }
    return sorted((tuple(node[n] for n in NAMES) for node in out.values()), key=str)


def ours(df, **options) -> list[tuple]:
    out = prefix_trie.trie(df, **options)
    assert out.columns == NAMES
    return sorted((tuple(r) for r in out.collect()), key=str)


AWKWARD = [
    (None, 0, "user", "no id"), (0, None, "user", "first"), (0, 0, None, None), (0, 0, "user", "tie"), (0, 0, "user", "tie"), (0, 1, "assistant", "é🙂" * 4000),
    (7, 0, "user", "short"), (-3, 0, "user", "below zero"), (-103, 0, "user", "no base"), (100, 0, "", ""), (101, 0, "user", "x"), (101, 9, "user", "y"),
]


def copies(n: int) -> list[tuple]:
    """Many conversations of one text, some of which go on, and some turnless ones."""
    rows = [(c, t, "user", f"turn {t}") for c in range(n) for t in range(6 + (c % 3 == 0))]
    return rows + [(100_000 + c, 0, "user", "gone with its head") for c in range(1, 40)]


@pytest.mark.parametrize("shard_rows", [2, 5, 1000])
@pytest.mark.parametrize("queue_held", [1, 100_000])
def test_equals_a_plain_trie(spark, shard_rows, queue_held):
    rows = AWKWARD + copies(90)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ours(df, shard_rows=shard_rows, queue_held=queue_held) == plain(rows)


def test_other_columns_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", 3)
    monkeypatch.setattr(prefix_trie, "_STRETCH", 2)  # long conversations are hashed by stretches
    rows = copies(20) + [(500, t, "user", f"t{t}") for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("depth", "n", "k1", "base", "pos", "level", "top", "chars")})
    assert ours(df) == plain(rows)
    assert ours(spark.createDataFrame([], SCHEMA)) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 5)), max_size=60), st.integers(1, 4))
def test_the_queue_sums_by_place_and_spills(messages, held):
    queue, want = prefix_trie.MessageQueue(held), {}
    for place, value in messages:
        queue.send((place,), (value,))
        want[place] = want.get(place, 0) + value
    for place in range(10):
        assert queue.take((place,)) == ((want[place],) if place in want else None)


def test_the_queue_notices_a_missing_receiver():
    queue = prefix_trie.MessageQueue()
    queue.send((1,), (1,))
    with pytest.raises(ValueError, match="receiver"):
        queue.take((2,))
