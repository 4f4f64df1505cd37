"""Line, near-duplicate and passage deduplication against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import line_dedup, near_dedup, substring_dedup
from clickloom.llm.components import components


def order_key(row):
    return (row.doc_id is None, row.doc_id or 0)


def brute_lines(texts: dict[int, str], least_chars: int) -> dict[int, str]:
    """Texts without lines in a run of 1, 2, 4, ... lines of enough characters that begins earlier too."""
    lines = {i: t.split("\n") for i, t in sorted(texts.items())}
    gone = {i: set() for i in lines}
    size = 1
    while any(len(own) >= size for own in lines.values()):
        seen = set()
        for i, own in lines.items():
            for at in range(len(own) - size + 1):
                run = tuple(own[at : at + size])
                if run in seen and sum(map(len, run)) >= least_chars:
                    gone[i].update(range(at, at + size))
                seen.add(run)
        size *= 2
    return {i: "\n".join(x for k, x in enumerate(own) if k not in gone[i]) for i, own in lines.items()}


@pytest.mark.parametrize("least_chars", [0, 3, 8])
def test_lines_equal_brute_force(make, least_chars):
    draw = random.Random(least_chars)
    words = ["a", "bb", "ccc", "dddd", "", "eeeee"]
    texts = ["\n".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(25)]
    texts += [texts[3], texts[3] + "\n" + texts[5], "\n".join(["same"] * 9)]
    df = make(texts)
    rows = line_dedup.delete_repeated_lines(df, least_chars).collect()
    assert {r.doc_id: r.text for r in rows} == brute_lines(dict(enumerate(texts)), least_chars)
    assert all(r.n_lines == texts[r.doc_id].count("\n") + 1 for r in rows)
    assert all(r.n_lines - r.n_removed == (r.text.count("\n") + 1 if r.n_removed < r.n_lines else 0) for r in rows)


def test_lines_of_awkward_rows(awkward, nothing):
    out = line_dedup.delete_repeated_lines(awkward, 5)
    assert out.columns == [*[c for c in awkward.columns if c != "n_removed"], "n_lines", "n_removed"]
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == awkward.count()
    assert (rows[7][0].text, rows[7][0].n_lines, rows[3][0].text, rows[3][0].n_lines) == (None, 0, "", 1)
    assert [r.text for r in rows[8]] == ["same words in it"] * 2  # repeated rows are one document
    assert (rows[9][0].text, rows[9][0].n_removed) == ("", 1)
    assert rows[None][0].text == "no id here"
    assert line_dedup.delete_repeated_lines(nothing).count() == 0


def brute_components(texts: dict[int, str | None], words: int, threshold: int) -> dict[int, int]:
    sets = {}
    for i, text in texts.items():
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = lowered.encode().split()
        runs = [tuple(own)] if 0 < len(own) < words else [tuple(own[k : k + words]) for k in range(len(own) - words + 1)]
        sets[i] = set(runs) if own else set()
    label = {i: i for i in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_brute_force(make, words):
    draw = random.Random(words)
    vocabulary = [f"w{k}" for k in range(400)]
    texts: list[str | None] = []
    for _ in range(12):
        base = draw.choices(vocabulary, k=draw.randint(8, 120))
        texts.append(" ".join(base))
        for _ in range(draw.randint(0, 9)):  # chains: each copy is an edit of one before
            own = draw.choice(texts[-4:]).split()
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            texts.append(" ".join(own) if draw.random() < 0.5 else " ".join(own).upper())
    texts += ["", None, "  ", "w1", "W1", "w1 w2", "w1 w2 w3"]
    rows = near_dedup.component_ids(make(texts), words=words).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute_components(dict(enumerate(texts)), words, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_copies_of_awkward_rows(awkward, nothing):
    out = near_dedup.component_ids(awkward, words=2)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == awkward.count()
    assert (rows[9].component_id, rows[9].kept, rows[8].component_id, rows[8].kept) == (8, False, 8, True)
    assert (rows[None].component_id, rows[None].kept) == (None, True)
    assert [rows[i].n_shingles for i in (7, 3, 4, 5, 9)] == [0, 0, 0, 1, 3]
    kept = near_dedup.keep_one_of_each(awkward, words=2)
    assert kept.columns == awkward.columns and sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(-1)) == [-1, 2, 3, 4, 5, 6, 7, 8, 8]
    assert near_dedup.component_ids(nothing).count() == 0


def test_large_groups_make_no_pairs(make):
    base = " ".join(f"v{k}" for k in range(60)).split()
    texts = [" ".join([*base[:k], f"edit{k}", *base[k + 1 :]]) for k in range(60)] + [" ".join(base)] * 40
    rows = near_dedup.component_ids(make(texts), words=2).collect()
    assert {r.component_id for r in rows} == {0}


def test_a_document_of_several_texts_keeps_the_links_of_each(make):
    one, two, three = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    near = [text.rsplit(" ", 1)[0] + " end" for text in (one, two)]
    rows = [(5, one, "en", "s", 0), (5, two, "en", "s", 0), (7, near[0], "en", "s", 0), (3, near[1], "en", "s", 0), (9, three, "en", "s", 0)]
    found = {r.doc_id: r.component_id for r in near_dedup.component_ids(make(rows), words=2).collect()}
    assert found == {3: 3, 5: 3, 7: 3, 9: 9}


def test_pruning_rules_keep_similar_pairs():
    rules = near_dedup.least_matches(0.8, 1e-6, 240)
    assert rules[-1][0] == 240 and all(a < b for a, b in zip(rules, rules[1:]))
    assert all(least <= 0.8 * seen for seen, least in rules) and rules[0][1] > 0.3 * rules[0][0]


@pytest.mark.parametrize("size", [50, 1500, 20_000])
def test_pruning_drops_pairs_below_the_threshold_at_every_length(size):
    draw, n = np.random.default_rng(size), near_dedup.BANDS * near_dedup.ROWS
    rules = near_dedup.least_matches(0.8, 1e-6, n)

    def goes_on(similarity: float) -> float:
        """Share of pairs of that similarity that all rules let through."""
        through = 0
        for _ in range(20):
            both = round(similarity * 2 * size / (1 + similarity))
            words = draw.integers(0, 2**63, 2 * size - both, dtype=np.uint64) * np.uint64(2)
            a, b = (near_dedup.codes_of(near_dedup.signature(np.unique(s), n)) for s in (words[:size], words[size - both :]))
            at = np.zeros(1, np.int64)
            through += len(near_dedup.passing(a[None, :], b[None, :], at, at, rules)[0])
        return through / 20

    assert goes_on(0.66) == 0 and goes_on(0.5) == 0
    assert goes_on(0.8) == 1 and goes_on(0.9) == 1


def test_members_of_buckets_meet_in_tiles(make, monkeypatch):
    """Groups just below and just above the threshold to one another, in tiles of three members."""
    monkeypatch.setattr(near_dedup, "TILE", 3)
    monkeypatch.setattr(near_dedup, "FEW", 4)
    draw = random.Random(5)
    texts = []
    for edits in (9, 6, 4):  # of 100 words; two copies differ in twice as many places
        base = [f"g{edits}x{k}" for k in range(100)]
        for _ in range(25):
            own = list(base)
            for k in draw.sample(range(100), edits):
                own[k] = f"e{draw.randrange(10**9)}"
            texts.append(" ".join(own))
    draw.shuffle(texts)
    rows = near_dedup.component_ids(make(texts), words=1).collect()
    plain = brute_components(dict(enumerate(texts)), 1, 80)
    assert {r.doc_id: r.component_id for r in rows} == plain
    assert len(set(plain.values())) > 3


def test_a_component_of_many_buckets_is_in_tiles_once(make, monkeypatch):
    """Near copies that share most of their bands, beside texts just below the threshold to them."""
    monkeypatch.setattr(near_dedup, "TILE", 16)
    monkeypatch.setattr(near_dedup, "FEW", 4)
    held, stored = [], near_dedup.stored

    def watched(df, name):
        table = stored(df, name)
        if name == "tiles":
            held.append(table.selectExpr("inline(members)").groupBy("rep").count().toPandas().set_index("rep")["count"].to_dict())
        return table

    monkeypatch.setattr(near_dedup, "stored", watched)
    draw, base, texts = random.Random(11), [f"w{k}" for k in range(100)], []
    for edits in [3] * 40 + [12] * 10:
        own = list(base)
        for k in draw.sample(range(100), edits):
            own[k] = f"e{draw.randrange(10**9)}"
        texts.append(" ".join(own))
    rows = near_dedup.component_ids(make(texts), words=1).collect()
    plain = brute_components(dict(enumerate(texts)), 1, 80)
    assert {r.doc_id: r.component_id for r in rows} == plain and len(set(plain.values())) > 1
    copies = [sum(tiles.get(k, 0) for k in range(40)) / 40 for tiles in held]
    assert len(held) == 2 and max(copies) < 8  # before, a member was in a tile of each of some 30 buckets


def test_bands_that_met_before_are_found_in_parts(monkeypatch):
    monkeypatch.setattr(near_dedup, "_PASSED_AT_ONCE", 7)
    n, draw = near_dedup.BANDS * near_dedup.ROWS, np.random.default_rng(8)
    codes = draw.integers(0, 2, (30, n), dtype=np.uint8)
    i, j, of_band = (draw.integers(0, high, 500) for high in (30, 30, near_dedup.BANDS))
    keys = near_dedup.band_keys(codes, near_dedup.BANDS)
    plain = [bool((keys[a, :k] == keys[b, :k]).any()) for a, b, k in zip(i, j, of_band)]
    assert near_dedup.meet_before(codes, codes, i, j, of_band, near_dedup.BANDS).tolist() == plain
    assert len(near_dedup.meet_before(codes, codes, i[:0], j[:0], of_band[:0], near_dedup.BANDS)) == 0


@pytest.mark.parametrize("best_only", [True, False])
def test_tiles_give_promising_pairs_of_different_components(best_only):
    n = near_dedup.BANDS * near_dedup.ROWS
    rules = near_dedup.least_matches(0.8, 1e-6, n)
    draw = np.random.default_rng(3)
    base = draw.integers(0, 256, n, dtype=np.uint8)

    def member(rep: int, label: int, changed: int, size: int = 100) -> dict:
        code = base.copy()
        code[np.arange(changed) * n // max(changed, 1)] += np.uint8(rep + 1)
        shingles = np.arange(size if rep != 7 else 60, dtype=np.uint32)  # 7 has too few in common with all
        return {"rep": rep, "label": label, "n": size, "code": code.tobytes(), "shingles": shingles.tobytes()}

    kind = pa.list_(pa.struct([("rep", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("code", pa.binary()), ("shingles", pa.binary())]))
    left = [member(0, 0, 0), member(1, 0, 10), member(2, 2, 400), member(3, 3, 20), member(4, 4, 30), member(5, 5, 0, 200)]
    right = [member(6, 0, 5), member(7, 7, 40)]
    columns = [pa.array([0, 0]), pa.array([left, left[:1]], kind), pa.array([right, []], kind)]

    def found(sides: int) -> set:
        batch = pa.RecordBatch.from_arrays(columns[: sides + 1], ["band", "one", "other"][: sides + 1])
        return {(int(x), int(y)) for a, b in near_dedup.compare_tiles(batch, near_dedup.BANDS, n, rules, 80, best_only) for x, y in zip(a, b)}

    # 2 agrees with none of them, 5 is too long, 0 and 1 (and 6) are connected already.
    every = {(0, 3), (0, 4), (1, 3), (1, 4), (3, 4)}, {(3, 6), (4, 6)}
    best = {(0, 3), (1, 3), (0, 4), (3, 4)}, {(3, 6), (4, 6)}
    assert (found(1), found(2)) == (best if best_only else every)
    assert near_dedup.band_keys(np.empty((0, n), np.uint8), near_dedup.BANDS).shape == (0, near_dedup.BANDS)
    columns[0] = pa.array([near_dedup.BANDS - 1] * 2)  # all of them share a bucket of an earlier band
    assert (found(1), found(2)) == (set(), set())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=45))
def test_components_of_random_links(spark, links):
    label = {}
    for a, b in links:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in rows} == label and len(rows) == len(label)


def brute_passages(texts: dict[int, str], window: int) -> dict[int, tuple[int, str]]:
    first = {}
    words = {i: t.encode().split() for i, t in sorted(texts.items())}
    for i, own in words.items():
        for at in range(len(own) - window + 1):
            first.setdefault(tuple(own[at : at + window]), i)
    out = {}
    for i, own in words.items():
        gone = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at : at + window])] < i:
                gone.update(range(at, at + window))
        out[i] = (len(gone), b" ".join(w for k, w in enumerate(own) if k not in gone).decode())
    return out


@pytest.mark.parametrize("window,seed", [(50, 1), (6, 2), (3, 3)])
def test_passages_equal_brute_force(make, window, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}é" for k in range(300 if window > 3 else 6)]
    passages = [draw.choices(vocabulary, k=draw.randint(window, 3 * window)) for _ in range(8)]
    texts = []
    for _ in range(40):
        own = []
        for _ in range(draw.randint(0, 4)):
            own += draw.choices(vocabulary, k=draw.randint(0, window))
            piece = list(draw.choice(passages))
            if draw.random() < 0.5:
                piece = piece[draw.randint(0, window // 2) :]
            own += piece
        texts.append(draw.choice([" ", "\n", " \t "]).join(own))
    texts += [texts[5], texts[5], "Z " + texts[5]]
    rows = substring_dedup.delete_repeats(make(texts), window).collect()
    want = brute_passages(dict(enumerate(texts)), window)
    assert {r.doc_id: (r.n_removed, " ".join(r.text.split())) for r in rows} == want
    assert all(r.text == texts[r.doc_id] for r in rows if not r.n_removed)
    assert all(r.n_words == len(texts[r.doc_id].split()) for r in rows)


def test_frequent_passage_is_many_groups(make, monkeypatch):
    monkeypatch.setattr(substring_dedup, "DOCS_PER_GROUP", 4)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [f"own{k} {passage} end{k}" for k in range(50)]
    rows = substring_dedup.delete_repeats(make(texts)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(k, 60 if k else 0) for k in range(50)]


def test_passages_of_awkward_rows(awkward, nothing):
    out = substring_dedup.delete_repeats(awkward, window=3)
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == awkward.count()
    assert (rows[7][0].text, rows[7][0].n_words, rows[9][0].text, rows[9][0].n_removed) == (None, 0, "", 4)
    assert [(r.text, r.n_removed) for r in rows[8]] == [("same words in it", 0)] * 2
    assert rows[None][0].text == "no id here" and out.columns[:5] == awkward.columns[:5]
    assert substring_dedup.delete_repeats(nothing).count() == 0
