"""Alignment of two tokenizers against a plain version over byte positions."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, decoders

from clickloom.llm import token_alignment

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    "It's  two  spaces\n\n and 'quotes' don't", "a<|endoftext|>b <s> </s> <unk>", "Éé ñ ß İ ΣΑΣ ﬁ 漢字かな ١٢٣ 🙂🙂", "underline ▁ is a space there",
    "x" * 3000, "word " * 4000, "the cat and the dog", "the cat and the dog", " lead", "trail ", "\n", "\x00 \x1c", "​",
]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spans(parts: list[bytes]) -> list[tuple[int, int]]:
    at, out = 0, []
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def plain(rows, libraries) -> list[tuple]:
    """Links from the owner of every byte, groups from sets of ends."""
    first, second = libraries
    decode, coded = decoders.ByteLevel(), []
    symbols = {c: b for b, c in token_alignment.byte_symbols().items()}
    assert decode.decode([first.id_to_token(i) for i in first.encode(" héllo", add_special_tokens=False).ids]) == " héllo"
    for doc, text in rows:
        text = text or ""
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        part_a = [bytes(symbols[c] for c in first.id_to_token(i)) for i in a]
        part_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(part_a) == b"".join(part_b) == (" " + text).encode():
            coded.append((doc, [], [], set(), []))
            continue
        owners = list(zip([k for k, p in enumerate(part_a) for _ in p], [k for k, p in enumerate(part_b) for _ in p]))
        last = {e for _, e in spans(part_a)} & {e for _, e in spans(part_b)}
        sides = []
        for ids, parts in ((a, part_a), (b, part_b)):
            side = [[]]
            for i, (_, end) in zip(ids, spans(parts)):
                side[-1].append(str(i))
                if end in last:
                    side.append([])
            sides.append([",".join(group) for group in side[:-1]])
        groups = [f"{x}|{y}" for x, y in zip(*sides, strict=True)]
        coded.append((doc, a, b, set(owners), groups))
    counts = Counter(p for _, a, b, links, _ in coded for p in {(a[x], b[y]) for x, y in links})
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc, a, b, links, groups in coded:
        own = [counts[a[x], b[y]] for x, y in links]
        n_best = sum(counts[a[x], b[y]] == best[a[x]] for x, y in links)
        out.append((doc, len(a), len(b), len(groups), len(links), n_best, sum(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def ours(df, **options) -> list[tuple]:
    return sorted((tuple(r) for r in token_alignment.align_tokenizers(df, *PATHS, **options).collect()), key=str)


@pytest.mark.parametrize("frequent", [300_000, 20, 0])
def test_equals_a_plain_version(make, libraries, frequent):
    df = make(TEXTS)
    assert ours(df, frequent=frequent) == plain([(r.doc_id, r.text) for r in df.collect()], libraries)


def test_awkward_rows(awkward, nothing, libraries):
    assert ours(awkward) == plain([(r.doc_id, r.text) for r in awkward.collect()], libraries)
    assert token_alignment.align_tokenizers(nothing, *PATHS).count() == 0


def test_texts_that_do_not_come_back_have_no_tokens(make):
    row = ours(make(["underline ▁ is a space there"]))[0]
    assert row == (0, 0, 0, 0, 0, 0, 0, "")


def test_test_table(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert ours(docs) == plain([(r.doc_id, r.text) for r in docs.collect()], libraries)


@pytest.fixture(scope="module")
def encoders():
    return token_alignment.Encoders(*PATHS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab c'.,\n\té1<s>_T▁ 　\x1c\x85漢", max_size=60), max_size=3))
def test_ids_by_piece_are_those_of_whole_texts(encoders, libraries, texts):
    first, second = libraries
    assert encoders.by_piece
    for text, (a, b) in zip(texts, encoders.of_texts(texts)):
        want = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        assert (a, b) == (want if text and encoders._whole(text, *want) else ([], []))


def test_the_memo_starts_anew_when_it_is_full(encoders, libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "_PIECES_KEPT", 3)
    for text, (a, b) in zip(TEXTS, encoders.of_texts(TEXTS)):
        if a:
            assert (a, b) == (libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)))))
def test_runs_and_groups_of_any_ends(case):
    n, a, b = case
    ends_a, ends_b = sorted(a | {n}), sorted(b | {n})
    items = list(token_alignment.align(ends_a, ends_b))
    cuts = []
    for i, to_i, j, to_j in items:
        if ends_a[i] == ends_b[j]:
            assert ends_a[i:to_i] == ends_b[j:to_j]
            cuts += ends_a[i:to_i]
        else:
            assert ends_a[to_i - 1] == ends_b[to_j - 1] and not set(ends_a[i : to_i - 1]) & set(ends_b[j : to_j - 1])
            cuts.append(ends_a[to_i - 1])
    assert cuts == sorted(set(ends_a) & set(ends_b))
    assert [i for i, *_ in items][1:] == [to for _, to, *_ in items][:-1] and items[-1][1] == len(ends_a) and items[-1][3] == len(ends_b)
