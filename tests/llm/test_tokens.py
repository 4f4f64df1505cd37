"""Token counts, byte-level BPE and packing against the libraries and brute force."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import byte_bpe, packing, token_counts
from clickloom.llm.token_counts import merge_word

JSON, RANKS, WORDS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
HARD = [
    "It's  two  spaces\n\n and 'quotes' don't", "a<|endoftext|>b <|endoftext|><|endoftext|>", "\x1c\x1d mixed\x85 white space 　",
    "Éé ñ ß İ ΣΑΣ ﬁ 漢字かな ١٢٣ 🙂🙂", "é café!", "aaaaaaaaaaaaaaaaaaaaaaaa" * 30, "x=1;_y__z, (foo) [bar]. {baz}!? '90s", "tab\tnew\nline\r\n end ",
    " lead", "trail ", "\n", "<|startoftext|>hi<|endoftext|>",
]


@pytest.fixture(scope="module")
def library():
    return {path: Tokenizer.from_file(path) for path in (JSON, WORDS)}


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_counts_equal_the_library(make, awkward, library):
    for df in (make(HARD), awkward):
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library[JSON].encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, JSON, P.PATTERN).collect())
        assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c'.,\n\té1<|>_T", max_size=60))
def test_any_text_has_the_libraries_tokens(text):
    library, words = Tokenizer.from_file(JSON) if not _LIB else _LIB[0], Tokenizer.from_file(WORDS) if not _LIB else _LIB[1]
    if not _LIB:
        _LIB.extend([library, words])
    assert token_counts.text_counter(JSON, P.PATTERN)(text) == len(library.encode(text, add_special_tokens=False).ids)
    own = next(iter(packing.id_encoder(WORDS)([text])))
    assert np.frombuffer(own, "<u4").tolist() == words.encode(text, add_special_tokens=False).ids


_LIB: list = []


def test_ids_equal_the_library_and_decode_to_the_text(make, awkward, encoding):
    for df in (make(HARD), awkward):
        coded = byte_bpe.encode(df, RANKS, P.PATTERN, decoded=True)
        texts = sorted((r.doc_id or -1, r.text or "") for r in df.collect())
        got = sorted(((r.doc_id or -1, bytes(r.decoded).decode(), list(r.ids)) for r in coded.collect()))
        assert [(i, t) for i, t, _ in got] == texts
        assert all(ids == encoding.encode_ordinary(t) for _, t, ids in got)
        again = byte_bpe.decode(coded.drop("decoded"), RANKS, P.PATTERN)
        assert sorted((r.doc_id or -1, bytes(r.decoded).decode()) for r in again.collect()) == texts


def test_decoding_nulls_and_strangers(spark):
    df = spark.createDataFrame([(1, None), (2, [None]), (3, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.decoded if r.decoded is None else bytes(r.decoded)) for r in byte_bpe.decode(df, RANKS, P.PATTERN).collect()) == [(1, None), (2, None), (3, b"")]
    with pytest.raises(Exception, match="index|vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>"), RANKS, P.PATTERN).collect()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdehinorst ", min_size=1, max_size=40))
def test_fold_and_heap_agree(word):
    pairs, ranks = byte_bpe.pair_ranks(RANKS), byte_bpe.read_ranks(RANKS)
    folded = byte_bpe.fold_merges([ranks[bytes([b])] for b in word.encode()], pairs)
    heaped = [ranks[bytes([b])] for b in word.encode()]
    merges = merge_word(heaped, pairs)
    assert folded == [s for s in heaped if s >= 0] and len(word.encode()) - merges == len(folded)


def test_empty_tables(nothing):
    assert token_counts.token_counts(nothing, JSON, P.PATTERN).count() == 0
    assert byte_bpe.encode(nothing, RANKS, P.PATTERN).count() == 0
    assert packing.pack_best_fit(packing.token_pieces(nothing, WORDS)).count() == 0


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_are_the_librarys_ids_and_bins_are_few(make, awkward, library):
    for df in (make([*HARD, "word " * 9000]), awkward):
        pieces = packing.token_pieces(df, WORDS, capacity=512)
        rows = packing.pack_best_fit(pieces.withColumn("crc", F.crc32("ids")), capacity=512).collect()
        want = sorted(((r.doc_id or -1), np.array([*library[WORDS].encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in df.collect())
        parts = {}
        for r in sorted(rows, key=lambda r: (r.doc_id or -1, r.piece)):
            assert r.crc == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 and r.start == 512 * r.piece
            parts.setdefault(r.doc_id or -1, []).append(bytes(r.ids))
        assert sum(len(ids) for _, ids in want) == sum(len(x) for p in parts.values() for x in p)
        single = [(i, ids) for i, ids in want if sum(j == i for j, _ in want) == 1]
        assert all(b"".join(parts[i]) == ids for i, ids in single)
        total = sum(len(ids) // 4 for _, ids in want)
        assert check_packing(rows, 512) <= -(-total // 512) + 1


@pytest.mark.parametrize("sizes", [[2500] * 400, [1] * 500, [4096] * 3, [3000, 1096] * 200, list(range(1, 4097, 7))])
def test_packing_of_hard_sizes(spark, sizes, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 64)  # many groups and rounds
    items = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "id long, length long").repartition(4)
    rows = packing.pack_best_fit(items).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    least = max(-(-sum(sizes) // 4096), sum(n > 2048 for n in sizes))
    assert check_packing(rows, 4096) <= 1.15 * least + 2  # 64 items at a time; 20,000 come closer


def test_packing_refuses_impossible_lengths(spark):
    for bad in (0, 4097, None):
        with pytest.raises(Exception, match="lengths have to be"):
            packing.pack_best_fit(spark.createDataFrame([(bad,)], "length long")).collect()


def test_sequences_hold_their_members_ids(make):
    pieces = packing.token_pieces(make(HARD), WORDS)
    packed = packing.pack_best_fit(pieces)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequence_ids(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
