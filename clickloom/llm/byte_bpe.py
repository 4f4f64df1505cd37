"""Byte-level BPE: encoding of whole texts to ids, decoding of ids to bytes.

Encoding folds the ranked merges over the bytes of each distinct word: while some adjacent pair has
a rank, the pair of the lowest rank becomes one piece. Decoding concatenates the pieces' bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.token_counts import merge_word
from clickloom.llm.word_pieces import PieceTokens
from clickloom.session import ship_package

_ID = 21
# A fold looks at all pairs of a word for each merge; beyond this length the heap takes over.
FOLDED_BYTES = 48


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def pair_ranks(path: str) -> dict[int, int]:
    """Every pair of pieces that joins to a piece: ``left << 21 | right`` to ``rank << 21 | rank``."""
    ranks, pairs = read_ranks(path), {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left << _ID | right] = rank << _ID | rank
    return pairs


def fold_merges(symbols: list[int], pairs: dict[int, int]) -> list[int]:
    """Symbols after all merges, lowest rank first, leftmost first among equals."""
    get, none, last = pairs.get, 1 << 62, (1 << _ID) - 1
    ranked = [get(a << _ID | b, none) for a, b in zip(symbols, symbols[1:])]
    while ranked:
        low = min(ranked)
        if low == none:
            break
        i = ranked.index(low)
        symbols[i] = merged = low & last
        del symbols[i + 1], ranked[i]
        # Only the pairs beside the merged one have changed.
        if i < len(ranked):
            ranked[i] = get(merged << _ID | symbols[i + 1], none)
        if i:
            ranked[i - 1] = get(symbols[i - 1] << _ID | merged, none)
    return symbols


class Codec:
    """Encodes texts with a rank file and decodes ids. Ids travel as bytes of 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pairs = read_ranks(path), pair_ranks(path)
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        size = max(self.ranks.values()) + 1
        self.packed = [np.int32(i).tobytes() for i in range(size)]
        pieces = [b""] * size
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        self.lengths = np.array([len(piece) for piece in pieces])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.encode = PieceTokens(pattern, self.of_word, b"".join).of_text

    def of_word(self, word: str) -> bytes:
        data = word.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return self.packed[whole]
        symbols = [self.of_byte[b] for b in data]
        if len(symbols) <= FOLDED_BYTES:
            fold_merges(symbols, self.pairs)
        else:
            merge_word(symbols, self.pairs)
        return b"".join([self.packed[s] for s in symbols if s >= 0])

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        if not lengths.all():
            raise ValueError("there is an id outside the vocabulary")
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(n)].tobytes()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """Columns ``doc_id``, ``ids``, and the bytes of the decoded ids if ``decoded`` is set.

    A row for each row of ``docs``; a null or empty text has no ids; special strings are ordinary
    text; texts are taken whole; repeated rows are encoded one by one; a null ``doc_id`` stays null;
    other columns are not read. ``path`` is the rank file on every executor.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start in range(0, len(batch), 100):
                part = batch.slice(start, 100)
                rows = [own.encode(text.as_py() or "") for text in part.column(1)]
                ends = np.cumsum([0, *map(len, rows)]) // 4
                ids = np.frombuffer(b"".join(rows), np.int32)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
                if decoded:
                    columns.append(pa.array([own.decode(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns ``doc_id``, ``decoded`` (bytes) of a table with ``doc_id`` and ``ids``.

    Null ids, alone or as a whole array, give null; an id outside the vocabulary raises.
    """
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            out = [None if ids is None or None in ids else own.decode(np.array(ids, np.int64)) for ids in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
