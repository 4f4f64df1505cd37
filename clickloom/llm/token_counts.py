"""Number of tokens of whole texts under a byte-level byte-pair vocabulary, without the tokens.

Each word's symbols stand in a linked list, its adjacent pairs in a heap ordered by merge rank and
place. The lowest pair is popped and merged until none is left; the count is the number of symbols
at the start less the number of merges.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.word_pieces import PieceTokens
from clickloom.session import ship_package

SCHEMA = "doc_id long, n_bytes long, n_tokens long"
_PLACE = 40
_ID = 21


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in vocabularies of this kind: itself where
    it is printable, otherwise the next of the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def merge_word(symbols: list[int], pairs: dict[int, int]) -> int:
    """Merge a word's symbols in place (removed ones become -1); returns the number of merges.

    ``pairs`` maps ``left << 21 | right`` to ``rank << 21 | merged``.
    """
    n, get = len(symbols), pairs.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [found >> _ID << _PLACE | i for i in range(n - 1) if (found := get(symbols[i] << _ID | symbols[i + 1])) is not None]
    heapify(heap)
    merges, place = 0, (1 << _PLACE) - 1
    while heap:
        entry = heappop(heap)
        i = entry & place
        left = symbols[i]
        j = after[i]
        if left < 0 or j >= n:
            continue
        found = get(left << _ID | symbols[j])
        if found is None or found >> _ID != entry >> _PLACE:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = found & (1 << _ID) - 1, -1
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := get(symbols[i] << _ID | symbols[k])) is not None:
                heappush(heap, found >> _ID << _PLACE | i)
        h = before[i]
        if h >= 0 and (found := get(symbols[h] << _ID | symbols[i])) is not None:
            heappush(heap, found >> _ID << _PLACE | h)
    return merges


@lru_cache(maxsize=2)
def text_counter(path: str, pattern: str) -> Callable[[str], int]:
    """A function from a text to its number of tokens; special strings count as one each."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ids = spec["model"]["vocab"]
    pairs = {}
    for rank, (left, right) in enumerate(spec["model"]["merges"]):
        pairs[ids[left] << _ID | ids[right]] = rank << _ID | ids[left + right]
    of_byte = [ids[symbol] for _, symbol in sorted(byte_symbols().items())]

    def count(word: str) -> int:
        symbols = [of_byte[b] for b in word.encode()]
        return len(symbols) - (merge_word(symbols, pairs) if len(symbols) > 1 else 0)

    plain = PieceTokens(pattern, count, sum).of_text
    special = [token["content"] for token in spec["added_tokens"]]
    if not special:
        return plain
    if len(special) > 1:
        raise ValueError("vocabularies with several special tokens aren't supported")

    def of_text(text: str) -> int:
        parts = text.split(special[0])
        return sum(map(plain, parts)) + len(parts) - 1

    return of_text


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns ``doc_id``, ``n_bytes`` (of the UTF-8 text), ``n_tokens``; a row for each row of ``docs``.

    A null text counts as empty: no bytes, no tokens. Texts of any length are counted whole; repeated
    rows are counted one by one; a null ``doc_id`` stays null; other columns are not read. ``path`` is
    the vocabulary's file on every executor.
    """
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text = text_counter(path, pattern)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(of_text(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(count, SCHEMA)
