"""Alignment of two tokenizers over whole texts, by diagonal run skipping.

Both token sequences are given by the byte offsets at which tokens end. At places i and j with the
shift j - i, stretches of 4, 8, 16, ... ends are compared as a whole: as long as they are equal, the
tokens of the stretch correspond one to one and are jumped over. Where they differ, the tokens of the
irregular group are walked until both end together, and the shift is that of the places reached.

Which tokens overlap how often over all documents is counted from one row for each document and
pair. Counts go back to the documents in two ways: those of the most frequent pairs, whose number
is bounded, are broadcast, so that no frequent pair is ever a hot key; the others are joined.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.storage import BROADCAST_ROWS, stored
from clickloom.llm.texts import Memo, give_back
from clickloom.llm.token_counts import byte_symbols
from clickloom.session import ship_package

#: An id pair is one number: the first tokenizer's id in the upper half.
_SHIFT = 32
_DOCS_AT_ONCE = 250
_PIECES_KEPT, _PAIRS_KEPT, _PIECES_AT_ONCE = 600_000, 300_000, 1000
_WIDE, _CUT = re.compile(r"\s\s").search, re.compile(r"(?<=\S)(?= \S)").split
_SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def align(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Groups as (from_a, to_a, from_b, to_b), stretches of one-to-one tokens as one item.

    Ends rise and are the same at last. An item with as many tokens on both sides is a stretch only if
    all their ends agree; of an irregular group they agree at its end alone.
    """
    i = j = 0
    n = len(ends_a)
    while i < n:
        start_i, start_j, step = i, j, 4
        if ends_a[i] == ends_b[j]:
            while (same := ends_a[i : i + step]) and same == ends_b[j : j + step]:
                i, j, step = i + len(same), j + len(same), step * 2
            while step > 8:  # the first difference lies within a step
                step //= 2
                if ends_a[i : i + step] == ends_b[j : j + step]:
                    i, j = min(i + step, n), j + min(step, n - i)
            while i < n and ends_a[i] == ends_b[j]:
                i, j = i + 1, j + 1
        if i > start_i:
            yield start_i, i, start_j, j
            continue
        a, b = ends_a[i], ends_b[j]
        while a != b:
            if a < b:
                i += 1
                a = ends_a[i]
            else:
                j += 1
                b = ends_b[j]
        i, j = i + 1, j + 1
        yield start_i, i, start_j, j


def links_and_groups(a: list[int], b: list[int], ends_a: list[int], ends_b: list[int], show: list[str], show_pair: dict[int, str]) -> tuple[list[int], list[str]]:
    """Every pair of tokens whose bytes overlap, and the groups as text."""
    links, groups = [], []
    for i, to_i, j, to_j in align(ends_a, ends_b):
        own_a, own_b = a[i:to_i], b[j:to_j]
        if ends_a[i] == ends_b[j]:  # one to one
            own = [x << _SHIFT | y for x, y in zip(own_a, own_b)]
            links += own
            groups += map(show_pair.__getitem__, own)
            continue
        groups.append(f"{','.join([show[x] for x in own_a])}|{','.join([show[y] for y in own_b])}")
        if len(own_a) == 1:
            links += [own_a[0] << _SHIFT | y for y in own_b]
        elif len(own_b) == 1:
            links += [x << _SHIFT | own_b[0] for x in own_a]
        else:
            while i < to_i:
                links.append(a[i] << _SHIFT | b[j])
                end_a, end_b = ends_a[i], ends_b[j]
                i += end_a <= end_b
                j += end_b <= end_a
    return links, groups


class Encoders:
    """Both libraries' ids of whole texts, from the ids of pieces that a bounded memo keeps.

    A space between two characters that are no white space begins a new token in both: in the first by its
    splitting pattern, in the second because no entry has a space behind another character. Both are
    checked, and a vocabulary that isn't so is given whole texts.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(path_a)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {symbol: b for b, symbol in byte_symbols().items()}
        entries = [self.first.id_to_token(i) or "" for i in range(self.first.get_vocab_size())]
        self.bytes_a = [bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode() for entry in entries]
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.same = list(range(max(len(entries), len(pieces))))
        self.show = [str(i) for i in range(max(len(entries), len(pieces)))]
        spec = json.loads(self.first.to_str())
        own, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = spec["normalizer"] is None and own.get("type") == "ByteLevel" and own.get("use_regex") and not own.get("add_prefix_space")
        self.by_piece = plain and all(token["special"] for token in added) and not any("▁" in p.lstrip("▁") for p in pieces)
        self.show_pair = Memo(lambda pair: f"{pair >> _SHIFT}|{pair & (1 << _SHIFT) - 1}", _PAIRS_KEPT)
        self.known: dict[str, tuple[tuple[int, ...], tuple[int, ...], bool]] = {}

    def _pieces(self, text: str) -> list[str]:
        """The text cut before such spaces, which are left out."""
        if not self.by_piece:
            return [text]
        if text[-1].isspace() or _WIDE(" " + text):
            return [piece[1:] for piece in _CUT(" " + text)]
        return text.split(" ")

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) + len(pieces) > _PIECES_KEPT:
            self.known.clear()
        alone = pieces
        if self.by_piece:
            # Many are encoded as one text, which is cut where they end.
            inner = [piece for piece in pieces if not (piece[:1].isspace() or piece[-1:].isspace())]
            alone = [piece for piece in pieces if piece[:1].isspace() or piece[-1:].isspace()]
            parts = [inner[low : low + _PIECES_AT_ONCE] for low in range(0, len(inner), _PIECES_AT_ONCE)]
            together = [" ".join(part) for part in parts]
            coded = self.first.encode_batch_fast([" " + text for text in together], add_special_tokens=False)
            for part, text, a, b in zip(parts, together, coded, self.second.encode(together, num_threads=1)):
                own = a.ids
                bounds = np.cumsum([1 + len(piece.encode()) for piece in part])
                cut_a, cut_b = self._cut_ids(own, self.len_a, bounds), self._cut_ids(b, self.len_b, bounds)
                if cut_a and cut_b and self._whole(text, own, b):
                    self.known.update(zip(part, zip(cut_a, cut_b, repeat(True))))
                else:
                    alone += part
        coded = self.first.encode_batch_fast([" " + piece for piece in alone], add_special_tokens=False)
        for piece, a, b in zip(alone, coded, self.second.encode(alone, num_threads=1)):
            own = a.ids
            self.known[piece] = tuple(own), tuple(b), self._whole(piece, own, b)

    def _cut_ids(self, ids: list[int], lengths: list[int], bounds: np.ndarray) -> list[tuple[int, ...]] | None:
        """The ids between byte bounds, or None if tokens don't end there."""
        ends = np.cumsum([lengths[x] for x in ids])
        cuts = np.searchsorted(ends, bounds)
        if cuts[-1] != len(ends) - 1 or not np.array_equal(ends[cuts], bounds):
            return None
        # The same number objects everywhere: kept pieces hold references into one small table.
        whole, cuts = tuple([self.same[x] for x in ids]), [0, *(cuts + 1).tolist()]
        return [whole[low:high] for low, high in zip(cuts, cuts[1:])]

    def _whole(self, text: str, a: list[int], b: list[int]) -> bool:
        want = (" " + text).encode()
        return b"".join([self.bytes_a[x] for x in a]) == want == b"".join([self.bytes_b[x] for x in b])

    def of_texts(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both for each text; none if the text is empty or its bytes don't come back."""
        cut = [self._pieces(text) if text else [] for text in texts]
        unseen = list(set().union(*cut).difference(self.known))
        if len(self.known) + len(unseen) > _PIECES_KEPT:
            unseen = list(set().union(*cut))
        self._learn(unseen)
        for text, pieces in zip(texts, cut):
            if not text:
                yield [], []
                continue
            parts_a, parts_b, whole = zip(*map(self.known.__getitem__, pieces))
            a, b = list(chain.from_iterable(parts_a)), list(chain.from_iterable(parts_b))
            yield (a, b) if all(whole) or self._whole(text, a, b) else ([], [])


@lru_cache(maxsize=2)
def _encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


def run_batches(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Batches of (row, doc_id, text) to those of ``_SCHEMA``."""
    both = _encoders(path_a, path_b)
    len_a, len_b = both.len_a, both.len_b
    for batch in batches:
        for low in range(0, len(batch), _DOCS_AT_ONCE):
            part = batch.slice(low, _DOCS_AT_ONCE)
            texts = [text or "" for text in part.column(2).to_pylist()]
            sizes, hashes, ends, pairs, times = [], [], [0], [], []
            for a, b in both.of_texts(texts):
                if not a:
                    sizes.append((0, 0, 0, 0))
                    hashes.append("")
                else:
                    ends_a, ends_b = list(accumulate(map(len_a.__getitem__, a))), list(accumulate(map(len_b.__getitem__, b)))
                    links, groups = links_and_groups(a, b, ends_a, ends_b, both.show, both.show_pair)
                    sizes.append((len(a), len(b), len(groups), len(links)))
                    hashes.append(hashlib.sha256(";".join(groups).encode()).hexdigest())
                    counted = Counter(links)
                    pairs += counted.keys()
                    times += counted.values()
                ends.append(len(pairs))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in zip(*sizes)], pa.array(hashes),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )
        give_back()


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each row of ``docs``: sizes, the groups' hash, and its id pairs with how often each occurs."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Millions of lists and no cycle among them: the collector would only go through them again and again.
        gc.disable()
        try:
            yield from run_batches(batches, path_a, path_b)
        finally:
            gc.enable()

    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, _SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n``: in how many documents it is linked, ``best``: whether no pair of the same first id has more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    first = F.shiftright("pair", _SHIFT)
    # A first id has at most as many pairs as the second vocabulary has ids.
    highest = F.max("n").over(W.partitionBy(first))
    return counts.select("pair", "n", (F.col("n") == highest).alias("best"))


def _frequent_from(counts: DataFrame, rows: int) -> int:
    """The least power of two that at most ``rows`` pairs reach."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    total, found = 0, 64
    for power, pairs in sorted(((r["power"], r["count"]) for r in by_size), reverse=True):
        total += pairs
        if total > rows:
            break
        found = power
    return 1 << min(found, 62)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, frequent: int = BROADCAST_ROWS) -> DataFrame:
    """How the tokens of two tokenizers overlap, for each row of ``docs``.

    The first is a byte-level tokenizer of the tokenizers library, given a space before the text; the second
    a sentencepiece model, which adds that space itself. Columns: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``
    (between bytes where tokens of both end), ``n_links`` (pairs of tokens whose bytes overlap), ``n_best`` (links
    whose pair is counted most among those of its first id, ties included), ``count_sum`` (of the pairs' counts
    over the links), ``groups_sha256``. A pair's count is the number of rows of ``docs`` that hold it.

    A null or empty text, or one whose bytes don't come back from its tokens, has no tokens: zeros, an
    empty hash, no part in the counts. Repeated rows and rows without ``doc_id`` count like others. Texts
    are whole, of any length; other columns are not read. ``frequent`` bounds the broadcast pairs.
    """
    aligned = stored(aligned_documents(docs, path_a, path_b), "aligned")
    counts = stored(pair_counts(aligned), "counts")
    least = _frequent_from(counts, frequent)
    common, rare = counts.filter(F.col("n") >= least), counts.filter(F.col("n") < least)
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("held")).select("row", "held.pairs", "held.times").withColumnRenamed("pairs", "pair")
    share = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    # The pairs of a document lie together, so that summing before the shuffle leaves a row for each.
    sums = held.join(F.broadcast(common), "pair").groupBy("row").agg(*share)
    if least > 1:
        left = held.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        others = left.join(rare, "pair").groupBy("row").agg(*share)
        sums = sums.unionByName(others).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    out = aligned.drop("pairs", "times").join(sums, "row", "left")
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256")
