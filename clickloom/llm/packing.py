"""Packing of token sequences into as few bins as possible: hierarchical residual best-fit.

Items are dealt out evenly and mixed in size, as many to a task as their number says, so that bins hardly
depend on how the input is partitioned. Each task packs what it has best-fit, largest first. Bins that are nearly full are final; the
others go on as items of the next round, where they are dealt out anew to fewer tasks and packed
best-fit once more, until a round no longer saves anything. A bin carries its members along, so no
join brings them back together, and the data of a round is what the round before left underfull.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import stored
from clickloom.llm.texts import Memo, slices, utf8
from clickloom.session import scratch_path, ship_package

# Items that one task packs at a time in the first round, and bins that one task of a later round gets.
ITEMS_PER_TASK = 20_000
# A round is worth while if it saves this part of the bins it was given.
LEAST_SAVED = 0.005
# A word between ASCII marks. Apostrophes are left out, since some words begin with one.
_MARKS = r"([!-&(-/:-@\[-`{-~]*)"
_CORE = re.compile(_MARKS + r"(\w+)" + _MARKS + r"\Z").match
_CHUNKS_KEPT, _WORDS_KEPT = 350_000, 500_000
# Bytes of text that are encoded at a time; a longer text is encoded alone.
_BYTES_AT_ONCE = 4 << 20
_PROBES = ["a", "It's", "don't,", "x=1;", "\u00c9t\u00e9", "42"]


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the members of each bin, as positions in ``sizes``.

    Open bins stand in stacks by free space; the bits of one integer say which stacks hold some.
    """
    bins: list[list[int]] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = stacks[free].pop()
            if not stacks[free]:
                open_bits &= ~(1 << free)
            bins[chosen].append(item)
        else:
            free, chosen = capacity, len(bins)
            bins.append([item])
        left = free - size
        if left:
            stacks[left].append(chosen)
            open_bits |= 1 << left
    return bins


def pack_best_fit(items: DataFrame, length: str = "length", capacity: int = 4096, slack: int = 4, fan_in: int = 8) -> DataFrame:
    """The rows of ``items`` with ``sequence_id`` and ``offset``, packed into bins of ``capacity``.

    Every row has a place, repeated rows each their own; members of a bin lie gapless from offset 0.
    A null ``length``, or one outside 1 to ``capacity``, raises. ``items`` may have no rows; its own
    columns named ``sequence_id`` or ``offset`` are replaced. A bin with at most ``slack`` free places
    is final at once. Rounds end when there is one group left or one saves under ``LEAST_SAVED`` of
    its bins, so no task ever gets more than ``ITEMS_PER_TASK`` bins, whatever the sizes are.
    """
    spark = items.sparkSession
    ship_package(spark)
    # Written before it is dealt out, so that its rows are made once and counted.
    items = stored(items.drop("sequence_id", "offset"), "items")
    payload = items.columns
    groups = max(1, -(-items.count() // ITEMS_PER_TASK))
    # Dealt out in turns, after a sort by hash within each partition: equal rows don't meet in one task.
    single = items.repartition(groups).select(
        F.col(length).cast("int").alias("fill"),
        F.array(F.struct(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("row"), F.lit(0).alias("offset"))).alias("members"),
    )
    kind = single.schema["members"].dataType.simpleString()
    schema = f"fill int, members {kind}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, ITEMS_PER_TASK - n)
                held.append(part)
                n += len(part)
                batch = batch.slice(len(part))
                if n == ITEMS_PER_TASK:
                    yield from packed(held)
                    held, n = [], 0
        if n:
            yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        fills = table.column("fill").to_numpy()
        if table.column("fill").null_count or fills.min() < 1 or fills.max() > capacity:
            raise ValueError(f"lengths have to be from 1 to {capacity}")
        fills = fills.astype(np.int64)
        members = table.column("members").chunk(0)
        inner = members.flatten()
        bounds = members.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        bins = best_fit(fills, capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64, len(fills))
        per_bin = np.array([len(b) for b in bins])
        first = np.concatenate([[0], np.cumsum(per_bin)[:-1]])
        # Where each item lies in its bin, and so how far its members move.
        before = np.cumsum(fills[order]) - fills[order]
        shift = before - np.repeat(before[first], per_bin)
        counts = np.diff(bounds)[order]
        total = int(counts.sum())
        taken = np.repeat(bounds[:-1][order] - np.cumsum(counts) + counts, counts) + np.arange(total)
        moved = inner.take(pa.array(taken))
        offsets = moved.field("offset").to_numpy(zero_copy_only=False) + np.repeat(shift, counts)
        rows = pa.StructArray.from_arrays([moved.field("row"), pa.array(offsets.astype(np.int32))], ["row", "offset"])
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(counts, first))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.add.reduceat(fills[order], first).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), rows)],
            ["fill", "members"],
        )

    done: list[DataFrame] = []
    bins, last, given = single, False, None
    while True:
        path = scratch_path(spark, "bins")
        # Written before it is read on: a lost executor must not deal or number bins anew.
        bins.mapInArrow(pack, schema).withColumn("final", F.col("fill") >= capacity - slack).write.parquet(path)
        table = spark.read.parquet(path)
        tallies = {row["final"]: row for row in table.groupBy("final").agg(F.count("*").alias("bins")).collect()}
        open_bins = tallies[False]["bins"] if False in tallies else 0
        made = sum(row["bins"] for row in tallies.values())
        groups = -(-open_bins // ITEMS_PER_TASK)
        if last or open_bins <= 1 or (given is not None and given - made < LEAST_SAVED * given):
            done.append(table)
            break
        done.append(table.filter("final"))
        last, given = groups == 1, open_bins
        rest = table.filter("not final").select("fill", "members")
        if groups == 1:
            bins = rest.coalesce(1)
        else:
            # Dealt out by a hash, so that each task gets every size; fan_in shrinks the number of tasks.
            groups = max(groups, -(-table.rdd.getNumPartitions() // fan_in))
            bins = rest.repartition(groups, F.xxhash64("members"))
    numbered = None
    for level, table in enumerate(done):
        part = table.select((F.monotonically_increasing_id() + F.lit(level << 58)).alias("sequence_id"), "members")
        numbered = part if numbered is None else numbered.unionByName(part)
    member = F.explode("members").alias("member")
    placed = numbered.select("sequence_id", member)
    return placed.select(*[F.col(f"member.row.`{c}`").alias(c) for c in payload], "sequence_id", F.col("member.offset").alias("offset"))


@lru_cache(maxsize=2)
def id_encoder(path: str):
    """A function from many texts to the bytes of their ids (little-endian unsigned 32-bit)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ends = np.zeros(library.get_vocab_size() + 1, bool)
    ends[[i for token, i in library.get_vocab().items() if token.endswith("</w>")]] = True

    def ids(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    def apart(gap: str) -> bool:
        return all(np.array_equal(ids(a + gap + b), np.concatenate([ids(a), ids(b)])) for a in _PROBES for b in _PROBES)

    # Other vocabularies may have tokens across white space: the library then gets whole texts.
    if getattr(library.model, "end_of_word_suffix", None) != "</w>" or not (apart(" ") and apart(" \n")):
        return lambda texts: (ids(text).tobytes() for text in (texts.to_pylist() if isinstance(texts, pa.Array) else texts))

    special = [token.content for token in library.get_added_tokens_decoder().values()]
    words: dict[str, bytes] = {}

    def core(chunk: str):
        """The word of letters in a chunk and the marks before and after it, if that is all it has."""
        if chunk.isalpha():
            return "", chunk.lower() if chunk.isascii() else chunk, ""
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return "", chunk[:-1].lower() if chunk.isascii() else chunk[:-1], chunk[-1]
        for token in special:
            if token in chunk:
                return None
        found = _CORE(chunk.lower() if chunk.isascii() else chunk)
        return found.groups() if found and found[2].isalpha() else None

    def learn(missing: list[str]) -> None:
        """Encode words of letters, many in one call: each of them ends with an end-of-word token."""
        if len(words) + len(missing) > _WORDS_KEPT:
            words.clear()
        for k in range(0, len(missing), 2000):
            part = missing[k : k + 2000]
            together = ids(" ".join(part))
            cuts = np.flatnonzero(ends[together]) + 1
            if len(cuts) != len(part):  # some letter's lower case isn't a letter
                words.update((word, ids(word).tobytes()) for word in part)
                continue
            data, start = together.tobytes(), 0
            for word, cut in zip(part, (cuts * 4).tolist()):
                words[word] = data[start:cut]
                start = cut

    def put_together(chunk: str, found: tuple[str, str, str] | None) -> bytes:
        if not found:
            return ids(chunk).tobytes()
        head, word, tail = found
        if word not in words:
            learn([word])
        data = words[word]
        if head:
            data = marks[head] + data
        return data + marks[tail] if tail else data

    marks = Memo(lambda mark: ids(mark).tobytes(), 10_000)
    chunks: dict[str, bytes] = {}

    def encode(texts: pa.Array | list[str]) -> Iterator[bytes]:
        # White space never lies within a token, so that a text's ids are those of its chunks in order.
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(chunks.get, names))
        parts = {k: core(names[k]) for k, data in enumerate(found) if data is None}
        learn(list({part[1] for part in parts.values() if part}.difference(words)))
        for k, part in parts.items():
            found[k] = put_together(names[k], part)
        if len(chunks) + len(parts) > _CHUNKS_KEPT:
            chunks.clear()
            chunks.update(zip(names[:_CHUNKS_KEPT], found))
        else:
            chunks.update((names[k], found[k]) for k in parts)
        data = pa.array(found, pa.large_binary()).take(coded.indices)
        held, ends_at = data.buffers()[2], np.frombuffer(data.buffers()[1], np.int64)
        bounds = ends_at[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        everything = memoryview(held) if held is not None else memoryview(b"")
        return (bytes(everything[low:high]) for low, high in zip(bounds[:-1], bounds[1:]))

    return encode


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Columns ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (bytes of little-endian 32-bit ids).

    A document's sequence is the ids of its whole text as the library of ``path`` gives them without
    added special tokens, then ``end_id``. Only sequences longer than ``capacity`` are cut, into pieces of
    ``capacity``; the last may be shorter. A null or empty text is ``end_id`` alone. Repeated rows give
    repeated pieces; a null ``doc_id`` stays null; other columns are not read.
    """
    ship_package(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_encoder(path)
        for batch in batches:
            for low, high in slices(utf8(batch.column(1))[1], _BYTES_AT_ONCE):
                part = batch.slice(low, high - low)
                rows, starts, numbers, pieces = [], [], [], []
                for row, data in enumerate(encode(part.column(1).fill_null(""))):
                    data += end
                    for number, start in enumerate(range(0, len(data), 4 * capacity)):
                        rows.append(row)
                        numbers.append(number)
                        starts.append(start // 4)
                        pieces.append(data[start : start + 4 * capacity])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array([len(p) // 4 for p in pieces], pa.int64()), pa.array(pieces, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(cut, schema)


def sequence_ids(packed: DataFrame, ids: str | Column = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and the ids of its members in order, as bytes.

    ``packed`` comes from ``pack_best_fit`` over pieces that still carry their ids.
    """
    members = F.array_sort(F.collect_list(F.struct("offset", F.col(ids) if isinstance(ids, str) else ids)))
    joined = packed.groupBy("sequence_id").agg(members.alias("members"))
    data = F.aggregate("members", F.lit(b""), lambda all_ids, m: F.concat(all_ids, m[ids]))
    return joined.select("sequence_id", data.alias("ids"))
