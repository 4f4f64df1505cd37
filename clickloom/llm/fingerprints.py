"""Order MinHash fingerprints of documents: sensitive to the order of text, and so to edit distance.

A text's k-mers are numbered by occurrence, so that repeats differ. For each of ``size`` hash
functions the ``picked`` k-mers of the smallest hashes are taken and put back in text order; the
hash of that tuple is a component. Two texts agree in a component about as likely as they share
those k-mers in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.texts import mix, window_hashes
from clickloom.session import ship_package

SIZE, PICKED, K = 64, 2, 8
_BLOCK = 4096
_NONE = np.uint32(0xFFFFFFFF)


def _seeds(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = mix(np.arange(1, 2 * size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (base[:size] >> np.uint64(32)).astype(np.uint32)[:, None], (base[size:] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def numbered_kmers(text: str, k: int) -> np.ndarray:
    """A 64-bit hash of each k-mer with its occurrence number; a shorter text is one k-mer, an empty one none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return codes
    grams = window_hashes(codes, min(k, len(codes)))
    n = len(grams)
    # Sorted by hash and place in one number; what is left of the hash still tells a text's k-mers apart.
    bits = np.uint64(n.bit_length())
    keys = np.sort(grams >> bits << bits | np.arange(n, dtype=np.uint64))
    place = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], (keys[1:] >> bits) != (keys[:-1] >> bits)]))
    occurrence = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
    numbers = np.empty(n, np.uint64)
    numbers[place] = occurrence.astype(np.uint64)
    return mix(grams + numbers * np.uint64(0xD6E8FEB86659FD93))


class OrderMinHash:
    """Signatures of texts, as arrays of 32-bit components."""

    def __init__(self, size: int = SIZE, picked: int = PICKED, k: int = K):
        self.picked, self.k = picked, k
        self.flip, self.factor = _seeds(size)

    def __call__(self, text: str) -> np.ndarray:
        hashes = numbered_kmers(text, self.k)
        size = len(self.flip)
        if not len(hashes):
            return np.zeros(size, np.uint32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        rows = np.arange(size)
        values, places = [], []
        for low in range(0, len(short), _BLOCK):
            scores = (short[None, low : low + _BLOCK] ^ self.flip) * self.factor
            for _ in range(min(self.picked, scores.shape[1])):
                at = scores.argmin(axis=1)
                values.append(scores[rows, at].astype(np.uint64) << np.uint64(32) | (at + low).astype(np.uint64))
                places.append(at + low)
                scores[rows, at] = _NONE
        if len(values) > self.picked:
            # Smallest first, ties to the earlier place; values hold both.
            order = np.argsort(np.array(values), axis=0, kind="stable")[: self.picked]
            chosen = np.take_along_axis(np.array(places), order, axis=0)
        else:
            chosen = np.array(places)
        chosen.sort(axis=0)
        total = np.zeros(size, np.uint64)
        for line in chosen:
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[line])
        return (total >> np.uint64(32)).astype(np.uint32)

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """From 0 to 1: the share of equal components, which falls with the power ``picked`` of the share
        of k-mers in common, taken back to that share."""
        return float(np.mean(a == b) ** (1 / self.picked))


def hexadecimal(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, **options: int) -> DataFrame:
    """Columns ``doc_id``, ``n_chars`` (code points), ``fingerprint`` (hex); a row for each row of ``docs``.

    A null text counts as empty; empty texts all have the same fingerprint. Texts are read whole, and
    equal texts have equal fingerprints. A null ``doc_id`` stays null; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = OrderMinHash(**options)
        for batch in batches:
            texts = [text.as_py() or "" for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(hexadecimal(sketch(t)) for t in texts)], ["doc_id", "n_chars", "fingerprint"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


PAIR_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [part.split()[0] for part in PAIR_SCHEMA.split(", ")]


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by as much of the start of the one that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, **options: int) -> DataFrame:
    """Each document against its edited text and against the next document by descending ``doc_id``.

    The last document's next is the first. A null text counts as empty. Rows of one id follow each
    other in the order of their texts' hashes. Rows without id have no place in the order: their
    edited text and what is compared is null. Other columns are not read.

    The documents are sorted over the cluster once; a task holds two texts at a time. What the last
    row of a partition is compared with begins another one, so the first and last texts of all
    partitions are joined: as many rows as there are partitions.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.bitwise_not("doc_id"), F.xxhash64("text")]
    dealt = rows.filter("doc_id is not null").repartitionByRange(n, *order)

    def record(sketch: OrderMinHash, doc_id: int, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
        changed = edited(text, following)
        edit = sketch(changed)
        return (doc_id, len(text), sha256(changed.encode()).hexdigest(), hexadecimal(own), hexadecimal(edit), sketch.likeness(own, edit), sketch.likeness(own, other))

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, held = OrderMinHash(**options), None
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                new = (doc_id.as_py(), text.as_py())
                new = (*new, sketch(new[1]))
                if held:
                    out.append(record(sketch, *held, *new[1:]))
                held = new
            yield _batch(out)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = OrderMinHash(**options)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "tail", "head"))
            yield _batch([record(sketch, doc_id, tail, sketch(tail), head, sketch(head)) for doc_id, tail, head in zip(*columns)])

    # The first and the last row of each partition, and its number; numbers alone go through one task.
    parts = dealt.withColumn("part", F.spark_partition_id())
    tails = parts.groupBy("part").agg(F.max_by(F.struct("doc_id", "text"), F.struct(*order)).alias("last"))
    heads = parts.groupBy(F.col("part").alias("next")).agg(F.min_by("text", F.struct(*order)).alias("head"))
    numbers = parts.groupBy("part").agg(F.count("*").alias("n"))
    following = numbers.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy())).alias("next"))
    closed = tails.join(following, "part").join(heads, "next").select("last.doc_id", F.col("last.text").alias("tail"), "head")
    unplaced = fingerprints(rows.filter("doc_id is null"), **options)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("edited_sha256", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))]
    return (
        dealt.sortWithinPartitions(*order).mapInArrow(inner, PAIR_SCHEMA)
        .unionByName(closed.mapInArrow(outer, PAIR_SCHEMA))
        .unionByName(unplaced.select("*", *empty))
    )


def _batch(records: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    columns = zip(*records) if records else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[part.split()[1]]) for c, part in zip(columns, PAIR_SCHEMA.split(", "))], _NAMES)
