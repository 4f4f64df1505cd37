"""Deletion of passages that occur in an earlier document, by automata of repeated phrases.

A window is a run of consecutive words. Every window has an anchor: the smallest hash among its
short word runs, so equal windows have equal anchors. Anchors of one document only can't lie in a
repeated window. Where an anchor recurs, the windows around it are compared by hash over the
cluster, which confirms the recurring passages and names the first document of each. The passages
of a first document are cut into phrases, each half a window, which go into an Aho-Corasick
automaton; every later document with such a passage is streamed through it, and each hit is extended
word by word as far as both texts agree. So what is deleted has been compared word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.storage import small, stored, tidied
from clickloom.llm.texts import give_back, mix, slices, span_hashes, utf8, window_hashes, word_spans
from clickloom.session import ship_package

WINDOW = 50
# Later documents that share an automaton of a first document in one group of a task.
DOCS_PER_GROUP = 128
_KEY = ["doc_id", "text_hash"]


def _word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    data, bounds = utf8(column)
    for low, high in slices(bounds):
        part = bounds[low : high + 1] - bounds[low]
        piece = data[bounds[low] : bounds[high]]
        starts, ends, first = word_spans(piece, part)
        hashes = span_hashes(piece, starts, ends)
        for row in range(high - low):
            yield hashes[first[row] : first[row + 1]]


def window_anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window: the smallest hash of its runs of a third of its length."""
    run = max(1, window // 3)
    least = window_hashes(words, run)
    # Minima over 1, 2, 4, ... runs, then over two overlapping stretches of them.
    need, width = window - run + 1, 1
    if len(least) < need:
        return np.empty(0, np.uint64)
    while width * 2 <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = need - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class PhraseAutomaton:
    """Finds where texts agree with passages of one document in at least ``window`` words."""

    def __init__(self, text: str, ranges: list[tuple[int, int]], window: int):
        """``ranges`` of window starts (from, to), both included, whose windows are looked for."""
        self.window = window
        words = text.encode().split()
        self.numbers: dict[bytes, int] = {}
        ids = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
        self.own = np.array(ids, np.int64)
        self.phrase = max(1, window // 2)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        places: dict[tuple, list[int]] = {}
        for start, last in ranges:
            # A window holds at least one whole phrase of those that follow each other in its passage.
            for at in range(start, last + window - self.phrase + 1, self.phrase):
                places.setdefault(tuple(ids[at : at + self.phrase]), []).append(at)
        for phrase, at in places.items():
            self.automaton.add_word(phrase, at)
        if places:
            self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Disjoint spans (from, to) of words of ``text`` that windows in common with the document cover."""
        if not len(self.automaton):
            return []
        numbers = [self.numbers.get(word, 0) for word in text.encode().split()]
        if len(numbers) < self.window:
            return []
        other, found, seen = np.array(numbers, np.int64), [], {}
        for end, places in self.automaton.iter(tuple(numbers)):
            begin = end - self.phrase + 1
            for at in places:
                shift = begin - at
                if seen.get(shift, -1) >= begin:
                    continue  # within what has been extended on this diagonal
                # Both texts laid side by side at this shift; 0 stands for a word the document lacks.
                right = self._agree(other[begin:], self.own[at:])
                left = self._agree(other[:begin][::-1], self.own[:at][::-1])
                seen[shift] = begin + right
                if left + right >= self.window:
                    found.append((begin - left, begin + right))
        return merged(found)

    @staticmethod
    def _agree(a: np.ndarray, b: np.ndarray) -> int:
        n, done, step = min(len(a), len(b)), 0, 64
        while done < n:
            differ = np.flatnonzero(a[done : min(done + step, n)] != b[done : min(done + step, n)])
            if len(differ):
                return done + int(differ[0])
            done, step = done + step, step * 2
        return n


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; what is left keeps its white space, stretches joined by a space."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    left, at = [], 0
    for start, end in [*spans, (len(starts), len(starts))]:
        if start > at:
            left.append(data[starts[at] : ends[start - 1]].tobytes())
        at = end
    return b" ".join(left).decode()


@tidied
def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Columns ``doc_id``, ``text_hash``, ``spans``: disjoint word spans (from, to) that earlier documents have.

    A row for each document that has some, by id and ``xxhash64`` of its text. See ``delete_repeats``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, anchors = [], [], [], []
            for words in _word_hashes(batch.column(2)):
                sizes.append(len(words))
                whole = len(words) >= window
                one.append(window_hashes(words, len(words))[0] if whole else np.uint64(0))
                two.append(window_hashes(mix(words + np.uint64(5)), len(words))[0] if whole else np.uint64(0))
                anchors.append(np.unique(window_anchors(words, window)).view(np.int64))
            bounds = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(anchors) if anchors else np.empty(0, np.int64)))],
                [*_KEY, "n_words", "seq1", "seq2", "anchors"],
            )
            give_back()

    sketches = texts.mapInArrow(sketch, "doc_id long, text_hash long, n_words int, seq1 long, seq2 long, anchors array<long>")
    sketches = stored(sketches.filter(F.col("n_words") >= window), "sketches")
    # Of documents with the same words the first stands for all; the others go as a whole.
    whole = ["seq1", "seq2", "n_words"]
    firsts = stored(sketches.groupBy(*whole).agg(F.min("doc_id").alias("first")), "firsts")
    placed = sketches.join(firsts, whole)
    copies = placed.filter("doc_id > first").select(*_KEY, F.array(F.struct(F.lit(0).alias("from"), F.col("n_words").alias("to"))).alias("spans"))
    anchors = placed.filter("doc_id = first").select(*_KEY, F.explode("anchors").alias("anchor"))
    recurring = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("anchor")
    lists = stored(anchors.join(recurring, "anchor").groupBy(*_KEY).agg(F.collect_set("anchor").alias("anchors")), "anchors")
    candidates = stored(texts.join(small(lists.select(*_KEY)), _KEY, "left_semi").join(lists, _KEY), "candidates")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in enumerate(_word_hashes(batch.column(2))):
                wanted = batch.column(3)[row].values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(window_anchors(words, window), wanted))
                one = window_hashes(words, window)[at].view(np.int64)
                two = window_hashes(mix(words + np.uint64(5)), window)[at].view(np.int64)
                keys = [pa.array(np.full(len(at), batch.column(c)[row].as_py())) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(at.astype(np.int32)), pa.array(one), pa.array(two)], [*_KEY, "pos", "one", "two"])

    shown = candidates.mapInArrow(windows, "doc_id long, text_hash long, pos int, one long, two long")
    shown = stored(shown, "windows")
    place = F.struct(*_KEY, "pos")
    confirmed = shown.groupBy("one", "two").agg(F.min(place).alias("first"), F.max("doc_id").alias("last")).filter("first.doc_id < last")
    confirmed = stored(confirmed.select("one", "two", F.col("first.doc_id").alias("source"), F.col("first.text_hash").alias("source_hash"), F.col("first.pos").alias("at")), "confirmed")
    pairs = shown.join(confirmed.select("one", "two", "source", "source_hash"), ["one", "two"]).filter("doc_id > source").select(*_KEY, "source", "source_hash").distinct()
    pairs = stored(pairs, "pairs")
    # Window starts of each first document that recur, as ranges.
    along = W.partitionBy("source", "source_hash").orderBy("at")
    ranges = confirmed.select("source", "source_hash", "at", (F.col("at") - F.row_number().over(along)).alias("stretch"))
    ranges = ranges.groupBy("source", "source_hash", "stretch").agg(F.min("at").alias("from"), F.max("at").alias("to"))
    ranges = ranges.groupBy("source", "source_hash").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    # Each first document's automaton serves groups of later documents, so that a frequent passage is many groups.
    later = pairs.join(candidates.select(*_KEY, "text"), _KEY)
    groups = pairs.groupBy("source", "source_hash").agg(F.ceil(F.count("*") / DOCS_PER_GROUP).cast("int").alias("n_groups"))
    groups = stored(groups, "groups")
    later = later.join(groups, ["source", "source_hash"]).select(
        "source", "source_hash", F.pmod(F.xxhash64(*_KEY), F.col("n_groups")).cast("int").alias("part"), F.lit(1).alias("kind"), *_KEY, "text",
        F.array().cast("array<struct<from:int,to:int>>").alias("ranges"),
    )
    named = candidates.select(F.col("doc_id").alias("source"), F.col("text_hash").alias("source_hash"), "text")
    sources = groups.join(named, ["source", "source_hash"]).join(ranges, ["source", "source_hash"]).select(
        "source", "source_hash", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)).alias("part"), F.lit(0).alias("kind"),
        F.col("source").alias("doc_id"), F.col("source_hash").alias("text_hash"), "text", "ranges",
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for batch in batches:
            keys, spans = [], []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    automaton = PhraseAutomaton(row["text"], [(r["from"], r["to"]) for r in row["ranges"]], window)
                    continue
                found = automaton.spans(row["text"])
                if found:
                    keys.append((row["doc_id"], row["text_hash"]))
                    spans.append([{"from": a, "to": b} for a, b in found])
            kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in keys], pa.int64()) for c in (0, 1)] + [pa.array(spans, kind)], [*_KEY, "spans"])

    kind = "array<struct<from:int,to:int>>"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sources.unionByName(later).repartition(parts, "source", "source_hash", "part").sortWithinPartitions("source", "source_hash", "part", "kind")
    found = dealt.mapInArrow(locate, f"doc_id long, text_hash long, spans {kind}").unionByName(copies)
    gathered = found.groupBy(*_KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"from": a, "to": b} for a, b in merged([(s["from"], s["to"]) for s in spans])] for spans in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, batch.column(2).type)], [*_KEY, "spans"])

    return stored(gathered.mapInArrow(unite, f"doc_id long, text_hash long, spans {kind}"), "spans", lasting=True)


def delete_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without repeated passages, and ``n_words``, ``n_removed``.

    A word goes if it is covered by a window (``window`` consecutive words, as they are) whose words also
    follow each other in a document with a smaller ``doc_id``; windows are judged on the input. What is
    left keeps its white space; a text without such windows isn't changed. Words are runs of bytes
    other than space and \\x09 to \\x0D. A null text stays null, with no words; a row without ``doc_id`` is
    neither source nor cut; rows of one ``doc_id`` don't cut each other. Texts are read whole. Columns
    named ``n_words`` and ``n_removed`` are replaced.
    """
    docs = docs.drop("n_words", "n_removed")
    spans = repeated_spans(docs, window).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    joined = docs.join(small(spans, "__spans"), (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left")

    @F.arrow_udf("string")
    def cut(text: pa.Array, found: pa.Array) -> pa.Array:
        pairs = zip(text.to_pylist(), found.to_pylist())
        return pa.array([t if not s else without(t, [(x["from"], x["to"]) for x in s]) for t, s in pairs], pa.string())

    n_words = F.coalesce(words_of(F.col("text")), F.lit(0))
    removed = F.coalesce(F.aggregate("__spans", F.lit(0), lambda n, s: n + s["to"] - s["from"]), F.lit(0))
    kept = joined.withColumn("n_words", n_words.cast("long")).withColumn("n_removed", removed.cast("long"))
    # Only rows with spans go to Python.
    changed = kept.filter("__spans is not null").withColumn("text", cut("text", "__spans"))
    columns = [*[F.col(f"`{c}`") for c in docs.columns], "n_words", "n_removed"]
    return kept.filter("__spans is null").select(*columns).unionByName(changed.select(*columns))


def plain(text):
    """A text's words joined by one space."""
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def words_of(text):
    """The number of words of a text; null for null."""
    joined = plain(text)
    return F.when(joined == "", 0).otherwise(F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit(""))) + 1)
