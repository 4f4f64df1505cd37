"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A document's log weight is the mean, over its word and word-pair n-grams, of the log ratio of two
generative models: one of texts labelled good, one of all texts. The mean, since a sum would mostly
tell how long a text is. Documents are resampled without replacement in proportion to their weights,
sharpened by a temperature: the k largest of log weight plus Gumbel noise are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.texts import LOWER, SEPARATOR, give_back, mix, slices, span_hashes, utf8
from clickloom.session import scratch_path, ship_package

BUCKETS = 1 << 14
# What the fit takes of the labelled rows at most, those of the smallest id hash; a fifth
# of the good ones, and the bad ones, calibrate.
LABELLED_ROWS = 40_000
_REPEAT = np.uint64(0x5851F42D4C957F2D)

# Runs of one kind are a token: words (any byte of a letter or digit), marks, or nothing.
_KIND = np.where(SEPARATOR, 0, 2).astype(np.uint8)
_KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1


def gram_buckets(data: np.ndarray, bounds: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all rows' n-grams, row after row, and where each row's begin.

    A row of t tokens has t words and t - 1 pairs. A pair of equal tokens counts as one and the same
    n-gram, whatever the token is.
    """
    kind = _KIND[data]
    new = np.empty(len(kind) + 1, bool)
    new[0] = new[-1] = True
    new[1:-1] = kind[1:] != kind[:-1]
    new[bounds[:-1]] = True
    edges = np.flatnonzero(new)
    starts, ends = edges[:-1], edges[1:]
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    words = span_hashes(LOWER[data], starts, ends)
    first = np.searchsorted(starts, bounds)
    if not len(words):
        return np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    pairs = words * np.uint64(0x9E3779B97F4A7C15) + np.roll(words, -1) * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = np.where(words == np.roll(words, -1), _REPEAT, pairs)
    grams = np.empty(2 * len(words), np.uint64)
    grams[0::2], grams[1::2] = words, mix(pairs)
    keep = np.ones(len(grams), bool)
    last = first[1:][first[1:] > first[:-1]] - 1
    keep[2 * last + 1] = False  # no pair across two rows
    before = np.concatenate([[0], np.cumsum(keep)])
    return (grams[keep] % np.uint64(buckets)).astype(np.int64), before[2 * first]


@dataclass(frozen=True)
class QualityModel:
    """Log ratio of each bucket, and the log weight from which a document passes as good."""

    log_ratio: np.ndarray
    threshold: float = 0.0


def log_weight(model: QualityModel, text: Column | str) -> Column:
    """A document's log weight; 0 for a null, empty or blank text."""

    @F.arrow_udf("double")
    def weigh(column: pa.Array) -> pa.Array:
        data, bounds = utf8(column)
        out = []
        for low, high in slices(bounds):
            part = bounds[low : high + 1]
            grams, first = gram_buckets(data[part[0] : part[-1]], part - part[0], len(model.log_ratio))
            sums = np.concatenate([[0.0], np.cumsum(model.log_ratio[grams])])
            # Sums of whole units of 2**-30 are exact, so a text's weight doesn't depend on its batch.
            out.append((sums[first[1:]] - sums[first[:-1]]) / np.maximum(first[1:] - first[:-1], 1))
        weights = pa.array(np.concatenate(out) if out else np.empty(0))
        give_back()
        return weights

    return weigh(text)


def labelled_sample(labels: DataFrame, bound: int = LABELLED_ROWS) -> DataFrame:
    """At most ``bound`` rows ``__id``, ``__good``, ``__fit``: labels by smallest id hash, a fifth not to fit on.

    Rows with a null id or quality don't count; an id labelled twice counts as good if one label says so.
    """
    place = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(place, "doc_id").limit(bound)
    return chosen.select(F.col("doc_id").alias("__id"), (F.col("quality") > 0).alias("__good"), (F.pmod(place, F.lit(5)) != 0).alias("__fit"))


def _with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(F.broadcast(sample), F.col("doc_id") == F.col("__id"), "left")  # bounded by LABELLED_ROWS


def fit(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> QualityModel:
    """A model without threshold: raw counts over all rows of ``docs``, target counts over good labelled rows.

    Null texts don't count; without rows, or without good ones, every ratio is 0.
    """
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            data, bounds = utf8(batch.column(0))
            good = np.asarray(batch.column(1).fill_null(False).to_pylist(), bool)
            for low, high in slices(bounds):
                part = bounds[low : high + 1]
                grams, first = gram_buckets(data[part[0] : part[-1]], part - part[0], buckets)
                totals[0] += np.bincount(grams, minlength=buckets)
                chosen = np.repeat(good[low:high], np.diff(first))
                totals[1] += np.bincount(grams[chosen], minlength=buckets)
        give_back()
        at = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[0, at]), pa.array(totals[1, at])], ["bucket", "raw", "target"])

    rows = _with_labels(docs, sample).select("text", F.expr("__good and __fit").alias("good"))
    sums = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    if not target.sum():
        return QualityModel(np.zeros(buckets))
    ratio = np.log((target + 0.5) / (target.sum() + 0.5 * buckets)) - np.log((raw + 0.5) / (raw.sum() + 0.5 * buckets))
    return QualityModel(np.round(ratio * 2**30) / 2**30)


def best_threshold(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good and bad rows with the fewest errors, each kind as a share of its own;
    halfway between the neighbours, and the lower one of equals. Without bad rows nothing is below it."""
    if not len(weights) or good.all():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) / max(1, good.sum())
    passed = 1 - np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    errors = lost + passed
    errors[1:-1][weights[1:] == weights[:-1]] = 9
    cut = int(np.argmin(errors))
    padded = np.concatenate([[weights[0] - 1], weights, [weights[-1] + 1]])
    return float((padded[cut] + padded[cut + 1]) / 2)


def gumbel_key(log_weights: Column, row: Column, temperature: float, seed: int) -> Column:
    """Log weight plus Gumbel noise that the row's id and the seed decide; lower temperatures draw more sharply."""
    uniform = (F.shiftrightunsigned(F.xxhash64(row, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return log_weights - F.log(-F.log(uniform)) * F.lit(float(temperature))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, exactly: 16 bits of its ordered bit pattern at a time are counted.

    The driver gets 65,536 counts at most each time. Infinite for k < 1; minus infinity if there are
    fewer than k values. Nulls don't count.
    """
    if k < 1:
        return float("inf")
    bits = F.expr(f"cast(floor(`{column}` * 4294967296D) as long)")  # keys are told apart to 2**-32
    ordered = keys.filter(F.col(column).isNotNull()).select(bits.alias("v"))
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        at = ordered if prefix is None else ordered.filter(F.shiftright("v", shift + 16) == prefix)
        counts = at.groupBy(F.shiftright("v", shift).alias("digit")).agg(F.count("*").alias("n")).orderBy(F.desc("digit")).collect()
        prefix = None
        for row in counts:
            if row["n"] >= left:
                prefix = row["digit"]
                break
            left -= row["n"]
        if prefix is None:
            return float("-inf")
    return prefix / 4294967296


@dataclass(frozen=True)
class Resample:
    """A fitted resampling: the model, the noise, and the key from which a row is kept."""

    model: QualityModel
    temperature: float
    seed: int
    least_key: float

    def key(self, weight: Column, doc_id: Column) -> Column:
        return gumbel_key(weight, doc_id, self.temperature, self.seed)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, temperature: float = 0.005, seed: int = 7, bound: int = LABELLED_ROWS) -> tuple[Resample, DataFrame]:
    """The fitted resampling, and ``doc_id``, ``log_weight``, ``sample_key``, ``kept`` for each row of ``docs``.

    ``k`` documents are kept by Gumbel top-k. Without ``k``, it is the number of documents whose log weight
    reaches the threshold that parts good from bad labelled rows best, without the good ones that the
    model is fitted to. Equal keys (repeated rows) stand or fall together, so there
    may be as many more. Null and empty texts have log weight 0; a null ``doc_id`` stays null and has a
    key like any other; without bad labelled rows all rows are kept. Columns but ``doc_id`` and ``text``
    are not read. The weights are written to the shared folder once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "labelled")
    labelled_sample(labels, bound).write.parquet(path)
    sample = spark.read.parquet(path)
    model = fit(docs, sample)
    path = scratch_path(spark, "weights")
    weighted = _with_labels(docs, sample).select("doc_id", log_weight(model, "text").alias("log_weight"), "__good", "__fit")
    key = gumbel_key(F.col("log_weight"), F.col("doc_id"), temperature, seed)
    weighted.select("*", key.alias("sample_key")).write.parquet(path)
    stored = spark.read.parquet(path)
    if k is None:
        # Good rows that the model isn't fitted to, and bad ones, to none of which it is.
        held = stored.filter("__good is not null and not (__good and __fit)").select("log_weight", "__good").toPandas()
        model = QualityModel(model.log_ratio, best_threshold(held["log_weight"].to_numpy(float), held["__good"].to_numpy(bool)))
        k = stored.filter(F.col("log_weight") >= F.lit(model.threshold)).count()
    fitted = Resample(model, temperature, seed, kth_largest(stored, "sample_key", k))
    return fitted, stored.select("doc_id", "log_weight", "sample_key", (F.col("sample_key") >= F.lit(fitted.least_key)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that a resampling keeps, with all their columns."""
    fitted, _ = resample(docs, labels, **options)
    doc_id = F.col("doc_id").cast("long")
    return docs.filter(fitted.key(log_weight(fitted.model, "text"), doc_id) >= F.lit(fitted.least_key))
