"""Language of whole texts: nearest of several clustered TF-IDF centroids per language, by cosine.

Features are hashed character n-grams (one to three characters of the lower-case text, everything
but letters as one space). Document frequencies come from all training rows, the centroids from a
bounded sample of each language. A text far from all centroids can be rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.texts import mix
from clickloom.session import ship_package

UNKNOWN = "und"
BUCKETS = 1 << 13
_CHARACTERS = 1 << 18
_SPREAD = 1 << 20
# Values of ``lang``, four centroids each: 130 MB of centroids at most.
MOST_LANGUAGES = 500


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams and their counts; both empty if there is no letter."""
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    total = np.zeros(buckets, np.int64)
    found = False
    carried = np.array([32], np.uint64)  # the last characters, for the n-grams across two parts
    for low in range(0, len(text), _CHARACTERS):
        codes = np.frombuffer(text[low : low + _CHARACTERS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        found |= bool(letter.any())
        codes = np.where(letter, codes, 32).astype(np.uint64)
        codes = np.concatenate([carried, codes, [np.uint64(32)]] if low + _CHARACTERS >= len(text) else [carried, codes])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        grams = codes
        for n in (1, 2, 3):
            if n > 1:
                grams = grams[:-1] << np.uint64(21) | codes[n - 1 :]
            # An n-gram within what was carried has been counted with the part before.
            new = grams[max(0, len(carried) - n + 1) :] if low else grams
            total += np.bincount((mix(new * np.uint64(4) + np.uint64(n)) % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        carried = codes[-2:]
    if not found:
        return np.empty(0, np.int64), np.empty(0)
    at = np.flatnonzero(total)
    return at, total[at].astype(np.float64)


@dataclass(frozen=True)
class LanguageModel:
    """Centroids as columns of ``weights`` (bucket x centroid), the language of each, and the IDF."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray

    def nearest(self, text: str | None) -> tuple[str | None, float]:
        """The language of the centroid of the highest cosine, ties to the first by name."""
        at, counts = gram_counts(text, len(self.idf))
        if not len(at) or not self.languages:
            return None, 0.0
        values = _values(counts, self.idf[at])
        scores = values @ self.weights[at]
        best = int(np.argmax(np.round(scores, 12)))
        return self.languages[best], float(min(max(scores[best], 0.0), 1.0))


def _values(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf
    return values / np.linalg.norm(values)


def _centroids(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; the start is the first vector, then each time the one farthest from all."""
    chosen = [vectors.mean(axis=0)]
    chosen[0] = vectors[np.argmax(vectors @ chosen[0])]
    nearest = vectors @ chosen[0]
    for _ in range(1, min(clusters, len(vectors))):
        chosen.append(vectors[np.argmin(nearest)])
        nearest = np.maximum(nearest, vectors @ chosen[-1])
    centers = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, axis=1)
        sums = np.array([vectors[own == k].sum(axis=0) for k in range(len(centers))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centers)
    return centers


def fit(training: DataFrame, clusters: int = 4, sample_per_language: int = 800, buckets: int = BUCKETS) -> LanguageModel:
    """A model from the columns ``text`` and ``lang``; rows where either is null or has no letter don't count.

    Document frequencies cover every row. Centroids are fitted to ``sample_per_language`` rows (at most
    1000) of each language with different texts, those of the smallest text hash, so that the fit is the
    same at any partitioning; a language of few texts has all of them, however often they are repeated. Without rows
    the model knows no language. The model is held by every task: more than ``MOST_LANGUAGES`` values of
    ``lang`` raise.
    """
    spark = training.sparkSession
    ship_package(spark)
    rows = training.select("text", "lang").filter("text is not null and lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                at, _ = gram_counts(text.as_py(), buckets)
                total[at] += 1
                n += len(at) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["bucket", "n"])

    # One row for each bucket, however many rows there are.
    sums = rows.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n_docs = int(sums.loc[sums.bucket == -1, "n"].sum())
    counted = sums[sums.bucket >= 0]
    df = np.zeros(buckets)
    df[counted.bucket.to_numpy(np.int64)] = counted.n.to_numpy(np.float64)
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    # A share of each language's different texts that holds a few times the sample, then the smallest hashes of it.
    texts = rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("texts"))
    if (languages := texts.count()) > MOST_LANGUAGES:
        raise ValueError(f"{languages} values of lang; at most {MOST_LANGUAGES} can be told apart")
    place = F.pmod(F.xxhash64("text", "lang"), F.lit(_SPREAD))
    near = rows.join(F.broadcast(texts), "lang").filter(place * F.col("texts") < F.lit(4 * sample_per_language * _SPREAD)).select("lang", "text").distinct()
    first = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("text", "lang"), "text"))
    sample = near.select("lang", "text", first.alias("place")).filter(F.col("place") <= min(sample_per_language, 1000)).drop("place")

    def cluster(key: tuple, texts: pd.DataFrame) -> pd.DataFrame:
        vectors = []
        for text in texts["text"].sort_values():
            at, counts = gram_counts(text, buckets)
            if len(at):
                vectors.append(np.zeros(buckets, np.float32))
                vectors[-1][at] = _values(counts, idf[at])
        centers = _centroids(np.array(vectors), clusters) if vectors else []
        return pd.DataFrame({"lang": [key[0]] * len(centers), "center": [c.tolist() for c in centers]})

    fitted = sample.groupBy("lang").applyInPandas(cluster, "lang string, center array<double>").toPandas()
    fitted = fitted.sort_values("lang", kind="stable")
    weights = np.array(fitted["center"].tolist(), np.float64).reshape(len(fitted), -1).T if len(fitted) else np.zeros((buckets, 0))
    return LanguageModel(tuple(fitted["lang"]), idf, np.ascontiguousarray(weights))


def identify(docs: DataFrame, model: LanguageModel, least_cosine: float = 0.15) -> DataFrame:
    """Columns ``doc_id``, ``nearest``, ``score``, ``lang``; a row for each row of ``docs``.

    ``nearest`` is the language of the nearest centroid, ``score`` its cosine (0 to 1), and ``lang`` is
    ``nearest`` unless the cosine is below ``least_cosine``: then the text is rejected as ``und``. A text
    that is null or has no letter is ``und`` with score 0, as is any text if the model knows no
    language. Texts are taken whole; other columns are not read; a null ``doc_id`` stays null.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # buckets x centroids: the number of languages alone decides

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.nearest(text.as_py()) for text in batch.column(1)]
            nearest = [lang or UNKNOWN for lang, _ in found]
            scores = [score for _, score in found]
            lang = [name if score >= least_cosine else UNKNOWN for name, score in zip(nearest, scores)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest, pa.string()), pa.array(scores, pa.float64()), pa.array(lang, pa.string())], ["doc_id", "nearest", "score", "lang"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, nearest string, score double, lang string")


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is kept from training: the CRC-32 of its number as text is divisible by 5."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0
