"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

    run(spark, sf_dir)    # one row per packed piece
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import line_dedup, near_dedup, packing, quality, substring_dedup
from clickloom.session import scratch_path

CAPACITY = 4096


def _text_changed(docs: DataFrame, change: Callable[[DataFrame], DataFrame], made: tuple[str, ...]) -> DataFrame:
    """``docs`` with the texts that ``change`` gives, the number of characters as it is then.

    ``change`` adds the columns ``made``. Columns of ``docs`` with such names are its own and stay as they are.
    """
    aside = {c: f"__own_{k}" for k, c in enumerate(docs.columns) if c.lower() in made}
    changed = change(docs.withColumnsRenamed(aside))
    n_chars = F.length("text").cast("long").alias("n_chars")
    return changed.select(*[n_chars if c == "n_chars" else F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; those it rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def delete_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs."""
    return _text_changed(docs, line_dedup.delete_repeated_lines, ("n_lines", "n_removed"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words to a shingle, similarity 0.8 or more."""
    return near_dedup.keep_one_of_each(docs, words=5, threshold=80)


def delete_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that an earlier one has."""
    return _text_changed(docs, partial(substring_dedup.delete_repeats, window=50), ("n_words", "n_removed"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in packed sequences."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=CAPACITY)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack_best_fit(pieces, "length", CAPACITY)
    return packed.withColumn("offset", F.col("offset").cast("long"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", delete_lines),
    ("MinHash near-dedup", keep_one_copy),
    ("substring dedup", delete_passages),
    ("best-fit packing", pack),
]

# The classifier's sums and the tokenizer aren't SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, name.replace(" ", "-"))
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
