"""Deletion of repeated line runs: a suffix array over line ids by prefix doubling, on DataFrames alone.

Each line stands for a suffix of its document. Suffixes are ranked by their first line, then by
their first 2, 4, 8, ... lines: the rank of the first 2n lines is the rank of the pair of ranks of n
lines at the suffix and n lines further. Suffixes of one rank are an interval of the suffix array
whose common prefix is that long. A suffix alone in its interval repeats nothing and is settled, so
each round has only what still repeats, and the rounds end with the longest repeated run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.storage import small, stored, tidied

LEAST_CHARS = 30
_PLACE = ["doc", "text_hash", "pos"]
_DOC = ["doc", "text_hash"]


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents by their place in the order: by id, those without id last, then by the text's hash."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(others.alias("row"), doc.alias("doc"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("own_text"))


def _ranked(suffixes: DataFrame, by: list[str]) -> DataFrame:
    """The suffixes that share their rank with others: ``rank`` follows the order of ``by``, ``later`` says
    whether an earlier suffix has the same rank."""
    place = F.struct(*_PLACE)
    classes = suffixes.groupBy(*by).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    shared = classes.filter(F.col("first") != F.col("last")).drop("last")
    # The number of a row in a sorted table grows with its place.
    numbered = shared.orderBy(*by).withColumn("rank_of", F.monotonically_increasing_id())
    joined = suffixes.join(numbered, by)
    return joined.select(*_PLACE, F.col("rank_of").alias("rank"), (place != F.col("first")).alias("later"), "chars")


@tidied
def repeated_runs(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Lines to delete, as ``runs`` (disjoint ``[from, to)`` in order) for each document that has some.

    Keys are ``doc`` and ``text_hash``. See ``delete_repeated_lines`` for the rule.
    """
    keyed = _keyed(docs).filter("own_text is not null")
    line = F.posexplode(_lines("own_text")).alias("pos", "line")
    lines = keyed.select(*_DOC, line).select(
        *_PLACE, F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2"), F.length("line").alias("chars")
    )
    level = stored(_ranked(stored(lines, "lines"), ["id", "id2"]), "suffixes")
    size, found = 1, []
    along = W.partitionBy(*_DOC).orderBy("pos")
    while not level.isEmpty():
        # Later copies that begin line after line cover one stretch.
        copies = level.filter(F.col("later") & (F.col("chars") >= least_chars))
        stretch = copies.select(*_PLACE, (F.col("pos") - F.row_number().over(along)).alias("stretch"))
        covered = stretch.groupBy(*_DOC, "stretch").agg(F.min("pos").alias("from"), (F.max("pos") + size).alias("to"))
        found.append(covered.drop("stretch"))
        there = along.rangeBetween(size, size)
        pairs = level.select(*_PLACE, "rank", F.min("rank").over(there).alias("next"), (F.col("chars") + F.min("chars").over(there)).alias("chars"))
        level = stored(_ranked(pairs.filter("next is not null"), ["rank", "next"]), "suffixes")
        size *= 2
    every = found[0] if found else lines.select(*_DOC, F.col("pos").alias("from"), F.col("pos").alias("to")).limit(0)
    for more in found[1:]:
        every = every.unionByName(more)
    # Stretches that touch or overlap become one.
    inner = W.partitionBy(*_DOC).orderBy("from", "to")
    reach = F.max("to").over(inner.rowsBetween(W.unboundedPreceding, -1))
    begins = every.select(*_DOC, "from", "to", F.coalesce((F.col("from") > reach), F.lit(True)).cast("int").alias("new"))
    grouped = begins.withColumn("run", F.sum("new").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    runs = grouped.groupBy(*_DOC, "run").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return stored(runs.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("runs")), "runs", lasting=True)


def delete_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without later copies, and ``n_lines``, ``n_removed``.

    A line goes if it lies in a run of 1, 2, 4, 8, ... lines that has at least ``least_chars`` characters and
    also begins earlier: in a document with a smaller ``doc_id``, or further up in the same one. A longer
    repeated run is covered by two of these. So the first copy of everything stays, and short lines go
    with a longer run only. Runs are judged on the input, not on what is left.

    Lines end at ``\\n``; what is left is joined by it again. A text all of whose lines go is empty. A
    null text stays null with no lines; an empty one has one empty line. Rows without ``doc_id`` come
    after all others. Rows of equal id and text are one document and get the same result. Columns
    named ``n_lines`` and ``n_removed`` are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    runs = repeated_runs(docs, least_chars)
    joined = _keyed(docs).join(small(runs, "runs"), _DOC, "left").withColumn("lines", _lines("own_text"))
    n = F.size("lines")
    # Between two runs, and before the first and after the last, lines stay.
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get("runs", i - 1)["to"])
    end = lambda i: F.when(i == F.size("runs"), n).otherwise(F.get("runs", i)["from"])
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("runs")), lambda i: F.slice("lines", begin(i) + 1, end(i) - begin(i))))
    removed = F.aggregate("runs", F.lit(0), lambda s, r: s + r["to"] - r["from"])
    text = F.when(F.col("runs").isNull(), F.col("own_text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return joined.select(*columns, F.when(F.col("own_text").isNull(), 0).otherwise(n).alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"))
