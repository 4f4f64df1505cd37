"""Assemble a sample table from an event log and a table of embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.running import CHUNK, ROWS_PER_CHUNK, totals_before, with_chunks
from clickloom.session import VECTOR_ROWS, few, materialise


def impressions_with_history(events: DataFrame, chunks: int | None = None, rows_per_key: int = ROWS_PER_CHUNK) -> DataFrame:
    """One slim row per event, with click and impression counts strictly before it."""
    impressions = events.select(
        "event_id",
        "ts",
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        F.when(F.col("event_type").isin("click", "purchase"), 1).otherwise(0).alias("label"),
    )
    order = ("ts", "event_id")
    one, click = F.lit(1), F.col("label")
    return totals_before(
        with_chunks(impressions, order, chunks),
        order,
        [
            (("user_id",), {"u_imp": one}),
            (("user_id", "item_id"), {"ui_click": click, "ui_imp": one}),
            (("item_id",), {"i_click": click, "i_imp": one}),
        ],
        rows_per_key,
    ).drop(CHUNK)


def sample_table(
    events: DataFrame,
    embeddings: DataFrame,
    chunks: int | None = None,
    rows_per_key: int = ROWS_PER_CHUNK,
    *,
    item_of: Callable[[Column], Column] = lambda vec_id: vec_id,
    prior_clicks: float = 1.0,
    prior_impressions: float = 20.0,
    new_user_below: int = 5,
    references: str | None = None,
) -> DataFrame:
    """The sample table with ``event_id`` as row key, a row for every event.

    Embeddings belong to the user of the same number, and to the item that ``item_of`` names. An
    impression without embedding keeps its row with nulls. The rate of an item is smoothed by the
    prior; a user is new below so many impressions. The two look-ups carry no broadcast hint: Spark
    broadcasts the embeddings where their size allows it, and otherwise sorts and merges, splitting a
    hot user or item at run time. ``references`` names a column of ``embeddings`` that numbers its rows:
    the numbers of the rows that were met are added as ``user_vector`` and ``item_vector``.
    """
    numbers = [references] if references else []
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("e"), "label", *numbers)
    users = vectors.select(F.col("vec_id").alias("user_id"), F.col("e").alias("user_embedding"), *[F.col(n).alias("user_vector") for n in numbers])
    items = vectors.select(
        item_of(F.col("vec_id")).alias("item_id"),
        F.col("e").alias("item_embedding"),
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("content_type"),
        *[F.col(n).alias("item_vector") for n in numbers],
    )
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    history = impressions_with_history(events, chunks, rows_per_key)
    joined = history.join(items, "item_id", "left").join(users, "user_id", "left")
    return joined.select(
        "event_id",
        F.col("user_id").cast("int").alias("user_id"),
        F.col("item_id").cast("int").alias("item_id"),
        (F.col("item_id") % 10).cast("int").alias("category_id"),
        "content_type",
        F.floor(micros / 1e6).cast("bigint").cast("string").alias("timestamp"),
        F.col("ui_click").cast("bigint").alias("user_item_click"),
        F.log(1.0 + F.col("ui_imp")).alias("user_item_imp"),
        ((F.col("i_click") + prior_clicks) / (F.col("i_imp") + prior_impressions)).alias("item_ctr"),
        F.when(F.col("u_imp") < new_user_below, 1).otherwise(0).alias("is_new_user"),
        "user_embedding",
        "item_embedding",
        "label",
        *(["user_vector", "item_vector"] if references else []),
    )


def stored_samples(embeddings: DataFrame, make: Callable[..., DataFrame], parts: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """The samples that ``make(embeddings, references)`` gives, written to the shared folder and read back.

    An embedding that many impressions share is stored once: rows hold its number and meet it again when they are
    read. If the embeddings are too many to broadcast (see ``session.few``), rows are stored with them instead.
    ``parts`` (a whole number for each row) adds a column ``part`` by which files are kept apart.
    """
    number = "_vector"
    vectors = materialise(embeddings.withColumn(number, F.monotonically_increasing_id()), "vectors")
    samples = make(vectors, number)
    columns = [c for c in samples.columns if c not in ("user_vector", "item_vector")]
    if parts is not None:
        samples, columns = samples.withColumn("part", parts(samples)), [*columns, "part"]
    by = [] if parts is None else ["part"]
    held = vectors.select(number, F.col("embedding").cast("array<double>").alias("e"))
    if not few(held, "e"):
        return materialise(samples.select(*columns), "samples", VECTOR_ROWS, by)
    rows = materialise(samples.drop("user_embedding", "item_embedding"), "samples", VECTOR_ROWS, by)
    for side in ("user", "item"):
        named = held.select(F.col(number).alias(f"{side}_vector"), F.col("e").alias(f"{side}_embedding"))
        rows = rows.join(F.broadcast(named), f"{side}_vector", "left")
    return rows.select(*columns)
