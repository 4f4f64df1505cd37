"""Score a stream. Each row is scored by itself, so the output equals that of a batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.plans.scoring import CTR, score


def score_stream(model: PipelineModel, stream: DataFrame, output: str = CTR) -> DataFrame:
    """A streaming table with ``ctr`` added."""
    if not stream.isStreaming:
        raise ValueError("score_stream needs a streaming table; use score for a batch")
    return score(model, stream, output)


def write_scores(
    model: PipelineModel, stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append scores to Parquet, exactly once. Without ``every`` the query ends when the input does."""
    writer = (
        score_stream(model, stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
