"""Scoring a stream of texts: answers for usable texts, rejections for blank ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelloom.functions.text import clean_text, not_blank
from labelloom.operators.dedup import keep_first

VALID, REJECTED = "valid", "rejected"


def with_status(df: DataFrame) -> DataFrame:
    """Mark each request valid, or rejected for a missing or blank text."""
    usable = not_blank(clean_text(F.col("text")))
    return df.withColumn("status", F.when(usable, VALID).otherwise(REJECTED))


def score_requests(df: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Probabilities for valid requests; rejected ones stay, without a probability, and never reach the model."""
    marked = with_status(df)
    scored = scorer(marked.where(F.col("status") == VALID))
    rejected = marked.where(F.col("status") == REJECTED).withColumn("text", F.coalesce("text", F.lit("")))
    return scored.unionByName(rejected, allowMissingColumns=True)


def start_scoring(
    requests: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Run ``score_requests`` on a stream into Parquet, one directory per status.

    A single file sink takes answers and rejections: the input is read once, and the
    sink's commit log with the checkpoint makes both exactly-once.
    """
    writer = (
        score_requests(requests, scorer)
        .writeStream.format("parquet")
        .partitionBy("status")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def dedup_collected(df: DataFrame) -> DataFrame:
    """Copies of (text, label) leave a collected stream afterwards, in one batch pass.

    On the stream itself the state would grow with every text ever seen.
    """
    return keep_first(df, ["text", "label"])
