"""Scoring new rows with fitted transformers on Structured Streaming.

Every fitted tabforge transformer (ordinal maps, one-hot levels, mode values,
robust scaling, equal-width edges, Box-Cox λ, linear models, tail quantiles)
turns into plain projections, and group statistics into a join with a static
table, so a pipeline fitted in batch applies unchanged to a streaming
DataFrame: no state store is needed.  Fitting itself stays a batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Step = Callable[[DataFrame], DataFrame]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply fitted steps in order; works for batch and streaming frames alike."""
    for step in steps:
        df = step(df)
    return df


def score_stream(source: DataFrame, steps: Sequence[Step], path: str, checkpoint: str,
                 fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start a query that writes the scored stream to ``path``.

    ``checkpoint`` must be a shared, durable folder so the query survives the
    loss of executors or of the driver.  ``available_now`` processes what is
    there and stops (batch-like incremental runs); otherwise it keeps running.
    """
    if not source.isStreaming:
        raise ValueError("score_stream needs a streaming DataFrame (spark.readStream...)")
    writer = (apply_steps(source, steps).writeStream.format(fmt)
              .option("path", path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
