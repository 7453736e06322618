"""Messages per topic and time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hubloom.streaming.sinks import Trigger, append_files

WINDOW = "1 hour"
DELAY = "10 minutes"


def topic_activity(messages: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Count `topic, ts` messages per tumbling window; rows later than the
    delay are dropped."""
    return (messages.withWatermark("ts", delay)
            .groupBy(F.window("ts", window).alias("w"), "topic")
            .agg(F.count(F.lit(1)).alias("n_messages"))
            .select("topic", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "n_messages"))


def topic_activity_stream(messages: DataFrame, path: str, checkpoint: str,
                          window: str = WINDOW, delay: str = DELAY,
                          trigger: Trigger | None = None) -> StreamingQuery:
    """Windows are written once, when the watermark has passed their end."""
    return append_files(topic_activity(messages, window, delay), path, checkpoint,
                        trigger=trigger)
