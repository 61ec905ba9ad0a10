"""Published topics. Needs the Kafka connector package; delivery is at least once, and
content-hashed event ids let consumers drop repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orderloom.sources.topics import to_keyed_records


def publish_stream(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    key: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Write a stream to a topic: ``append`` for event topics, ``update`` with the key
    column for compacted (upsert) topics."""
    return (
        to_keyed_records(df, key)
        .writeStream.format("kafka")
        .outputMode(output_mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="10 seconds")
        .start()
    )
