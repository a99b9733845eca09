"""Kafka topics as streaming sources and sinks.

The connector jar comes with the cluster; nothing else here depends on it, since
the streaming job accepts any frame with ``key`` and ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Unbounded topic read.  ``max_offsets`` bounds a batch after a long outage."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, name: str):
    """Publish ``key``/``value`` rows; one checkpoint per query."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .queryName(name)
        .start()
    )
