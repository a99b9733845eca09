"""Where streaming results go.  Every query has its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from punctua.sources.kafka import read_kafka, write_kafka
from punctua.streaming.congestion import (
    Windows,
    as_messages,
    congestion,
    parse_messages,
    positions_of,
    rejected,
)


def _trigger(writer, available_now: bool, every: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def to_parquet(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append windows once the watermark has passed them.

    The file sink and the checkpoint together make every window appear exactly once,
    also after a restart.
    """
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    return _trigger(writer, available_now, every).start()


def to_console(rows: DataFrame, checkpoint: str, name: str = "congestion_console", n: int = 20):
    """Busiest cells first on the console.

    Sorting a stream needs complete mode, which never forgets a window: for
    demonstrations on bounded input only.
    """
    return (
        rows.orderBy(F.col("aircraft_count").desc())
        .writeStream.outputMode("complete")
        .format("console")
        .option("truncate", "false")
        .option("numRows", n)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .start()
    )


def to_memory(
    rows: DataFrame, name: str, mode: str = "append", available_now: bool = True
) -> StreamingQuery:
    """In-memory result table, for tests."""
    writer = rows.writeStream.outputMode(mode).format("memory").queryName(name)
    return _trigger(writer, available_now, None).start()


def start_congestion(
    messages: DataFrame,
    output: str,
    checkpoints: str,
    windows: Windows = Windows(),
    send: Callable[[DataFrame, str], StreamingQuery] | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> list[StreamingQuery]:
    """Several outputs of one stream of ``key``/``value`` messages, from whatever source.

    Windows and rejects go to files, keyed messages to ``send(messages, checkpoint)`` if given.
    Each query reads the source by itself and has a checkpoint of its own, so each resumes
    where it stopped, whatever became of the others.
    """
    parsed = parse_messages(messages)
    cells = congestion(positions_of(parsed), windows)
    outputs = [("congestion", cells), ("rejected", rejected(parsed))]
    started = [
        to_parquet(rows, f"{output}/{name}", f"{checkpoints}/{name}", name, available_now, every)
        for name, rows in outputs
    ]
    return started + ([send(as_messages(cells), f"{checkpoints}/sent")] if send else [])


def run_congestion(
    spark: SparkSession,
    servers: str,
    topic: str,
    output: str,
    checkpoints: str,
    windows: Windows = Windows(),
    out_topic: str | None = None,
    starting: str = "latest",
    every: str | None = None,
) -> list[StreamingQuery]:
    """The long-running job between topics; wait with ``spark.streams.awaitAnyTermination()``."""
    def send(messages: DataFrame, checkpoint: str) -> StreamingQuery:
        return write_kafka(messages, servers, out_topic, checkpoint, "congestion_topic")

    source = read_kafka(spark, servers, topic, starting)
    return start_congestion(source, output, checkpoints, windows, send if out_topic else None, every=every)
