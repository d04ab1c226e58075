"""Track lines from a message topic or from files, as a stream or a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("kafka", "text", "parquet")


def topic_options(servers: str, topic: str, **opts: str) -> dict[str, str]:
    """Options of the message source; every query keeps its own offsets in its checkpoint."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest", **opts}


def track_lines(
    spark: SparkSession, kind: str, path_or_servers: str, topic: str | None = None, stream: bool = True,
    schema: str = "line string", **opts: str,
) -> DataFrame:
    """Frame or stream with a ``line`` column.  The key of a message is dropped.

    kind='kafka' needs Spark's Kafka package; 'text' reads one line per record and 'parquet'
    files with a ``line`` column (``schema`` may name more).
    """
    reader = spark.readStream if stream else spark.read
    if kind == "kafka":
        if not topic:
            raise ValueError("kind='kafka' needs a topic")
        if not stream:
            opts = {"startingOffsets": "earliest", **opts}
        source = reader.format("kafka").options(**topic_options(path_or_servers, topic, **opts)).load()
        return source.select(F.col("value").cast("string").alias("line"))
    if kind == "text":
        return reader.options(**opts).text(path_or_servers).select(F.col("value").alias("line"))
    if kind == "parquet":
        return reader.schema(schema).options(**opts).parquet(path_or_servers)
    raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")


def message(lines: DataFrame) -> DataFrame:
    """What goes on a topic: the raw line, no key."""
    return lines.select(F.col("line").alias("value"))


def to_topic(lines: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Put lines on a topic: a batch write, or a started query if ``lines`` is a stream."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if lines.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder")
        return message(lines).writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    message(lines).write.format("kafka").options(**options).save()
    return None


def to_files(lines: DataFrame, path: str) -> None:
    """The same records as text files, one line each."""
    message(lines).write.mode("overwrite").text(path)
