"""Message streams in and out: Kafka in production, text files of the same ``value`` column elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: a new consumer begins with messages published after it starts.
STARTING_OFFSETS = "latest"


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Source options; ``options`` adds or overrides any (``maxOffsetsPerTrigger``, ``minPartitions``)."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": STARTING_OFFSETS,
        **options,
    }


def message_stream(
    spark: SparkSession,
    *,
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded DataFrame with a ``value`` column, from a Kafka topic or from landed text files."""
    if (path is None) == (topic is None):
        raise ValueError("give either a topic or a path")
    if path is not None:
        return spark.readStream.format("text").options(**options).load(path)
    if servers is None:
        raise ValueError("a topic needs servers")
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def publish_messages(
    encoded: DataFrame,
    *,
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    **options: str,
) -> None:
    """Send encoded messages (``value``, optional ``key``) to a Kafka topic, or append them as text."""
    if (path is None) == (topic is None):
        raise ValueError("give either a topic or a path")
    if path is not None:
        encoded.select("value").write.mode("append").text(path)
        return
    if servers is None:
        raise ValueError("a topic needs servers")
    sink = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    encoded.write.format("kafka").options(**sink).save()


def landed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed market payloads, one whole file per row in ``value``."""
    return spark.read.text(path, wholetext=True)
