"""Message topics: string values in, string values out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.config import JobConfig
from waybill.schemas import ODS_TOPIC, TOPIC_WRITERS
from waybill.sources.changelog import LOG_POSITION, topic_position


def topic_values(messages: DataFrame) -> DataFrame:
    """Text of each message; empty and missing payloads are skipped."""
    kept = [c for c in ("table", LOG_POSITION) if c in messages.columns]
    return messages.select(F.col("value").cast("string").alias("value"), *kept).filter(
        F.col("value").isNotNull() & (F.col("value") != "")
    )


def read_topic(spark: SparkSession, config: JobConfig, topic: str, group_id: str) -> DataFrame:
    """Stream the values of a topic.

    With ``topic-root`` set, topics are folders of parquet files written by
    ``waybill.streaming.sinks``; else they are Kafka topics. The folders of the operational
    topic are split by source table: its ``table`` column lets readers skip files unread.
    """
    topic = config.get("topic", topic)
    if config.get("topic-root"):
        columns = "value string, topic string"
        if topic == ODS_TOPIC:
            columns += ", table string"
        files = spark.readStream.schema(columns).options(**config.file_options())
        folder = f"{config['topic-root']}/{TOPIC_WRITERS[topic]}"
        return topic_values(files.parquet(folder).filter(F.col("topic") == topic))
    messages = spark.readStream.format("kafka").options(**kafka_source(config, topic, group_id)).load()
    return topic_values(messages.withColumn(LOG_POSITION, topic_position()))


def kafka_source(config: JobConfig, topic: str, group_id: str) -> dict[str, str]:
    if not topic:
        raise ValueError("topic must not be empty")
    if not config.get("group-id", group_id):
        raise ValueError("group id must not be empty")
    return {
        "kafka.bootstrap.servers": config["bootstrap-servers"],
        "subscribe": topic,
        "kafka.group.id": config.get("group-id", group_id),
        "startingOffsets": config.get("offset-reset", "latest"),
        # A lost offset range fails the query instead of skipping rows.
        "failOnDataLoss": "true",
    }


def kafka_sink(config: JobConfig, topic: str | None = None) -> dict[str, str]:
    """Producer options. Without ``topic`` each row's own ``topic`` column decides."""
    options = {
        "kafka.bootstrap.servers": config["bootstrap-servers"],
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }
    topic = config.get("topic", topic) if topic else None
    return {**options, "topic": topic} if topic else options
