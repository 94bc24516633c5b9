"""Kafka inputs. They need the Kafka (and Avro) connector packages on the classpath."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Stream of (key, value, topic, partition, offset, timestamp) from the earliest offset; value is binary."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("key", "value", "topic", "partition", "offset", "timestamp")


def text_values(messages: DataFrame) -> DataFrame:
    """JSON topics: ``value`` as text, ready for ``decode_changes``. The topic, which routes item changes, and the
    offset, which orders the versions of a key (always in one partition), come along where they are known."""
    known = [c for c in ("topic", "offset") if c in messages.columns]
    return messages.select(F.col("value").cast("string").alias("value"), *known)


def avro_row(value: Column, avro_schema: str) -> Column:
    """Avro with a registry header: five bytes (marker and schema number) precede the record."""
    from pyspark.sql.avro.functions import from_avro

    record = F.substring(value, 6, 2147483647)
    return from_avro(record, avro_schema, {"mode": "PERMISSIVE"})


def as_messages(df: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-6: rows as keyed JSON messages for an upsert topic."""
    return df.select(
        F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("*")).alias("value")
    )
