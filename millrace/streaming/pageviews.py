"""Pageview ingest with dead letters (SRC-1, SNK-4, P-8, P-9, P-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import times
from millrace.sources.files import read_pageviews
from millrace.streaming.run import run_stream, shared_scan
from millrace.tables import Store


def valid_pageviews(raw: DataFrame) -> DataFrame:
    """Readable events with timestamp and ingest metadata."""
    return raw.filter(F.col("_corrupt_record").isNull()).select(
        "user_id",
        "url",
        "channel",
        times.from_epoch_seconds(F.col("received_at")).alias("received_at"),
        F.current_timestamp().alias("ingested_at"),
        "source_file",
    )


def dead_letter_pageviews(raw: DataFrame) -> DataFrame:
    """SNK-4: unreadable events with whatever fields could be read."""
    return raw.filter(F.col("_corrupt_record").isNotNull()).select(
        F.current_timestamp().alias("ingestion_time"),
        "source_file",
        F.col("_corrupt_record").alias("raw_record"),
        "user_id",
        "url",
    )


def ingest_pageviews(store: Store, path: str, checkpoint: str, max_files: int = 1000) -> None:
    """Both tables are written from one scan per batch; errors are raised (D-6)."""
    run_stream(
        read_pageviews(store.spark, path, max_files),
        shared_scan(
            lambda batch, n: store.write(
                valid_pageviews(batch), "bronze.pageviews", batch_id=n
            ),
            lambda batch, n: store.write(
                dead_letter_pageviews(batch), "bronze.pageviews_dlq", batch_id=n
            ),
        ),
        checkpoint,
    )
