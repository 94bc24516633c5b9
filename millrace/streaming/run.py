"""Running a stream into tables (SNK-3, W-5, W-6)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

_STARTING = threading.Lock()  # streams that start at once must not see each other's setting


def run_stream(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    state_partitions: int | None = None,
) -> str | None:
    """Process everything available now and stop; the checkpoint remembers what was done. Returns the watermark that
    the last batch went by, as ISO text, None without a watermark or a batch.

    ``state_partitions`` sets the number of state partitions of a new checkpoint, which can never
    change afterwards; the session's shuffle partitions by default.
    """
    spark = stream.sparkSession
    with _STARTING:  # a query keeps the settings it was started with
        session_partitions = spark.conf.get("spark.sql.shuffle.partitions")
        if state_partitions is not None:
            spark.conf.set("spark.sql.shuffle.partitions", state_partitions)
        try:
            query = (
                stream.writeStream.outputMode("append")
                .foreachBatch(write_batch)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", session_partitions)
    query.awaitTermination()
    last = query.lastProgress
    return last["eventTime"].get("watermark") if last else None


def shared_scan(
    *writers: Callable[[DataFrame, int], None],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """W-6: feed several writers from one scan of each batch, which ``prepare`` changes first."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = (prepare(batch) if prepare else batch).persist(StorageLevel.DISK_ONLY)
        try:
            for writer in writers:
                writer(kept, batch_id)
        finally:
            kept.unpersist()

    return write
