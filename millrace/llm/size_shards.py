"""Balanced contiguous shards from global byte-size prefix sums, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import with_prefix_sums

SHARDS = 8


def sized(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, UTF-8 bytes plus one, checksum. Texts go no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def shards(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot.

    Documents stand in the order of doc_id (null first; equal ids by size and checksum). A document
    goes to the shard in whose equal share of all bytes its middle byte lies, so a shard is a
    contiguous range and its size differs from the others' by less than one document. Repeated
    rows each get a place; a null text has size 1; other columns are ignored; no rows, no shards.
    """
    placed = with_prefix_sums(sized(docs), ["doc_id", "size", "text_crc32"], "size", "shards")
    middle = F.expr(f"(2 * sum_before + size) * {int(count)} div (2 * sum_all)")
    placed = placed.withColumn("shard", middle.cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("row_index").alias("first_row"))
    return placed.join(F.broadcast(firsts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("row_index") - F.col("first_row")).alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, count: int = SHARDS) -> None:
    """Writes whole documents below ``folder``/shard=k.

    The first key of each shard (``count`` rows) routes the documents, so no join moves the texts.
    """
    keys = ["doc_id", "size", "text_crc32"]
    ends = shards(docs, count).groupBy("shard").agg(F.max(F.struct(*keys)).alias("last")).orderBy("shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.struct(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    number = F.lit(None).cast("int")
    for row in reversed(ends.collect()):
        last = F.struct(*(F.lit(row["last"][k]).cast("long").alias(k) for k in keys))
        number = F.when(key <= last, F.lit(row["shard"])).otherwise(number)
    docs.withColumn("shard", number).repartitionByRange("shard", "doc_id").write.partitionBy("shard").parquet(folder)
