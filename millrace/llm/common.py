"""Helpers that several operators share: written tables, row order, prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import scratch_dir


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs neither recompute it nor need
    the executors that made it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null: as empty) in joins."""
    whole = F.coalesce(text, F.lit(""))
    low = F.xxhash64(F.lit(7), whole)
    return F.concat(F.to_binary(F.lpad(F.hex(F.xxhash64(whole)), 16, "0"), F.lit("hex")),
                    F.to_binary(F.lpad(F.hex(low), 16, "0"), F.lit("hex")))


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer if a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


SLOTS = 2**20  # hash slots in which keys are looked for before a join; a broadcast of at most so many rows


def slot(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def maybe_among(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The ``rows`` whose key shares a slot with one of ``wanted``: all that a join on the key would find
    and some more. It keeps wide rows that cannot match out of the join's shuffle."""
    hit = wanted.select(slot(wanted_key).alias("wanted_slot")).distinct()
    marked = rows.withColumn("wanted_slot", slot(key))
    return marked.join(F.broadcast(hit), "wanted_slot", "left_semi").drop("wanted_slot")


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in partitions of ascending ranges of ``order``, sorted within. ``tie`` (new) separates
    equal rows, so that many rows of one key still spread over several partitions."""
    keys = [*order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(shuffle_partitions(rows), *keys).sortWithinPartitions(*keys)


def with_prefix_sums(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``row_index`` (from 0), ``sum_before`` (of ``value`` over all earlier rows) and
    ``sum_all``, in the order of ``order``.

    Each range partition is summed on its own; only the totals, one row per partition, meet in one
    task and return as a broadcast.
    """
    placed = cut(in_order(rows, *order).withColumn("part", F.spark_partition_id()), name)
    totals = placed.groupBy("part").agg(F.sum(value).alias("part_sum"), F.count("*").alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("base_sum"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("base_rows"),
        F.sum("part_sum").over(everything).alias("sum_all"),
    )
    within = Window.partitionBy("part").orderBy(*order, "tie")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("local_rows", F.row_number().over(within) - 1)
        .withColumn("local_sum", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .join(F.broadcast(bases), "part")  # as many rows as there are partitions
        .withColumn("row_index", F.col("base_rows") + F.col("local_rows"))
        .withColumn("sum_before", F.col("base_sum") + F.col("local_sum"))
        .drop("part", "tie", "local_rows", "local_sum", "base_rows", "base_sum")
    )


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
