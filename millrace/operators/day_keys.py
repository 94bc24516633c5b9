"""Which days hold which ids, as bitmaps, so that a changed dimension row finds the days it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _bitmaps(pairs: DataFrame, *by: str) -> DataFrame:
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    held = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("held")
    return pairs.filter("id IS NOT NULL").groupBy(*by, bucket).agg(held)


def day_bitmaps(rows: DataFrame, day: Column, keys: dict[str, Column]) -> DataFrame:
    """(day, key, bucket, held): per day and named key a bitmap of 32768 ids for each bucket that occurs. Built map-side,
    so a hot id costs nothing more."""
    each = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("bigint").alias("id")) for k, c in keys.items()])
    pairs = rows.select(day.alias("day"), F.explode(each).alias("each")).select("day", "each.*")
    return _bitmaps(pairs, "day", "key")


def days_with(bitmaps: DataFrame, ids: DataFrame) -> DataFrame:
    """The days that hold one of ``ids`` (key, id). Bitmaps meet bitmaps: two share an id if their union has fewer than
    both together, however many ids are asked for."""
    asked = _bitmaps(ids, "key").withColumnRenamed("held", "asked")
    met = bitmaps.join(asked, ["key", "bucket"]).withColumn("either", F.explode(F.array("held", "asked")))
    unions = met.groupBy("day", "key", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("either")).alias("union"),
        F.sum(F.bitmap_count("either")).alias("both"),
    )
    return unions.filter("union < both").select("day").distinct()
