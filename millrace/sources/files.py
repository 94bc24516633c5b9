"""File-based inputs, batch or streaming (SRC-1, SRC-3 .. SRC-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas


def read_pageviews(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """SRC-1: stream of JSON pageviews; unreadable text arrives in ``_corrupt_record``."""
    return (
        spark.readStream.schema(schemas.PAGEVIEW_EVENT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("maxFilesPerTrigger", max_files)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def read_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """SRC-3, SRC-4: stream of raw text messages in ``value``, one per line."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def read_logins(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """SRC-5: stream of JSON login events, all files from the earliest."""
    reader = spark.readStream.schema(schemas.LOGIN_EVENT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: geo prefixes from CSV with a header; # starts a comment, bad lines are ignored."""
    return (
        spark.read.schema(schemas.GEO_PREFIX)
        .option("header", True)
        .option("mode", "DROPMALFORMED")
        .option("comment", "#")
        .csv(path)
    )
