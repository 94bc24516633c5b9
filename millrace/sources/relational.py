"""Incremental reads of relational tables (SRC-2, A-9, A-10, P-9)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F


class Source(Protocol):
    """Gives the rows of a table whose cursor column lies after ``since`` (all when None)."""

    def rows(
        self, table: str, key: str, cursor: str, since: str | None, partitions: int
    ) -> DataFrame | None: ...


@dataclass(frozen=True)
class ParquetSource:
    """Tables as Parquet folders; the cursor filter reaches the scan."""

    spark: SparkSession
    folder: str

    def rows(self, table, key, cursor, since, partitions):
        df = self.spark.read.parquet(f"{self.folder}/{table}")
        if since is not None:
            df = df.filter(F.col(cursor) > F.lit(since).cast(df.schema[cursor].dataType))
        return df

    def bounds(self, table: str, key: str) -> DataFrame:
        """A-10: (rows, low, high) of a table of whole files."""
        found = footer_bounds(self.spark, f"{self.folder}/{table}", key)
        rows, low, high = found.first()  # without any footer the count is missing too
        return self.spark.createDataFrame([(rows or 0, low, high)], found.schema)


@dataclass(frozen=True)
class JdbcSource:
    """Tables behind JDBC, read in ``partitions`` ranges of the key.

    The ranges are taken after the cursor filter, so an incremental read spreads its new rows over
    all ranges instead of crowding them into the last one. They hold equally many rows each, however the keys
    lie; with ``equal_depth`` off the database only finds the least and greatest key, which an index answers, and
    the ranges are equally wide. If that fails, the read falls back to a single range. An empty table gives None.
    """

    spark: SparkSession
    options: dict[str, str] = field(default_factory=dict)
    equal_depth: bool = True

    def rows(self, table, key, cursor, since, partitions):
        where = filter_text(cursor, since)
        options = {**self.options, "dbtable": f"(SELECT * FROM {table}{where}) AS src"}
        query = ranges_query(table, key, where, partitions) if self.equal_depth else bounds_query(table, key, where)
        try:
            ranges = self._load({"dbtable": query}).collect()  # as many rows as ranges
        except Exception:  # ranges are an optimisation: read in one without them
            return self.spark.read.format("jdbc").options(**options).load()
        ends = [(row["low"], row["high"]) for row in ranges if row["low"] is not None]
        if self.equal_depth and ranges:
            rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            parts = range_predicates(key, [high for _, high in ends])
            return self.spark.read.jdbc(options["url"], options["dbtable"], predicates=parts, properties=rest)
        if not ends:
            return None
        straight = {
            "partitionColumn": key,
            "lowerBound": str(ends[0][0]),
            "upperBound": str(ends[0][1]),
            "numPartitions": str(partitions),
        }
        return self.spark.read.format("jdbc").options(**options, **straight).load()

    def _load(self, extra: dict[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options, **extra).load()


def filter_text(cursor: str, since: str | None) -> str:
    """A-9 as SQL for the source database."""
    if since is None:
        return ""
    return f" WHERE {cursor} > TIMESTAMP '{since}'"


def bounds_query(table: str, key: str, where: str) -> str:
    """A-10."""
    return f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}{where}) AS bounds"


def ranges_query(table: str, key: str, where: str, partitions: int) -> str:
    """A-10 by rows: the least and greatest key of each of ``partitions`` ranges that hold equally many rows."""
    placed = f"SELECT {key}, ntile({partitions}) OVER (ORDER BY {key}) AS place FROM {table}{where}"
    return f"(SELECT min({key}) AS low, max({key}) AS high FROM ({placed}) AS placed GROUP BY place) AS ranges"


def range_predicates(key: str, highs: Sequence[int]) -> list[str]:
    """One condition per range of an integer key, which together take every row once, the first those without a key
    and the last also what lies above all ranges. A key that fills several ranges is in one of them."""
    ends = sorted(set(highs))[:-1]
    if not ends:
        return ["1 = 1"]
    first = f"{key} <= {ends[0]} OR {key} IS NULL"
    between = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(ends, ends[1:])]
    return [first, *between, f"{key} > {ends[-1]}"]


def footer_bounds(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A-10 for Parquet files: number of rows and least and greatest key (a number or date), which Spark takes from
    the file footers and so reads no row. Spark does this only in its newer file source, which a session of
    its own selects for this table."""
    own = spark.newSession()
    older = [name for name in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if name != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(older))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(
        F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")
    )


def last_cursor(
    target: DataFrame | None, cursor: str, lookback: str = "0 seconds"
) -> str | None:
    """A-9: newest cursor value of the target less ``lookback``, as text in UTC.

    None for a missing or empty table.
    """
    if target is None:
        return None
    newest = F.max(F.col(cursor).cast("timestamp")) - F.expr(f"INTERVAL {lookback}")
    return target.agg(newest.cast("string")).first()[0]


def read_incremental(
    source: Source,
    table: str,
    target: DataFrame | None,
    key: str = "id",
    cursor: str = "updated_at",
    partitions: int = 10,
    lookback: str = "0 seconds",
) -> DataFrame | None:
    """SRC-2: source rows newer than the target, stamped with ``ingested_at``; None if empty.

    ``lookback`` re-reads that much before the cursor, for rows that were committed late; the
    target then holds copies, which ``latest_by_key`` removes (D-5).
    """
    df = source.rows(table, key, cursor, last_cursor(target, cursor, lookback), partitions)
    return None if df is None else df.withColumn("ingested_at", F.current_timestamp())
