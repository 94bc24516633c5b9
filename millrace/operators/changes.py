"""Change-data-capture rows: decoding, defaults, flattening, item documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.functions import times
from millrace.operators.latest import latest_by_key
from millrace.schemas import ITEM_ENVELOPE, PURCHASE_CHANGE

# Fixed value: destination name inside a topic name (SNK-7).
TOPIC_PATTERN = r"^dbz.public.(.*)$"

LOG_COLUMNS = ("batch_id", "log_position", "created_month", "ingested_at")  # of the log, not of a row

# Stored types that are narrower than those of a purchase change row.
PURCHASE_LIMITS = {"status": "smallint", "purchase_price": "decimal(12,2)"}


def versions_of(rows: DataFrame, column: str) -> list[str]:
    """What orders the versions of a row: ``column``, then the place in the log, as far as it is kept."""
    return [column, *(c for c in ("batch_id", "log_position") if c in rows.columns)]


def positions(messages: DataFrame) -> Column:
    """The place of a message in its log: its topic partition's offset, or its place in the batch's files.

    A replayed batch reads the same files in the same order, so its places are the same.
    """
    if "offset" in messages.columns:
        return F.col("offset").cast("bigint").alias("log_position")
    return F.monotonically_increasing_id().alias("log_position")


def decode_changes(
    messages: DataFrame, schema: str = PURCHASE_CHANGE, limits: dict[str, str] | None = None
) -> DataFrame:
    """SRC-3: JSON text in ``value`` becomes the columns of ``schema`` plus ``log_position``, ``_error`` and
    ``_raw_message``; ``_error`` is '' for a readable message. Empty payloads are dropped.

    ``limits`` names the narrower type a column must fit; a value beyond it is an error of its
    message, so that it cannot stop the stream later.
    """
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    row = F.from_json("value", f"{schema}, _corrupt STRING", options)
    decoded = messages.filter(F.col("value").isNotNull()).select(
        "value", positions(messages), row.alias("_row")
    )
    return route(decoded, schema, F.col("_row._corrupt").isNotNull(), limits)


def decode_avro_changes(
    messages: DataFrame,
    record: Column,
    schema: str = PURCHASE_CHANGE,
    limits: dict[str, str] | None = None,
) -> DataFrame:
    """SRC-3 for Avro: ``record`` is the decoded struct (``kafka.avro_row``), NULL where unreadable; the
    error table keeps the message's bytes in base64."""
    decoded = messages.filter(F.col("value").isNotNull()).select(
        F.base64("value").alias("value"), positions(messages), record.alias("_row")
    )
    return route(decoded, schema, F.col("_row").isNull(), limits)


def route(
    decoded: DataFrame, schema: str, unreadable: Column, limits: dict[str, str] | None
) -> DataFrame:
    """Rows (value, log_position, _row) with the error that keeps them out of the table, if any: the
    same rules for every encoding."""
    bad = unreadable | F.col("_row.id").isNull()
    misfit = F.lit(False)
    for name, kind in (limits or {}).items():
        value = F.col(f"_row.{name}")
        misfit = misfit | (value.isNotNull() & value.try_cast(kind).isNull())
    error = F.when(bad, "decode error").when(misfit, "value out of range").otherwise("")
    return decoded.select(
        *[F.col(f"_row.{name}").alias(name) for name in StructType.fromDDL(schema).names],
        "log_position",
        error.alias("_error"),
        F.when(error != "", F.col("value")).otherwise(F.lit("")).alias("_raw_message"),
    )


def valid_purchases(changes: DataFrame) -> DataFrame:
    """P-12, P-13, P-14: readable change rows with defaults and table types."""

    def filled(name: str, default):
        return F.coalesce(F.col(name), F.lit(default))

    return changes.filter(F.col("_error") == "").select(
        F.col("id").cast("bigint").alias("id"),
        filled("user_id", 0).cast("bigint").alias("user_id"),
        filled("item_id", 0).cast("bigint").alias("item_id"),
        filled("campaign_id", "").alias("campaign_id"),
        filled("status", 1).cast("smallint").alias("status"),
        filled("quantity", 0).cast("int").alias("quantity"),
        filled("purchase_price", 0.0).cast("decimal(12,2)").alias("purchase_price"),
        filled("deleted", False).alias("deleted"),
        times.from_epoch_micros(filled("created_at", 0)).alias("created_at"),
        times.from_epoch_micros(filled("updated_at", 0)).alias("updated_at"),
        *[c for c in ("log_position",) if c in changes.columns],
    )


def purchase_errors(changes: DataFrame) -> DataFrame:
    """SNK-5, P-14: unreadable messages with their text."""
    return changes.filter(F.col("_error") != "").select("_error", "_raw_message")


def latest_purchases(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """W-3 over the whole log: one row per id, whatever month its versions fell into (D-10)."""
    wanted = columns or [c for c in log.columns if c not in LOG_COLUMNS]
    return latest_by_key(log, "id", versions_of(log, "updated_at"), wanted)


def decode_items(messages: DataFrame) -> DataFrame:
    """SRC-4, P-22: change envelopes as JSON text in ``value`` become flat item rows plus ``log_position``,
    ``_error`` and ``_raw_message``. A message that cannot be read, lacks an operation or an id, or has a
    price that is no price is an error. Tombstones (NULL values) are dropped."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    envelope = F.from_json("value", f"{ITEM_ENVELOPE}, _corrupt STRING", options)
    read = messages.filter(F.col("value").isNotNull()).select(
        "value", positions(messages), envelope.alias("_c")
    )
    row = F.when(F.col("_c.op") == "d", F.col("_c.before")).otherwise(F.col("_c.after"))
    bad = F.col("_c._corrupt").isNotNull() | F.col("_c.op").isNull() | row["id"].isNull()
    misfit = row["price"].isNotNull() & row["price"].try_cast("decimal(10,2)").isNull()
    error = F.when(bad, "decode error").when(misfit, "value out of range").otherwise("")
    marked = read.select("value", "log_position", "_c.*", error.alias("_error"))
    flat = flatten_changes(marked, ["log_position", "_error", "value"])
    return typed_items(flat).withColumn("_raw_message", F.col("value")).drop("value")


def flatten_changes(changes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P-22: a change envelope (before, after, op, source) as a row with ``__op``, ``__table``,
    ``__source_ts_ms`` and ``__deleted``. Already flat rows pass. Tombstones are dropped (W-8), unless
    ``keep`` names columns to carry along, which then decide about such rows."""
    if "after" not in changes.columns:
        return changes.filter(F.col("id").isNotNull())
    fields = changes.schema["after"].dataType.names
    deleted = F.col("op") == "d"
    rows = changes if keep else changes.filter(F.col("op").isNotNull())
    return rows.select(
        *(keep or ()),
        *[
            F.when(deleted, F.col(f"before.{name}")).otherwise(F.col(f"after.{name}")).alias(name)
            for name in fields
        ],
        F.col("op").alias("__op"),
        F.col("source.table").alias("__table"),
        F.col("source.ts_ms").alias("__source_ts_ms"),
        deleted.cast("string").alias("__deleted"),
    )


def typed_items(rows: DataFrame) -> DataFrame:
    """Flat item rows as sent (price as text, microsecond times) with table types."""
    columns = []
    for name in rows.columns:
        if name == "price":
            columns.append(F.col("price").try_cast("decimal(10,2)").alias("price"))
        elif name in ("created_at", "updated_at"):
            columns.append(times.from_epoch_micros(F.col(name)).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return rows.select(*columns)


def item_documents(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SNK-7, W-8: newest row per item; a deleted item stays, with its flag set."""
    wanted = columns or [c for c in rows.columns if c not in LOG_COLUMNS]
    typed = rows.withColumn("__deleted", F.col("__deleted").cast("boolean"))
    return latest_by_key(typed, "id", versions_of(rows, "__source_ts_ms"), wanted)


def document_count(documents: DataFrame) -> DataFrame:
    """A-12: all documents, and those not flagged as deleted."""
    live = F.when(F.coalesce("__deleted", F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(live), F.lit(0)).cast("bigint").alias("live_documents"),
    )


def destination_of(topic: Column) -> Column:
    """SNK-7: table part of a topic name; a topic of another form keeps its name."""
    return F.when(
        topic.rlike(TOPIC_PATTERN), F.regexp_extract(topic, TOPIC_PATTERN, 1)
    ).otherwise(topic)
