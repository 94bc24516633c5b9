"""Declared tables: column types and partition columns of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType, StructType


@dataclass(frozen=True)
class Table:
    """``derived`` maps a partition column to the expression that fills it.

    A ``log`` table is written in numbered batches and has ``batch_id`` as its last partition.
    """

    ddl: str
    partition_by: tuple[str, ...] = ()
    derived: dict[str, str] = field(default_factory=dict)
    log: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def stored_schema(self) -> StructType:
        """The declared columns plus the derived partition columns."""
        schema = self.schema
        for name, expression in self.derived.items():
            schema = schema.add(name, "date" if expression.startswith("to_date") else "string")
        return schema


def _by_day(ddl: str, column: str, name: str, log: bool = False) -> Table:
    return Table(ddl, (name,), {name: f"to_date({column})"}, log)


BUCKETS = 64  # parts of a table that is rewritten by hash of its key


def bucket_of(key: str) -> str:
    """The bucket of a key, as SQL text; a string, as partition values are."""
    return f"cast(pmod(hash({key}), {BUCKETS}) AS string)"


def _by_bucket(ddl: str, key: str) -> Table:
    return Table(ddl, ("bucket",), {"bucket": bucket_of(key)})


def _by_category(ddl: str) -> Table:
    """The key is a copy: a folder name cannot tell an empty category from a missing one."""
    return Table(ddl, ("category_key",), {"category_key": "category"})


# Shapes of incoming messages, as DDL text so that importing needs no session.
PAGEVIEW_EVENT = (
    "user_id BIGINT, url STRING, channel STRING, received_at BIGINT, _corrupt_record STRING"
)
PURCHASE_CHANGE = (
    "id BIGINT, user_id BIGINT, item_id BIGINT, campaign_id STRING, status INT, quantity INT, "
    "purchase_price DOUBLE, deleted BOOLEAN, created_at BIGINT, updated_at BIGINT"
)
ITEM_ROW = (
    "id BIGINT, name STRING, category STRING, price STRING, inventory INT, "
    "created_at BIGINT, updated_at BIGINT"
)
ITEM_ENVELOPE = (
    f"before STRUCT<{ITEM_ROW}>, after STRUCT<{ITEM_ROW}>, op STRING, "
    "source STRUCT<table STRING, ts_ms BIGINT>"
)
LOGIN_EVENT = (
    "user_id STRING, timestamp STRING, ip STRING, device STRING, platform STRING, user_agent STRING"
)
GEO_PREFIX = "ip_prefix STRING, country STRING, city STRING"

# Columns and partitions of the declared tables.
TABLES: dict[str, Table] = {
    "bronze.users": _by_day(
        "id BIGINT, first_name STRING, last_name STRING, email STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP, ingested_at TIMESTAMP",
        "created_at",
        "created_day",
    ),
    "bronze.items": _by_category(
        "id BIGINT, name STRING, category STRING, price DECIMAL(7,2), inventory INT, "
        "created_at TIMESTAMP, updated_at TIMESTAMP, ingested_at TIMESTAMP"
    ),
    "bronze.purchases": _by_day(
        "id BIGINT, user_id BIGINT, item_id BIGINT, quantity INT, purchase_price DECIMAL(12,2), "
        "created_at TIMESTAMP, updated_at TIMESTAMP, ingested_at TIMESTAMP",
        "created_at",
        "created_day",
    ),
    "bronze.pageviews": _by_day(
        "user_id BIGINT, url STRING, channel STRING, received_at TIMESTAMP, "
        "ingested_at TIMESTAMP, source_file STRING",
        "received_at",
        "received_day",
        log=True,
    ),
    "bronze.pageviews_dlq": Table(
        "ingestion_time TIMESTAMP, source_file STRING, raw_record STRING, user_id BIGINT, "
        "url STRING",
        log=True,
    ),
    "bronze.rejected_rows": Table(
        "table_name STRING, raw_record STRING, ingested_at TIMESTAMP", log=True
    ),
    # How far each table has been loaded: one row per table.
    "bronze.load_cursors": Table("table_name STRING, updated_at TIMESTAMP", ("table_name",)),
    "silver.users": _by_day(
        "id BIGINT, first_name STRING, last_name STRING, email STRING, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, valid_email BOOLEAN, full_name STRING",
        "created_at",
        "created_day",
    ),
    "silver.items": _by_category(
        "id BIGINT, name STRING, category STRING, price DECIMAL(7,2), inventory INT, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "silver.purchases_enriched": _by_day(
        "id BIGINT, user_id BIGINT, item_id BIGINT, quantity INT, purchase_price DECIMAL(12,2), "
        "total_price DECIMAL(14,2), user_email STRING, item_name STRING, item_category STRING, "
        "purchase_date DATE, purchase_hour INT, created_at TIMESTAMP, updated_at TIMESTAMP",
        "created_at",
        "created_day",
    ),
    "silver.pageviews_by_items": _by_day(
        "user_id BIGINT, item_id BIGINT, page STRING, item_name STRING, item_category STRING, "
        "channel STRING, received_at TIMESTAMP",
        "received_at",
        "received_day",
    ),
    "silver.quality_report": Table(
        "table_name STRING, rule STRING, failed BIGINT, total BIGINT"
    ),
    # What a refresh of silver has used: partition copies of bronze tables, batches of the pageviews.
    "silver.built_from": Table("table_name STRING, part STRING"),
    # The ids that occur in a day of a bronze table, as bitmaps.
    "silver.day_keys": Table(
        "fact STRING, day DATE, key STRING, bucket BIGINT, held BINARY",
        ("fact_day",),
        {"fact_day": "concat_ws(' ', fact, day)"},
    ),
    # The views of each user on a day: the version that the user activity holds, and for a moment the one to come.
    "silver.day_activity": Table(
        "user_id BIGINT, day DATE, views BIGINT, version STRING",
        ("activity_day",),
        {"activity_day": "coalesce(cast(day AS string), 'none')"},
    ),
    # Per user and run of 64 days the active days as bits, and the views. Rows with folded_day name what of a day
    # they hold: the partition copies it was read from and its version in silver.day_activity.
    "silver.user_activity": Table(
        "user_id BIGINT, word BIGINT, days BIGINT, views BIGINT, "
        "folded_day STRING, folded_from STRING, version STRING",
        ("part",),
        {"part": "if(folded_day IS NULL, coalesce(cast(word AS string), 'none'), 'folded')"},
    ),
    "gold.top_selling_items": Table(
        "item_id BIGINT, item_name STRING, item_category STRING, total_revenue DECIMAL(24,2)"
    ),
    "gold.sales_performance_24h": Table("purchase_hour INT, total_revenue DECIMAL(24,2)"),
    "gold.top_converting_items": Table(
        "item_id BIGINT, item_name STRING, item_category STRING, unique_pageview_users BIGINT, "
        "unique_purchase_users BIGINT, total_purchases BIGINT, total_pageviews BIGINT, "
        "conversion_rate DOUBLE"
    ),
    "gold.pageviews_by_channel": Table("channel STRING, total_pageviews BIGINT"),
    "gold.user_engagement_segments": Table(
        "user_id BIGINT, email STRING, full_name STRING, total_pageviews BIGINT, "
        "active_days BIGINT, last_active_date DATE, days_since_last_active BIGINT, "
        "engagement_segment STRING, segment_date DATE",
        ("segment_date",),
    ),
    "rt.purchases": Table(
        "id BIGINT, user_id BIGINT, item_id BIGINT, campaign_id STRING, status SMALLINT, "
        "quantity INT, purchase_price DECIMAL(12,2), deleted BOOLEAN, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, log_position BIGINT, ingested_at TIMESTAMP",
        ("created_month",),
        {"created_month": "date_format(created_at, 'yyyyMM')"},
        log=True,
    ),
    # The newest version of every purchase up to a batch of the log. last_batch is the batch up to which a
    # bucket was folded when it was last rewritten, the greatest one that of the table.
    "rt.purchases_newest": _by_bucket(
        "id BIGINT, user_id BIGINT, item_id BIGINT, campaign_id STRING, status SMALLINT, "
        "quantity INT, purchase_price DECIMAL(12,2), deleted BOOLEAN, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, log_position BIGINT, last_batch BIGINT",
        "id",
    ),
    # What each fold adds to and takes from the sales of an hour and item.
    "rt.sales_changes": Table(
        "hour TIMESTAMP, item_id BIGINT, quantity BIGINT, revenue DECIMAL(38,2), purchases BIGINT", log=True
    ),
    # The sums of these changes up to a batch, the greatest through_batch.
    "rt.sales_sums": Table(
        "hour TIMESTAMP, item_id BIGINT, quantity BIGINT, revenue DECIMAL(38,2), purchases BIGINT, "
        "through_batch BIGINT",
        ("hour_month",),
        {"hour_month": "date_format(hour, 'yyyyMM')"},
    ),
    # The batch up to which the changes hold.
    "rt.sales_position": Table("batch BIGINT"),
    # No day partition: a batch replayed after midnight must land in the same place.
    "rt.purchases_errors": Table(
        "_error STRING, _raw_message STRING, ingested_at TIMESTAMP", log=True
    ),
    "rt.items": Table(
        "id BIGINT, name STRING, category STRING, price DECIMAL(10,2), inventory INT, "
        "created_at TIMESTAMP, updated_at TIMESTAMP, __op STRING, __table STRING, "
        "__source_ts_ms BIGINT, __deleted BOOLEAN, log_position BIGINT",
        log=True,
    ),
    "rt.items_errors": Table(
        "_error STRING, _raw_message STRING, ingested_at TIMESTAMP", log=True
    ),
    "rt.login_events_enriched": _by_day(
        "user_id STRING, timestamp TIMESTAMP, ip STRING, platform STRING, device_type STRING, "
        "country STRING, city STRING",
        "timestamp",
        "event_day",
        log=True,
    ),
    "rt.login_errors": Table(
        "_error STRING, _raw_message STRING, ingested_at TIMESTAMP", log=True
    ),
    # Anomalies of logins without a country, and of logins from a country new to their user.
    "rt.login_unknown": _by_day(
        "user_id STRING, timestamp TIMESTAMP, reason STRING, country STRING",
        "timestamp",
        "event_day",
        log=True,
    ),
    "rt.login_new_country": _by_day(
        "user_id STRING, timestamp TIMESTAMP, reason STRING, country STRING",
        "timestamp",
        "event_day",
        log=True,
    ),
    # Logins that came after the watermark had closed their second, and the batch of the log up to which they are known.
    "rt.login_late": _by_day(
        "user_id STRING, timestamp TIMESTAMP, ip STRING, platform STRING, device_type STRING, "
        "country STRING, city STRING",
        "timestamp",
        "event_day",
        log=True,
    ),
    "rt.login_late_position": Table("batch BIGINT"),
    # The closed seconds that later logins are compared with.
    "rt.login_cells": _by_day(
        "user_id STRING, country STRING, second TIMESTAMP, instants ARRAY<BIGINT>",
        "second",
        "event_day",
        log=True,
    ),
    "rt.reviews": _by_bucket(
        "review_id BIGINT, customer_name STRING, customer_email STRING, date DATE, review STRING, "
        "review_embedding ARRAY<FLOAT>",
        "review_id",
    ),
    # Embeddings made here, so that a few new ones do not rewrite all reviews.
    "rt.review_embeddings": Table("review_id BIGINT, embedding ARRAY<FLOAT>"),
}


# Casts between these types cannot fail.
WIDENING = {
    ("tinyint", "smallint"),
    ("tinyint", "int"),
    ("tinyint", "bigint"),
    ("smallint", "int"),
    ("smallint", "bigint"),
    ("int", "bigint"),
    ("float", "double"),
    ("date", "timestamp"),
    ("timestamp_ntz", "timestamp"),
}


def _may_not_fit(source: DataType, target: DataType) -> bool:
    if source == target or (source.simpleString(), target.simpleString()) in WIDENING:
        return False
    if isinstance(source, DecimalType) and isinstance(target, DecimalType):
        digits = target.precision - target.scale >= source.precision - source.scale
        return not (digits and target.scale >= source.scale)
    return True


def may_reject(df: DataFrame, name: str) -> bool:
    """Whether some value of ``df`` could fail to fit the declared types of a table."""
    return any(
        _may_not_fit(df.schema[c.name].dataType, c.dataType)
        for c in TABLES[name].schema
        if c.name in df.columns
    )


def conform(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """D-3: (rows in the declared columns and types, rows with a value that does not fit).

    Extra columns are dropped, missing ones become NULL. The second frame holds the rows as JSON.
    """
    misfit = F.lit(False)
    columns: list[Column] = []
    for column in TABLES[name].schema:
        kind = column.dataType.simpleString()
        if column.name not in df.columns:
            columns.append(F.lit(None).cast(kind).alias(column.name))
            continue
        fitted = F.col(column.name).try_cast(kind)
        columns.append(fitted.alias(column.name))
        if _may_not_fit(df.schema[column.name].dataType, column.dataType):
            misfit = misfit | (F.col(column.name).isNotNull() & fitted.isNull())
    refused = df.filter(misfit).select(
        F.lit(name).alias("table_name"),
        F.to_json(F.struct("*")).alias("raw_record"),
        F.current_timestamp().alias("ingested_at"),
    )
    return df.filter(~misfit).select(*columns), refused
