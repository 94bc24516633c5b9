"""The shop's inputs derived from the driver's tables (shapes F-1 .. F-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The geo prefix rows.
GEO_ROWS = [
    ("192.168.1", "UK", "London"),
    ("203.0.113", "US", "New York"),
    ("10.0.0", "DE", "Berlin"),
]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; timestamps without zone are read as UTC timestamps."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    plain = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})


def _with_k(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    """F-1."""
    return load(spark, folder, "customer").selectExpr(
        "c_custkey AS id",
        "split_part(c_name, '#', 1) AS first_name",
        "CASE WHEN c_custkey % 19 = 3 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name",
        "CASE WHEN c_custkey % 10 = 7 THEN NULL "
        "WHEN c_custkey % 13 = 5 THEN concat('bad-address-', c_custkey) "
        "ELSE concat('user', c_custkey, '@example.com') END AS email",
        "TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS created_at",
        "TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS updated_at",
    )


def user_versions(spark: SparkSession, folder: str) -> DataFrame:
    """F-1 with a second, newer version of every third user."""
    return (
        users(spark, folder)
        .selectExpr("*", "explode(IF(id % 3 = 0, array(1, 2), array(1))) AS version")
        .selectExpr(
            "id",
            "first_name",
            "last_name",
            "IF(version = 2, concat('new', id, '@example.com'), email) AS email",
            "created_at",
            "updated_at + make_dt_interval(version - 1) AS updated_at",
        )
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """F-2, with creation times so that the item tables are complete."""
    return load(spark, folder, "part").selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "lower(p_type) AS category",
        "CAST(CASE WHEN p_partkey % 17 = 0 THEN -1.0 WHEN p_partkey % 23 = 4 THEN NULL "
        "ELSE p_retailprice END AS DECIMAL(7,2)) AS price",
        "p_size * 100 AS inventory",
        "TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '1' MINUTE AS created_at",
        "TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '1' MINUTE AS updated_at",
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """F-3: order lines."""
    lines = load(spark, folder, "lineitem")
    orders = load(spark, folder, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id",
        "o_custkey AS user_id",
        "l_partkey AS item_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS purchase_price",
        "o_orderdate AS created_at",
        "o_orderdate AS updated_at",
    )


def purchase_events(spark: SparkSession, folder: str) -> DataFrame:
    """F-3b: purchases with a time of day."""
    bought = load(spark, folder, "events").filter("event_type = 'purchase'")
    return _with_k(bought).selectExpr(
        "event_id AS id",
        "user_id",
        "CAST(k % 20 AS BIGINT) AS item_id",
        "CAST(1 + event_id % 5 AS INT) AS quantity",
        "CAST(value AS DECIMAL(12,2)) AS purchase_price",
        "ts AS created_at",
        "ts AS updated_at",
    )


def pageviews(spark: SparkSession, folder: str) -> DataFrame:
    """F-4: received_at in epoch seconds."""
    seen = load(spark, folder, "events").filter("event_type IN ('view', 'click')")
    return _with_k(seen).selectExpr(
        "user_id",
        "CASE event_id % 11 WHEN 0 THEN '/home' "
        "WHEN 1 THEN concat('http://example.com/products/', k % 20) "
        "ELSE concat('/products/', k % 20) END AS url",
        "CASE event_id % 5 WHEN 0 THEN 'organic search' WHEN 1 THEN 'paid search' "
        "WHEN 2 THEN 'referral' WHEN 3 THEN 'social' ELSE 'display' END AS channel",
        "unix_seconds(ts) AS received_at",
    )


def pageviews_for_segments(spark: SparkSession, folder: str) -> DataFrame:
    """F-4b."""
    return (
        load(spark, folder, "events")
        .filter(
            "event_id % 10 <= user_id % 10 "
            "AND (user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-20 00:00:00')"
        )
        .selectExpr("user_id", "'products' AS page", "ts AS received_at")
    )


def purchase_changes(spark: SparkSession, folder: str) -> DataFrame:
    """F-5: two versions of some purchases, some of them undecodable."""
    bought = _with_k(load(spark, folder, "events").filter("event_type = 'purchase'"))
    # One pass over the events: each row yields its first and, for some, its second version.
    return bought.selectExpr(
        "*", "explode(IF(event_id % 3 = 0, array(1, 2), array(1))) AS version"
    ).selectExpr(
        "event_id AS id",
        "CASE WHEN event_id % 20 = 5 THEN NULL ELSE user_id END AS user_id",
        "CAST(k % 20 AS BIGINT) AS item_id",
        "CASE WHEN version = 2 THEN 'BOGO23' WHEN event_id % 4 = 0 THEN NULL "
        "ELSE 'FLASH2025' END AS campaign_id",
        "CASE WHEN version = 2 THEN 2 WHEN event_id % 6 = 1 THEN NULL ELSE 1 END AS status",
        "CAST(event_id % 5 + version AS INT) AS quantity",
        "value AS purchase_price",
        "version = 2 AND event_id % 9 = 0 AS deleted",
        "unix_micros(ts) AS created_at",
        "unix_micros(ts) + (version - 1) * 3600000000 AS updated_at",
        "CASE WHEN version = 1 AND event_id % 50 = 7 THEN 'decode error' ELSE '' END AS _error",
        "CASE WHEN version = 1 AND event_id % 50 = 7 THEN concat('message ', event_id) ELSE '' END "
        "AS _raw_message",
    )


def item_changes(spark: SparkSession, folder: str) -> DataFrame:
    """F-6: snapshot, update and delete rows of items."""
    return (
        load(spark, folder, "part")
        .selectExpr(
            "*",
            "explode(filter(array("
            "struct('r' AS op, 'false' AS deleted, 1000L AS ts_ms, 1 AS every), "
            "struct('u' AS op, 'false' AS deleted, 2000L AS ts_ms, 5 AS every), "
            "struct('d' AS op, 'true' AS deleted, 3000L AS ts_ms, 10 AS every)), "
            "c -> p_partkey % c.every = 0)) AS change",
        )
        .selectExpr(
            "p_partkey AS id",
            "CASE WHEN change.op = 'u' THEN concat(p_name, ' v2') ELSE p_name END AS name",
            "lower(p_type) AS category",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
            "p_size * 100 AS inventory",
            "change.op AS __op",
            "'items' AS __table",
            "change.ts_ms AS __source_ts_ms",
            "change.deleted AS __deleted",
        )
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    """F-7."""
    return _with_k(load(spark, folder, "events")).selectExpr(
        "event_id",
        "concat('user_', user_id) AS user_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS timestamp",
        "concat(CASE k % 5 WHEN 0 THEN '192.168.1.' WHEN 1 THEN '203.0.113.' "
        "WHEN 2 THEN '10.0.0.' WHEN 3 THEN '198.51.100.' ELSE '8.8.8.' END, event_id % 200) AS ip",
        "CASE event_id % 4 WHEN 0 THEN 'iPhone 15' WHEN 1 THEN 'Samsung Galaxy' "
        "WHEN 2 THEN 'MacBook Pro' ELSE 'Windows Laptop' END AS device",
        "CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform",
        "'Mozilla/5.0' AS user_agent",
    )


def geo(spark: SparkSession) -> DataFrame:
    """The geo prefix rows."""
    return spark.createDataFrame(GEO_ROWS, "ip_prefix STRING, country STRING, city STRING")


def many_prefixes(events: DataFrame) -> DataFrame:
    """A prefix for every address that logins came from, and one for its first seven characters."""
    return (
        events.select(F.explode(F.array("ip", F.substring("ip", 1, 7))).alias("ip_prefix"))
        .distinct()
        .selectExpr("ip_prefix", "concat('c', length(ip_prefix)) AS country", "ip_prefix AS city")
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews that still lack an embedding."""
    return load(spark, folder, "documents").selectExpr(
        "doc_id AS review_id",
        "source AS customer_name",
        "CAST(NULL AS STRING) AS customer_email",
        "CAST(NULL AS DATE) AS date",
        "text AS review",
        "CAST(NULL AS ARRAY<FLOAT>) AS review_embedding",
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Stored embeddings as reviews."""
    return load(spark, folder, "embeddings").selectExpr(
        "vec_id AS review_id", "label", "embedding AS review_embedding"
    )
