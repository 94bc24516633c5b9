"""Cleaned and enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import cleaning


def users(bronze_users: DataFrame) -> DataFrame:
    """P-1, P-2."""
    return bronze_users.select(
        "id",
        "first_name",
        "last_name",
        "email",
        "created_at",
        "updated_at",
        cleaning.is_valid_email(F.col("email")).alias("valid_email"),
        cleaning.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
    )


def items(bronze_items: DataFrame) -> DataFrame:
    """P-3, P-4."""
    return bronze_items.select(
        "id",
        "name",
        F.upper("category").alias("category"),
        cleaning.floor_at_zero(F.col("price")).cast("decimal(7,2)").alias("price"),
        "inventory",
        "created_at",
        "updated_at",
    )


def purchases_enriched(
    bronze_purchases: DataFrame, bronze_users: DataFrame, bronze_items: DataFrame
) -> DataFrame:
    """J-1, P-5. Every version of a user or item row fans out; item_category keeps its casing.

    Only the looked-up columns of both dimensions travel. Whether a dimension is broadcast is
    decided by its measured size; otherwise a hot user or item is split by the adaptive skew
    join, which ``session.prepare`` allows also where what follows then shuffles again.
    """
    buyers = bronze_users.select(F.col("id").alias("_user"), F.col("email").alias("user_email"))
    goods = bronze_items.select(
        F.col("id").alias("_item"),
        F.col("name").alias("item_name"),
        F.col("category").alias("item_category"),
    )
    return (
        bronze_purchases.join(buyers, F.col("user_id") == F.col("_user"), "left")
        .join(goods, F.col("item_id") == F.col("_item"), "left")
        .select(
            "id",
            "user_id",
            "item_id",
            "quantity",
            "purchase_price",
            (F.col("quantity") * F.col("purchase_price"))
            .cast("decimal(14,2)")
            .alias("total_price"),
            "user_email",
            "item_name",
            "item_category",
            F.to_date("created_at").alias("purchase_date"),
            F.hour("created_at").alias("purchase_hour"),
            "created_at",
            "updated_at",
        )
    )


def pageviews_by_items(bronze_pageviews: DataFrame, bronze_items: DataFrame) -> DataFrame:
    """P-6, P-7, J-2: views whose URL ends in an item id, with the item's name and category."""
    goods = bronze_items.select(
        F.col("id").alias("_item"),
        F.col("name").alias("item_name"),
        F.col("category").alias("item_category"),
    )
    return (
        bronze_pageviews.select(
            "user_id",
            cleaning.item_id_of(F.col("url")).alias("item_id"),
            cleaning.page_of(F.col("url")).alias("page"),
            "channel",
            "received_at",
        )
        .filter(F.col("item_id").isNotNull())
        .join(goods, F.col("item_id") == F.col("_item"), "left")
        .select(
            "user_id", "item_id", "page", "item_name", "item_category", "channel", "received_at"
        )
    )
