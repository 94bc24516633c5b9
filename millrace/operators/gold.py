"""Aggregates over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import cleaning


def top_selling_items(purchases: DataFrame) -> DataFrame:
    """A-1: revenue per item, unordered and unlimited."""
    return purchases.groupBy("item_id", "item_name", "item_category").agg(
        F.sum("total_price").alias("total_revenue")
    )


def top_items(selling: DataFrame, n: int = 10) -> DataFrame:
    """T-3: the n best sellers; ties go to the smaller item id, then name and category."""
    return selling.orderBy(
        F.col("total_revenue").desc_nulls_last(), "item_id", "item_name", "item_category"
    ).limit(n)


def sales_by_hour(purchases: DataFrame) -> DataFrame:
    """A-2: revenue per hour of day over all time."""
    return purchases.groupBy("purchase_hour").agg(F.sum("total_price").alias("total_revenue"))


def pageviews_by_channel(pageviews: DataFrame) -> DataFrame:
    """A-3."""
    return pageviews.groupBy("channel").agg(F.count(F.lit(1)).alias("total_pageviews"))


def top_converting_items(
    pageviews: DataFrame, purchases: DataFrame, distinct_users: bool = False
) -> DataFrame:
    """J-3, A-4, P-18: the funnel per item, views joined to purchases of the same user and day.

    All columns count rows of that join. It is not run row by row: both sides are first counted
    per (item, user, day), and a view count times a purchase count is the number of joined rows,
    so a hot item, user or day collapses before the shuffle and no pairs are produced.
    ``distinct_users`` counts users instead of joined rows in the two ``unique_`` columns (D-1).
    """
    item = ["item_id", "item_name", "item_category"]
    views = pageviews.groupBy(*item, "user_id", F.to_date("received_at").alias("day")).agg(
        F.count(F.lit(1)).alias("views")
    )
    bought = purchases.groupBy("item_id", "user_id", F.col("purchase_date").alias("day")).agg(
        F.count(F.lit(1)).alias("matches"), F.count("id").alias("purchases")
    )
    matched = views.join(bought, ["item_id", "user_id", "day"], "left").select(
        *item,
        "user_id",
        (F.col("views") * F.coalesce("matches", F.lit(1))).alias("rows"),
        (F.col("views") * F.coalesce("purchases", F.lit(0))).alias("purchases"),
        F.col("matches").isNotNull().alias("buyer"),
    )
    per_user = matched.groupBy(*item, "user_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("purchases").alias("purchases"),
        F.max("buyer").alias("buyer"),
    )
    known = F.col("user_id").isNotNull()
    if distinct_users:
        source = per_user
        viewers = F.count("user_id")
        buyers = F.count(F.when(F.col("buyer"), F.col("user_id")))
    else:
        source = matched
        viewers = buyers = F.sum("rows")
    totals = source.groupBy(*item).agg(
        viewers.alias("unique_pageview_users"),
        buyers.alias("unique_purchase_users"),
        F.sum("purchases").alias("total_purchases"),
        F.sum(F.when(known, F.col("rows")).otherwise(F.lit(0))).alias("total_pageviews"),
    )
    rate = cleaning.conversion_rate(F.col("total_purchases"), F.col("total_pageviews"))
    return totals.withColumn("conversion_rate", rate)
