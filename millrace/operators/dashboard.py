"""Live sales numbers over the newest version of every purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

NEEDED = ["id", "item_id", "quantity", "purchase_price", "deleted", "created_at"]

_REVENUE = "sum(quantity * purchase_price)"


def since(as_of: str) -> str:
    """The time 24 hours before ``as_of``."""
    return str(dt.datetime.fromisoformat(as_of) - dt.timedelta(hours=24))


def hourly_sales(purchases: DataFrame, as_of: str) -> DataFrame:
    """A-6, P-15, P-17, T-1: the 24 hours up to ``as_of``, by hour."""
    return (
        purchases.filter(~F.col("deleted") & (F.col("created_at") >= F.lit(since(as_of)).cast("timestamp")))
        .groupBy(F.date_trunc("hour", "created_at").alias("hour"))
        .agg(F.sum("quantity").alias("total_sales"), F.expr(_REVENUE).alias("total_revenue"))
        .orderBy("hour")
    )


def top_products(purchases: DataFrame, n: int = 10) -> DataFrame:
    """A-7, T-2: ties go to the smaller item id."""
    return (
        purchases.filter(~F.col("deleted"))
        .groupBy("item_id")
        .agg(F.sum("quantity").alias("total_quantity"), F.expr(_REVENUE).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "item_id")
        .limit(n)
    )


def kpis(purchases: DataFrame) -> DataFrame:
    """A-8."""
    return purchases.filter(~F.col("deleted")).agg(
        F.sum("quantity").alias("total_items_sold"),
        F.expr(_REVENUE).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
    )
