"""Sales per hour and item, kept as sums of signed changes, and the dashboards over them (A-6 to A-8).

A fold of the change log (``streaming.changes.keep_newest``) writes what it takes from and adds to an hour and item.
The sums of all changes are the sales of the newest versions, whatever came and went in between, so a question
reads neither purchases nor their log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators import dashboard
from millrace.tables import Store

CHANGES, SUMS, POSITION = "rt.sales_changes", "rt.sales_sums", "rt.sales_position"
KEYS, VALUES = ["hour", "item_id"], ["quantity", "revenue", "purchases"]


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in VALUES])


def signed_changes(changed: DataFrame) -> DataFrame:
    """(hour, item_id, quantity, revenue, purchases) from rows with a purchase's version before (``old``, may be
    NULL) and after (``now``). Deleted versions and those that are not there count nothing (P-15)."""

    def part(version: str, sign: int) -> Column:
        def value(name: str) -> Column:
            return F.col(f"{version}.{name}")

        return F.struct(
            (F.col(version).isNotNull() & ~value("deleted")).alias("live"),
            F.date_trunc("hour", value("created_at")).alias("hour"),
            value("item_id").alias("item_id"),
            (F.lit(sign) * value("quantity").cast("bigint")).alias("quantity"),
            (F.lit(sign) * value("quantity") * value("purchase_price")).cast("decimal(38,2)").alias("revenue"),
            F.lit(sign).cast("bigint").alias("purchases"),
        )

    parts = changed.select(F.explode(F.array(part("old", -1), part("now", 1))).alias("part"))
    sums = _summed(parts.filter("part.live").select("part.*"), *KEYS)
    return sums.filter(" OR ".join(f"{v} <> 0" for v in VALUES))


def set_position(store: Store, batch: int) -> None:
    if position(store) != batch:
        store.write(store.spark.range(1).select(F.lit(batch).alias("batch")), POSITION, mode="replace")


def position(store: Store) -> int | None:
    """The batch up to which changes count."""
    return store.read(POSITION).agg(F.max("batch")).first()[0] if store.exists(POSITION) else None


def _open_changes(store: Store) -> DataFrame:
    """Changes that count and are not in the sums yet."""
    rows = store.read(CHANGES).filter(F.col("batch_id") <= F.lit(position(store)))
    summed = store.read(SUMS).agg(F.max("through_batch")).first()[0] if store.exists(SUMS) else None
    return rows if summed is None else rows.filter(F.col("batch_id") > summed)


def sales(store: Store, since: dt.datetime | None = None) -> DataFrame:
    """(hour, item_id, quantity, revenue, purchases) of the newest versions as of the last fold. Hours and items
    whose purchases were all taken back stay, with zeros. ``since`` leaves out earlier hours, and the sums' months
    before it are not read."""
    rows = _open_changes(store).select(*KEYS, *VALUES)
    if store.exists(SUMS):
        sums = store.read(SUMS)
        if since is not None and not store.catalog:
            sums = sums.filter(F.col("hour_month") >= f"{since:%Y%m}")
        rows = rows.unionByName(sums.select(*KEYS, *VALUES))
    if since is not None:
        rows = rows.filter(F.col("hour") >= F.lit(str(since)).cast("timestamp"))
    return _summed(rows, *KEYS)


def fold_sales(store: Store) -> int:
    """Add the changes so far to the sums, so that questions need not add them up; only the months they touch are
    read and rewritten, all at once. Returns the number of rows written."""
    rows = _open_changes(store)
    months = F.date_format("hour", "yyyyMM")
    last = rows.agg(F.max("batch_id")).first()[0]
    if last is None:
        return 0
    parts = rows.select(*KEYS, *VALUES)
    if store.exists(SUMS):
        touched = [row.month for row in rows.select(months.alias("month")).distinct().collect()]  # as many as months
        month = months if store.catalog else F.col("hour_month")
        parts = parts.unionByName(store.read(SUMS).filter(month.isin(touched)).select(*KEYS, *VALUES))
    return store.write(_summed(parts, *KEYS).withColumn("through_batch", F.lit(last)), SUMS, mode="overwrite")


def _live(rows: DataFrame) -> DataFrame:
    return rows.filter("purchases > 0").withColumn("revenue", F.col("revenue").cast("decimal(33,2)"))


def hourly_sales(store: Store, as_of: str, newest: DataFrame | None = None) -> DataFrame:
    """A-6, P-17, T-1. If the 24 hours begin within an hour, that hour is summed from ``newest`` purchases."""
    since = dt.datetime.fromisoformat(dashboard.since(as_of))
    whole = since.replace(minute=0, second=0, microsecond=0)
    if whole < since:
        whole += dt.timedelta(hours=1)
    start = F.lit(str(whole)).cast("timestamp")
    rows = _live(_summed(sales(store, whole), "hour"))
    rows = rows.select("hour", F.col("quantity").alias("total_sales"), F.col("revenue").alias("total_revenue"))
    if whole > since:
        if newest is None:
            raise ValueError("the 24 hours begin within an hour: give the newest purchases")
        rows = rows.unionByName(dashboard.hourly_sales(newest.filter(F.col("created_at") < start), as_of))
    return rows.orderBy("hour")


def top_products(store: Store, n: int = 10) -> DataFrame:
    """A-7, T-2: ties go to the smaller item id."""
    rows = _live(_summed(sales(store), "item_id"))
    return (
        rows.select("item_id", F.col("quantity").alias("total_quantity"), F.col("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "item_id")
        .limit(n)
    )


def kpis(store: Store) -> DataFrame:
    """A-8; sums are NULL if no purchase stands."""
    rows = _summed(sales(store))
    some = F.col("purchases") > 0
    return rows.select(
        F.when(some, F.col("quantity")).alias("total_items_sold"),
        F.when(some, F.col("revenue").cast("decimal(33,2)")).alias("total_revenue"),
        F.coalesce("purchases", F.lit(0)).cast("bigint").alias("total_transactions"),
    )
