"""Plans: what is pushed down, pruned, split and never done."""

from __future__ import annotations

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import SCALES
from millrace.operators import gold, logins, silver
from millrace.plans import jobs
from millrace.plans import queries as registry
from millrace.tables import Store

FOLDER = f"{SCALES}/sf0.001"
QUERIES = registry.registered()


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(df):
    """Plan after execution, without the parts that were replaced on the way."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


LAZY = [
    name
    for name in QUERIES
    if not name.endswith("_stream")
    and name
    not in (
        "segments_export",
        "incremental_ingest",
        "pageviews_dlq",
        "similar_reviews_top5",
        "embedding_write_back",
        "rejected_rows",
        "full_run_gold",
        "full_run_quality",
        "segments_job",
        "pageviews_source_files",
    )
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_or_cross_joins(spark, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = planned(QUERIES[name](spark, FOLDER))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_needed_columns_are_read(spark):
    plan = planned(QUERIES["top_selling_items"](spark, FOLDER))
    assert "l_tax" not in plan and "o_totalprice" not in plan and "c_acctbal" not in plan
    plan = planned(QUERIES["kpis"](spark, FOLDER))
    assert "campaign_id" not in plan.split("ReadSchema: ")[-1].split("\n")[0]


def test_filters_reach_the_scan(spark):
    for name in ("sales_by_hour", "pageviews_by_channel"):
        assert "PushedFilters: [" in planned(QUERIES[name](spark, FOLDER))
        assert "event_type" in planned(QUERIES[name](spark, FOLDER)).split("PushedFilters: [")[1]


@pytest.mark.parametrize("name", ["top_products", "top_selling_items_top10", "similar_vectors_top5"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in planned(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_join_key_is_split(spark, tmp_path, hot):
    """A third of all purchases share an item (or have none); their partition must be divided."""
    rows = spark.range(300_000).select(
        F.col("id"),
        (F.col("id") % 1000).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 1000).alias("item_id"),
        F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(12,2)").alias("purchase_price"),
        F.lit(dt.datetime(2024, 1, 1)).alias("created_at"),
        F.lit(dt.datetime(2024, 1, 1)).alias("updated_at"),
    )
    users = spark.range(1000).select("id", F.lit("e").alias("email"))
    items = spark.range(1000).select("id", F.lit("n").alias("name"), F.lit("c").alias("category"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="40",
        adaptive__advisoryPartitionSizeInBytes="200KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="300KB",
    ):
        df = silver.purchases_enriched(rows, users, items)
        plan = run(df)
        assert "skew=true" in plan
        assert df.count() == 300_000


def test_a_hot_item_is_split_below_an_item_aggregate(spark, tmp_path):
    """The same rows below the best sellers, whose aggregate has the join's key."""
    rows = spark.range(300_000).select(
        F.col("id"),
        (F.col("id") % 1000).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("item_id"),
        F.lit(1).alias("quantity"),
        (F.rand(1) * 1000).cast("decimal(12,2)").alias("purchase_price"),
        F.lit(dt.datetime(2024, 1, 1)).alias("created_at"),
        F.lit(dt.datetime(2024, 1, 1)).alias("updated_at"),
    )
    users = spark.range(1000).select("id", F.lit("e").alias("email"))
    items = spark.range(1000).select("id", F.lit("n").alias("name"), F.lit("c").alias("category"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="40",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="30KB",
    ):
        assert "skew=true" in run(gold.top_selling_items(silver.purchases_enriched(rows, users, items)))


def test_the_newest_24_hours_prune_the_kept_sums(spark):
    plan = planned(QUERIES["hourly_sales_24h"](spark, FOLDER))
    assert "PartitionFilters: [isnotnull(hour_month" in plan


def test_anomaly_windows_are_bounded_in_time(spark):
    """One user over two years: the windows must run on many groups, not on one."""
    rows = spark.range(2000).select(
        F.lit("u").alias("user_id"),
        F.lit("UK").alias("country"),
        F.timestamp_seconds(F.col("id") * 31_536).alias("timestamp"),
    )
    df = logins.login_anomalies(rows)
    assert "_bucket" in planned(df).split("Window [")[1].split("\n")[0]
    assert df.count() == 1


def test_since_reads_and_replaces_only_those_days(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    stamp = lambda day: dt.datetime(2024, 1, day, 12)

    def bought(rows):
        return spark.createDataFrame(
            [(i, 1, 1, 1, 2, stamp(day), stamp(day), stamp(day)) for i, day in rows],
            "id long, user_id long, item_id long, quantity int, purchase_price int, "
            "created_at timestamp, updated_at timestamp, ingested_at timestamp",
        )

    store.ensure("bronze")
    store.write(bought([(1, 1), (2, 2), (3, 3)]), "bronze.purchases")
    jobs.build_silver(store)
    store.write(bought([(4, 1), (5, 3)]), "bronze.purchases")
    assert jobs.build_silver(store, since="2024-01-02")["purchases_enriched"] == 3
    ids = sorted(r.id for r in store.read("silver.purchases_enriched").collect())
    assert ids == [1, 2, 3, 5]  # day 1 was left alone
    plan = planned(store.read("bronze.purchases", since="2024-01-02"))
    assert "PartitionFilters: [isnotnull(created_day" in plan
    with pytest.raises(ValueError):
        store.read("bronze.items", since="2024-01-02")
