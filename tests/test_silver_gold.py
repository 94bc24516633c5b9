"""Edge rows of the silver and gold operators, and the funnel against a row-level join."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions import cleaning
from millrace.operators import gold, segments, silver

T = dt.datetime(2024, 1, 5, 13, 30)


def test_users(spark):
    rows = [
        (1, "A", "B", None),
        (2, None, "B", "a@b"),
        (3, "A", None, "a.b+c@x.co"),
        (4, None, None, "x@y.zz"),
    ]
    df = spark.createDataFrame(
        [r + (T, T) for r in rows],
        "id long, first_name string, last_name string, email string, "
        "created_at timestamp, updated_at timestamp",
    )
    got = {r.id: (r.valid_email, r.full_name) for r in silver.users(df).collect()}
    assert got == {1: (None, "A B"), 2: (False, "B"), 3: (True, "A"), 4: (True, "")}


def test_items(spark):
    prices = {1: "-0.01", 2: "0", 3: None, 4: "99999.99"}
    categories = {1: None, 2: "mIx", 3: "toys", 4: ""}
    df = spark.createDataFrame(
        [
            (i, "n", categories[i], None if p is None else Decimal(p), 1, T, T)
            for i, p in prices.items()
        ],
        "id long, name string, category string, price decimal(7,2), inventory int, "
        "created_at timestamp, updated_at timestamp",
    )
    got = {r.id: (r.price, r.category) for r in silver.items(df).collect()}
    assert got == {
        1: (Decimal("0.00"), None),
        2: (Decimal("0.00"), "MIX"),
        3: (None, "TOYS"),
        4: (Decimal("99999.99"), ""),
    }


def test_urls(spark):
    urls = {
        "/home": ("", None),
        "/products/12": ("products", 12),
        "/a/b/12": ("", 12),
        "http://h/products/12": ("", 12),
        "/products/": ("", None),
        "": ("", None),
        "/products/" + "9" * 30: ("products", None),
    }
    df = spark.createDataFrame([(u,) for u in urls] + [(None,)], "url string")
    got = {
        r.url: (r.page, r.item)
        for r in df.select(
            "url",
            cleaning.page_of(F.col("url")).alias("page"),
            cleaning.item_id_of(F.col("url")).alias("item"),
        ).collect()
    }
    assert got == {**urls, None: (None, None)}


def purchases(spark, rows):
    return spark.createDataFrame(
        rows,
        "id long, user_id long, item_id long, quantity int, purchase_price decimal(12,2), "
        "created_at timestamp, updated_at timestamp",
    )


def test_enrichment_keeps_unmatched_and_fans_out(spark):
    users = spark.createDataFrame([(1, "u@x.yy")], "id long, email string")
    items = spark.createDataFrame(
        [(7, "old", "toys"), (7, "new", "toys")], "id long, name string, category string"
    )
    bought = purchases(
        spark,
        [
            (1, 1, 7, 2, Decimal("1.50"), T, T),
            (2, 99, 8, 1, Decimal("2.00"), T, T),
            (3, None, None, None, Decimal("2.00"), T, T),
        ],
    )
    got = sorted(
        (r.id, r.user_email or "", r.item_name or "", r.total_price, r.purchase_hour)
        for r in silver.purchases_enriched(bought, users, items).collect()
    )
    assert got == [
        (1, "u@x.yy", "new", Decimal("3.00"), 13),
        (1, "u@x.yy", "old", Decimal("3.00"), 13),
        (2, "", "", Decimal("2.00"), 13),
        (3, "", "", None, 13),
    ]


def funnel_inputs(spark):
    """A third of all views share one item, user and day; keys may be NULL."""
    rng = random.Random(5)
    day = lambda: dt.datetime(2024, 1, rng.randint(1, 3), rng.randint(0, 23))
    views, bought = [], []
    for i in range(900):
        hot = i % 3 == 0
        user = 1 if hot else rng.choice([None, 1, 2, 3, 4])
        item = 1 if hot else rng.randint(1, 6)
        views.append((user, item, f"name{item % 4}", "c", T if hot else day()))
    views.append((5, 2, "other name", None, T))
    for i in range(300):
        hot = i % 3 == 0
        bought.append(
            (
                None if i % 7 == 0 else i,
                1 if hot else rng.choice([None, 1, 2, 3]),
                1 if hot else rng.randint(1, 8),
                (T if hot else day()).date(),
            )
        )
    return (
        spark.createDataFrame(
            views,
            "user_id long, item_id long, item_name string, item_category string, "
            "received_at timestamp",
        ),
        spark.createDataFrame(
            bought, "id long, user_id long, item_id long, purchase_date date"
        ),
    )


def test_funnel_equals_row_level_join(spark):
    views, bought = funnel_inputs(spark)
    joined = views.alias("v").join(
        bought.alias("p"),
        (F.col("v.item_id") == F.col("p.item_id"))
        & (F.col("v.user_id") == F.col("p.user_id"))
        & (F.to_date("v.received_at") == F.col("p.purchase_date")),
        "left",
    )
    for distinct in (False, True):
        viewers = F.countDistinct("v.user_id") if distinct else F.count(F.lit(1))
        buyers = F.countDistinct("p.user_id") if distinct else F.count(F.lit(1))
        expected = joined.groupBy("v.item_id", "item_name", "item_category").agg(
            viewers.alias("unique_pageview_users"),
            buyers.alias("unique_purchase_users"),
            F.count("p.id").alias("total_purchases"),
            F.count("v.user_id").alias("total_pageviews"),
        )
        rate = cleaning.conversion_rate(F.col("total_purchases"), F.col("total_pageviews"))
        expected = expected.withColumn("conversion_rate", rate)
        got = gold.top_converting_items(views, bought, distinct_users=distinct)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_item_without_known_viewer_has_rate_zero(spark):
    views, bought = funnel_inputs(spark)
    only_unknown = views.filter("user_id IS NULL")
    rows = gold.top_converting_items(only_unknown, bought).collect()
    assert rows
    assert {(r.total_pageviews, r.total_purchases, r.conversion_rate) for r in rows} == {(0, 0, 0.0)}


def test_segment_borders(spark):
    day = dt.date(2024, 1, 31)
    cases = {  # id: (views, days since the last one, expected)
        1: (0, None, "low_engagement"),
        2: (9, 0, "low_engagement"),
        3: (10, 7, "medium_engagement"),
        4: (10, 8, "low_engagement"),
        5: (49, 0, "medium_engagement"),
        6: (50, 3, "high_engagement"),
        7: (50, 4, "low_engagement"),
    }
    users = [(i, f"u{i}@x.yy", "n", True) for i in cases]
    users += [(8, "u8@x.yy", "n", False), (9, "u9@x.yy", "n", None)]
    users += [(3, "u3@x.yy", "second name", True)]
    views = []
    for user, (count, idle, _) in cases.items():
        for i in range(count):
            last = dt.datetime.combine(day - dt.timedelta(days=idle), dt.time(12))
            views.append((user, "products", last - dt.timedelta(days=i % 2)))
    people = spark.createDataFrame(
        users, "id long, email string, full_name string, valid_email boolean"
    )
    seen = spark.createDataFrame(views, "user_id long, page string, received_at timestamp")
    rows = segments.user_engagement_segments(people, seen, str(day)).collect()
    got = {(r.user_id, r.full_name): r for r in rows}
    for user, (count, idle, expected) in cases.items():
        row = got[user, "n"]
        assert row.engagement_segment == expected
        assert (row.total_pageviews, row.days_since_last_active) == (count, idle)
        assert row.active_days == min(count, 2)
        assert row.segment_date == day
    assert got[3, "second name"].total_pageviews == 10
    assert {user for user, _ in got} == set(cases)


def test_copies_of_a_user_multiply_views(spark):
    people = spark.createDataFrame(
        [(1, "a@b.cc", "n", True)] * 3, "id long, email string, full_name string, valid_email boolean"
    )
    seen = spark.createDataFrame(
        [(1, "p", T), (1, None, T)], "user_id long, page string, received_at timestamp"
    )
    (row,) = segments.user_engagement_segments(people, seen, "2024-01-06").collect()
    assert (row.total_pageviews, row.active_days, row.days_since_last_active) == (3, 1, 1)
