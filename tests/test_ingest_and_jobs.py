"""Tables, ingest streams, relational loads and whole jobs."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import changes, dashboard
from millrace.plans import jobs
from millrace.sources import relational
from millrace.sources.files import read_geo
from millrace.streaming import changes as change_streams
from millrace.streaming import sales
from millrace.streaming.pageviews import ingest_pageviews
from millrace.tables import Store, iceberg_ddl

T = dt.datetime(2024, 1, 5, 13, 30)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"{tmp_path}/store")


def items(spark, rows):
    return spark.createDataFrame(
        [(i, "n", category, Decimal(price), 1, T, updated) for i, category, price, updated in rows],
        "id int, name string, category string, price decimal(10,2), inventory int, "
        "created_at timestamp, updated_at timestamp",
    )


def test_write_modes(spark, store):
    with pytest.raises(FileNotFoundError):
        store.read("silver.items")
    first = items(spark, [(1, "toys", "1.00", T), (2, "books", "2.00", T), (3, "", "3.00", T)])
    assert store.write(first, "silver.items") == 3
    store.write(items(spark, [(4, "toys", "4.00", T), (5, None, "5.00", T)]), "silver.items")
    seen = {r.id: r.category for r in store.read("silver.items").collect()}
    assert seen == {1: "toys", 2: "books", 3: "", 4: "toys", 5: None}

    store.write(items(spark, [(6, "toys", "6.00", T)]), "silver.items", "overwrite")
    assert {r.id for r in store.read("silver.items").collect()} == {2, 3, 5, 6}

    assert store.write(first.limit(0), "silver.items") == 0

    kept = store.read("silver.items").filter("id <> 2")
    store.write(kept, "silver.items", "replace")
    assert {r.id for r in store.read("silver.items").collect()} == {3, 5, 6}
    with pytest.raises(ValueError):
        store.write(kept, "silver.items", "upsert")


def test_unpartitioned_overwrite_replaces_all(spark, store):
    for total in (1, 2):
        df = spark.createDataFrame([("social", total)], "channel string, total_pageviews long")
        store.write(df, "gold.pageviews_by_channel", "overwrite")
    assert [tuple(r) for r in store.read("gold.pageviews_by_channel").collect()] == [("social", 2)]


def test_batches_are_idempotent(spark, store):
    def batch(n, rows):
        df = spark.createDataFrame(rows, "_error string, _raw_message string, ingested_at timestamp")
        store.write(df, "rt.purchases_errors", batch_id=n)

    batch(0, [("e", "a", T)])
    batch(1, [("e", "b", T)])
    batch(1, [("e", "b", T + dt.timedelta(days=1))])
    assert sorted(r._raw_message for r in store.read("rt.purchases_errors").collect()) == ["a", "b"]


def test_declared_tables(spark, store):
    counts = {layer: len(store.ensure(layer)) for layer in ("bronze", "silver", "gold")}
    assert counts == {"bronze": 7, "silver": 9, "gold": 5}
    assert store.read("gold.top_selling_items").schema["total_revenue"].dataType.simpleString() == (
        "decimal(24,2)"
    )
    assert store.read("bronze.pageviews").count() == 0
    assert store.ensure("gold")  # a second call changes nothing


def test_catalog_statements():
    assert iceberg_ddl("c.silver.users", "silver.users").endswith(
        "USING iceberg PARTITIONED BY (days(created_at))"
    )
    assert iceberg_ddl("c.silver.items", "silver.items").endswith("PARTITIONED BY (category)")
    assert iceberg_ddl("c.rt.purchases", "rt.purchases").endswith(
        "batch_id BIGINT) USING iceberg PARTITIONED BY (months(created_at), batch_id)"
    )
    assert iceberg_ddl("c.gold.x", "gold.pageviews_by_channel").endswith("USING iceberg")


LINES = [
    json.dumps({"user_id": 1, "url": "/products/7", "channel": "social", "received_at": 1704067200}),
    '{"user_id": 2, "url": "/products/8", "chan',
    '{"user_id": "x", "url": "/products/9", "channel": "social", "received_at": 1704067200}',
    "{}",
    "",
]


def test_pageview_ingest_and_replay(spark, store, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join(LINES))
    for _ in range(2):  # the second run finds nothing new
        ingest_pageviews(store, str(source), f"{tmp_path}/checkpoint")
        valid = store.read("bronze.pageviews").orderBy("user_id").collect()
        dead = store.read("bronze.pageviews_dlq").collect()
        assert [(r.user_id, r.url) for r in valid] == [(None, None), (1, "/products/7")]
        assert sorted((str(r.user_id), str(r.url)) for r in dead) == [
            ("None", "/products/9"),
            ("None", "None"),
        ]
        assert {r.raw_record for r in dead} == set(LINES[1:3])
    assert valid[1].received_at == dt.datetime(2024, 1, 1)
    assert valid[1].source_file.endswith("a.json")

    (source / "b.json").write_text(LINES[0])
    ingest_pageviews(store, str(source), f"{tmp_path}/checkpoint")
    assert store.read("bronze.pageviews").count() == 3


def test_absurd_times_do_not_stop_the_stream(spark, store, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    times = [2**63 - 1, -(2**63), 0]
    (source / "a.json").write_text(
        "\n".join(json.dumps({"user_id": 1, "url": "/x", "received_at": t}) for t in times)
    )
    ingest_pageviews(store, str(source), f"{tmp_path}/checkpoint")
    assert store.read("bronze.pageviews").count() == 3


def test_geo_file(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_text("ip_prefix,country,city\n# comment\n10.0.0,DE,Berlin\n203.0.113,US,New York\n")
    assert sorted(map(tuple, read_geo(spark, str(path)).collect())) == [
        ("10.0.0", "DE", "Berlin"),
        ("203.0.113", "US", "New York"),
    ]


def change(i, updated, **more):
    row = {"id": i, "item_id": 1, "quantity": 1, "purchase_price": 2.0, "created_at": 0}
    return json.dumps({**row, "updated_at": updated, **more})


def test_purchase_stream_and_compaction(spark, store, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join([change(1, 5_000), change(2, 5_000), "broken"]))

    def follow():
        jobs.follow_purchases(store, spark.readStream.text(str(source)), f"{tmp_path}/cp")

    def newest():
        rows = changes.latest_purchases(store.read("rt.purchases")).collect()
        return {r.id: (r.quantity, r.deleted) for r in rows}

    follow()
    (source / "b.json").write_text(
        "\n".join([change(1, 9_000, quantity=4), change(2, 1_000, quantity=9), change(3, 1, deleted=True)])
    )
    follow()
    follow()
    assert newest() == {1: (4, False), 2: (1, False), 3: (1, True)}
    assert store.read("rt.purchases").count() == 5
    kept = store.read("rt.purchases_newest").collect()
    assert {r.id: (r.quantity, r.deleted) for r in kept} == newest()
    (source / "c.json").write_text(change(3, 7_000, quantity=8, deleted=False))
    change_streams.ingest_purchase_changes(
        store, spark.readStream.text(str(source)), f"{tmp_path}/cp/purchases"
    )
    live = change_streams.newest_purchases(store).collect()
    assert {r.id: (r.quantity, r.deleted) for r in live} == newest() == {1: (4, False), 2: (1, False), 3: (8, False)}
    assert change_streams.keep_newest(store) == 1
    assert change_streams.keep_newest(store) == 0
    (error,) = store.read("rt.purchases_errors").collect()
    assert (error._error, error._raw_message) == ("decode error", "broken")


def files_below(folder):
    return [p for p in folder.rglob("*.parquet") if "/_" not in str(p)]


def many_purchases(spark, ids, **more):
    rows = ids.selectExpr(
        "id", "1L AS user_id", "id % 7 AS item_id", "'' AS campaign_id", "1 AS status", "1 AS quantity",
        "1.0 AS purchase_price", "false AS deleted", "timestamp_seconds(id * 97) AS created_at",
        "timestamp_seconds(id) AS updated_at", "id AS log_position", "current_timestamp() AS ingested_at",
    )
    return rows.withColumns({name: F.expr(text) for name, text in more.items()})


def test_folding_joins_files_and_copies_do_not_pile_up(spark, store, tmp_path):
    rows = many_purchases(spark, spark.range(400))
    for n in range(4):
        store.write(rows.filter(F.col("id") % 4 == n).repartition(6), "rt.purchases", batch_id=n)
        change_streams.keep_newest(store)
    assert store.read("rt.purchases_newest").count() == 400
    folder = tmp_path / "store" / "rt" / "purchases_newest"
    live = store.partitions("rt.purchases_newest")
    assert len(live) == len({p.rpartition("/")[0] for p in live}) <= schemas.BUCKETS
    assert all(len(files_below(folder / p)) == 1 for p in live)
    assert len(list(folder.glob("bucket=*/copy=*"))) <= 2 * len(live)  # the live copies and those before
    assert len(list(folder.glob("_live-*"))) == 2
    for _ in range(3):
        store.write(store.read("rt.purchases_newest"), "rt.purchases_newest", mode="replace")
    assert len(list(folder.glob("bucket=*/copy=*"))) == 2 * len(live)


def test_a_fold_leaves_other_buckets_alone(spark, store):
    store.write(many_purchases(spark, spark.range(400)), "rt.purchases", batch_id=0)
    assert change_streams.keep_newest(store) == 400
    before = set(store.partitions("rt.purchases_newest"))
    ids = spark.createDataFrame([(5,), (6,), (1000,)], "id long")
    later = many_purchases(spark, ids, quantity="9", updated_at="timestamp_seconds(9000)")
    store.write(later, "rt.purchases", batch_id=1)
    assert change_streams.keep_newest(store) == 3
    after = set(store.partitions("rt.purchases_newest"))
    buckets = {r.b for r in ids.select(F.expr(schemas.bucket_of("id")).alias("b")).collect()}
    assert {p.split("/")[0] for p in after - before} == {f"bucket={b}" for b in buckets}
    assert len(after & before) == len(before) - len(buckets)
    kept = {r.id: r.quantity for r in store.read("rt.purchases_newest").collect()}
    assert kept == {**dict.fromkeys(range(400), 1), 5: 9, 6: 9, 1000: 9}
    old = many_purchases(spark, ids, quantity="7", updated_at="timestamp_seconds(-5)")
    store.write(old, "rt.purchases", batch_id=2)  # older versions that come late change nothing
    change_streams.keep_newest(store)
    assert {r.id: r.quantity for r in store.read("rt.purchases_newest").collect()} == kept


def dashboards(store, newest):
    """From the kept sums, and by reducing all versions."""
    as_of = "1970-01-01 11:17:00"
    kept = sales.hourly_sales(store, as_of, newest), sales.top_products(store), sales.kpis(store)
    plain = dashboard.hourly_sales(newest, as_of), dashboard.top_products(newest), dashboard.kpis(newest)
    return [[tuple(r) for r in df.collect()] for df in kept], [[tuple(r) for r in df.collect()] for df in plain]


def test_sales_follow_every_change(spark, store):
    rng = random.Random(3)
    for batch in range(5):
        rows = [
            (rng.randrange(60), rng.randrange(4), rng.randrange(5), rng.random() < 0.3, rng.randrange(90_000), rng.randrange(6))
            for _ in range(40)
        ]
        frame = spark.createDataFrame(rows, "id long, item long, n int, gone boolean, made long, changed long")
        changed = frame.selectExpr(
            "id", "1L AS user_id", "item AS item_id", "'' AS campaign_id", "1 AS status", "n AS quantity",
            "2.5 AS purchase_price", "gone AS deleted", "timestamp_seconds(made) AS created_at",
            "timestamp_seconds(changed) AS updated_at", "id * 10 + n AS log_position", "current_timestamp() AS ingested_at",
        )
        store.write(changed, "rt.purchases", batch_id=batch)
        change_streams.keep_newest(store)
        if batch in (1, 3):
            assert sales.fold_sales(store) > 0
            assert sales.fold_sales(store) == 0
        kept, plain = dashboards(store, store.read("rt.purchases_newest"))
        assert kept == plain
    for asked in (sales.kpis(store), sales.top_products(store), sales.hourly_sales(store, "1970-01-01 11:00:00")):
        files = asked.inputFiles()  # no purchase is read again
        assert files and all("/rt/sales_sums/" in f or "/rt/sales_changes/" in f for f in files)


def test_a_fold_that_died_counts_once(spark, store, monkeypatch):
    store.write(many_purchases(spark, spark.range(50)), "rt.purchases", batch_id=0)
    change_streams.keep_newest(store)
    store.write(many_purchases(spark, spark.range(10), quantity="5"), "rt.purchases", batch_id=1)
    write = type(store).write

    def dies(self, df, name, *args, **more):
        if name == dies.at:
            raise OSError("lost")
        return write(self, df, name, *args, **more)

    for at in ("rt.purchases_newest", "rt.sales_position"):
        dies.at = at
        with monkeypatch.context() as patched, pytest.raises(OSError):
            patched.setattr(type(store), "write", dies)
            change_streams.keep_newest(store)
        assert sales.kpis(store).first().total_items_sold == 50  # as of the last whole fold
        if at == "rt.purchases_newest":
            store.write(many_purchases(spark, spark.range(20, 25), quantity="3"), "rt.purchases", batch_id=2)
    for _ in range(3):
        change_streams.keep_newest(store)
        kept, plain = dashboards(store, store.read("rt.purchases_newest"))
        assert kept == plain
    assert sales.kpis(store).first().total_items_sold == 35 + 10 * 5 + 5 * 3


def test_a_refresh_rebuilds_only_touched_days(spark, store):
    def bought(rows):
        return spark.createDataFrame(
            [(i, 1, item, 2, Decimal("1.50"), T + dt.timedelta(days=day), T) for i, item, day in rows],
            "id long, user_id long, item_id long, quantity int, purchase_price decimal(12,2), "
            "created_at timestamp, updated_at timestamp",
        )

    def viewed(rows):
        return spark.createDataFrame(
            [(1, f"/products/{item}", "social", T + dt.timedelta(days=day), "f") for item, day in rows],
            "user_id long, url string, channel string, received_at timestamp, source_file string",
        )

    def put(frame, name, batch_id=None):
        store.write(frame.withColumn("ingested_at", F.current_timestamp()), name, batch_id=batch_id)

    def changed(name, before):
        return {p.split("/")[0].partition("=")[2] for p in set(store.partitions(name)) ^ set(before)}

    facts = ("silver.purchases_enriched", "silver.pageviews_by_items")
    user = spark.createDataFrame(
        [(1, "a", "b", "e@x.io", T, T)],
        "id long, first_name string, last_name string, email string, created_at timestamp, updated_at timestamp",
    )
    put(user, "bronze.users")
    put(items(spark, [(70_000, "toys", "1.00", T), (2, "toys", "1.00", T)]), "bronze.items")
    put(bought([(1, 2, 0), (2, 70_000, 1), (3, 5, 2), (4, -3, 3)]), "bronze.purchases")
    put(viewed([(2, 0), (5, 1)]), "bronze.pageviews", 0)
    assert jobs.refresh_silver(store) == {"users": 1, "items": 2, "purchases": 4, "pageviews": 2}
    before = [store.partitions(name) for name in facts]
    assert jobs.refresh_silver(store) == {}
    put(items(spark, [(5, "books", "2.00", T), (-3, "odd", "2.00", T)]), "bronze.items")  # bought before they came
    put(bought([(5, 2, 1)]), "bronze.purchases")
    assert jobs.refresh_silver(store) == {"items": 4, "purchases": 4, "pageviews": 1}
    days = [changed(n, b) for n, b in zip(facts, before)]
    assert days == [{"2024-01-06", "2024-01-07", "2024-01-08"}, {"2024-01-06"}]  # the others keep their files
    rows = {(r.id, r.item_category) for r in store.read(facts[0]).collect()}
    assert rows == {(1, "toys"), (2, "toys"), (3, "books"), (4, "odd"), (5, "toys")}
    put(viewed([(9, 5)]), "bronze.pageviews", 1)
    before = [store.partitions(name) for name in facts]
    put(user, "bronze.users")  # another version of the user, in the same day
    assert jobs.refresh_silver(store) == {"users": 2, "purchases": 10, "pageviews": 1}
    assert changed(facts[1], before[1]) == {"2024-01-10"}


def test_a_job_that_dies_leaves_no_part_of_its_partitions(spark, store, tmp_path):
    first = items(spark, [(1, "toys", "1.00", T), (2, "books", "1.00", T)])
    store.write(first, "silver.items")
    reading = store.read("silver.items")
    failing = items(spark, [(3, "toys", "1.00", T), (4, "new", "1.00", T)]).withColumn(
        "name", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("name"))
    )
    for mode in ("append", "overwrite", "replace"):
        with pytest.raises(Exception, match="lost"):
            store.write(failing.repartition(2, "id"), "silver.items", mode)
        assert {r.id for r in store.read("silver.items").collect()} == {1, 2}
    store.write(items(spark, [(3, "toys", "1.00", T)]), "silver.items", "overwrite")
    assert {r.id for r in reading.collect()} == {1, 2}  # a reader that began before
    assert {r.id for r in store.read("silver.items").collect()} == {2, 3}
    odd = [(5, None, "1.00", T), (6, "", "1.00", T), (7, "a b/c=%2F*[x]{y}", "1.00", T)]
    store.write(items(spark, odd), "silver.items")
    assert {(r.id, r.category) for r in store.read("silver.items").collect()} == {
        (2, "books"), (3, "toys"), *((i, c) for i, c, _, _ in odd)
    }


def test_a_load_that_died_before_its_cursor_is_not_doubled(spark, store, tmp_path, monkeypatch):
    rows = [(1, "toys", "1.00", T), (2, "books", "1.00", T)]
    source = source_tables(spark, str(tmp_path / "src"), rows)
    write = type(store).write

    def dies(self, df, name, *args, **more):
        if name == "bronze.load_cursors":
            raise OSError("lost")
        return write(self, df, name, *args, **more)

    with monkeypatch.context() as patched, pytest.raises(jobs.StepsFailed):
        patched.setattr(type(store), "write", dies)
        jobs.load_tables(store, source, ["items"])
    source_tables(spark, str(tmp_path / "src"), [*rows, (3, "toys", "1.00", T + dt.timedelta(hours=1))])
    jobs.load_tables(store, source, ["items"])
    assert sorted(r.id for r in store.read("bronze.items").collect()) == [1, 2, 3]
    assert jobs.load_tables(store, source, ["items"]) == {"items": 0}
    assert sorted(r.id for r in store.read("bronze.items").collect()) == [1, 2, 3]


def test_a_reader_sees_one_whole_copy_during_a_switch(spark, store):
    first = items(spark, [(1, "toys", "1.00", T)])
    store.write(first, "silver.items", "replace")
    reading = store.read("silver.items")
    store.write(items(spark, [(2, "toys", "1.00", T), (3, "toys", "1.00", T)]), "silver.items", "replace")
    assert [r.id for r in reading.collect()] == [1]  # the copy it began with is still there
    assert {r.id for r in store.read("silver.items").collect()} == {2, 3}


def test_unreadable_item_messages_are_kept_apart(spark, store, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = {"op": "c", "after": {"id": 1, "name": "n", "price": "1.50"}, "source": {"table": "items", "ts_ms": 5}}
    texts = [
        json.dumps(good),
        '{"op":"u","after":{"id":',
        json.dumps({**good, "after": {"id": "x"}}),
        json.dumps({**good, "after": {"id": 2, "price": "cheap"}}),
        json.dumps({**good, "op": None}),
    ]
    (source / "a.json").write_text("\n".join(texts))
    jobs.follow_items(store, spark.readStream.text(str(source)), f"{tmp_path}/cp")
    assert [r.id for r in store.read("rt.items").collect()] == [1]
    errors = {(r._raw_message, r._error) for r in store.read("rt.items_errors").collect()}
    assert errors == {(t, "value out of range" if "cheap" in t else "decode error") for t in texts[1:]}


def test_a_source_that_grows_between_two_actions(spark, store):
    """Each look at the source sees more rows; what is loaded, refused and passed by the cursor agree."""
    class Growing:
        looks = 0

        def rows(self, table, key, cursor, since, partitions):
            Growing.looks += 1
            rows = [(1, "a", "1.00", T), (2, "a", "123456.00", T + dt.timedelta(minutes=Growing.looks))]
            return items(spark, rows)

    jobs.load_tables(store, Growing(), ["items"])
    assert Growing.looks == 1
    assert store.read("bronze.items").count() == store.read("bronze.rejected_rows").count() == 1


def test_equal_updates_keep_the_later_batch(spark, store, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, quantity in (("a", 7), ("b", 3)):
        (source / f"{name}.json").write_text(change(1, 5_000, quantity=quantity))
        jobs.follow_purchases(store, spark.readStream.text(str(source)), f"{tmp_path}/cp")
    (row,) = changes.latest_purchases(store.read("rt.purchases")).collect()
    assert row.quantity == 3


def source_tables(spark, folder, rows):
    items(spark, rows).write.mode("overwrite").parquet(f"{folder}/items")
    return relational.ParquetSource(spark, folder)


def test_incremental_load_and_rejected_rows(spark, store, tmp_path):
    later = T + dt.timedelta(hours=1)
    rows = [(1, "toys", "1.00", T), (2, "toys", "123456.00", T)]
    source = source_tables(spark, str(tmp_path / "src"), rows)
    assert jobs.load_tables(store, source, ["items"]) == {"items": 1}
    assert jobs.load_tables(store, source, ["items"]) == {"items": 0}
    rows += [(3, "toys", "3.00", later), (1, "toys", "1.50", later)]
    source_tables(spark, str(tmp_path / "src"), rows)
    assert jobs.load_tables(store, source, ["items"]) == {"items": 2}
    assert sorted(r.id for r in store.read("bronze.items").collect()) == [1, 1, 3]
    (refused,) = store.read("bronze.rejected_rows").collect()
    assert refused.table_name == "bronze.items"
    assert json.loads(refused.raw_record)["price"] == 123456.0


def test_the_kept_cursor_is_used_instead_of_the_table(spark, store, tmp_path):
    source = source_tables(spark, str(tmp_path / "src"), [(1, "toys", "1.00", T)])
    jobs.load_tables(store, source, ["items"])
    assert [tuple(r) for r in store.read("bronze.load_cursors").select("table_name", "updated_at").collect()] == [("bronze.items", T)]
    source_tables(spark, str(tmp_path / "src"), [(2, "toys", "1.00", T + dt.timedelta(hours=1))])
    jobs.load_tables(store, source, ["items"])
    (cursor,) = store.read("bronze.load_cursors").collect()
    assert cursor.updated_at == T + dt.timedelta(hours=1)
    plan = jobs.loaded_until(store, "bronze.items")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_name" in plan


def test_lookback_rereads_late_rows(spark, tmp_path):
    source = source_tables(
        spark, str(tmp_path), [(1, "a", "1.00", T), (2, "a", "1.00", T - dt.timedelta(minutes=1))]
    )
    target = items(spark, [(1, "a", "1.00", T)])
    assert relational.read_incremental(source, "items", target).count() == 0
    again = relational.read_incremental(source, "items", target, lookback="5 minutes")
    assert sorted(r.id for r in again.collect()) == [1, 2]
    assert relational.last_cursor(target.limit(0), "updated_at") is None


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    source = source_tables(spark, str(tmp_path), [(1, "a", "1.00", T)])
    df = relational.read_incremental(source, "items", items(spark, [(1, "a", "1.00", T)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at" in plan


def test_jdbc_text():
    where = relational.filter_text("updated_at", "2024-01-05 13:30:00")
    assert where == " WHERE updated_at > TIMESTAMP '2024-01-05 13:30:00'"
    assert relational.bounds_query("items", "id", where) == (
        "(SELECT min(id) AS low, max(id) AS high FROM items WHERE updated_at > "
        "TIMESTAMP '2024-01-05 13:30:00') AS bounds"
    )
    assert relational.filter_text("updated_at", None) == ""


@pytest.mark.parametrize("parts", [1, 4, 10])
def test_ranges_of_a_skewed_key_hold_equally_many_rows(parts):
    """Two thirds of the ids lie close together, one comes far above; the text runs on a database."""
    con = duckdb.connect()
    con.execute("CREATE TABLE src AS SELECT CASE WHEN i < 2000 THEN i ELSE i * i END AS id, i % 2 AS odd FROM range(3000) t(i)")
    con.execute("INSERT INTO src VALUES (1000000000000000000, 0), (NULL, 0)")
    rows = con.execute(f"SELECT * FROM {relational.ranges_query('src', 'id', ' WHERE odd = 0', parts)}").fetchall()
    predicates = relational.range_predicates("id", [high for _, high in rows if high is not None])
    counts = [con.execute(f"SELECT count(*) FROM src WHERE odd = 0 AND ({p})").fetchone()[0] for p in predicates]
    assert len(counts) == parts and sum(counts) == 1502 and max(counts) <= 2 * min(counts)


def test_range_predicates_take_each_row_once():
    con = duckdb.connect()
    con.execute("CREATE TABLE src AS SELECT unnest([NULL, -5, 1, 1, 1, 1, 1, 2, 9, 10]) AS id")
    for highs in ([], [1], [1, 1, 1, 2], [-5, 1, 1, 9]):
        counts = [con.execute(f"SELECT count(*) FROM src WHERE {p}").fetchone()[0] for p in relational.range_predicates("id", highs)]
        assert sum(counts) == 10


def test_bounds_come_from_footers(spark, tmp_path):
    spark.range(10, 90_000).repartition(3).write.parquet(f"{tmp_path}/t")
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    source = relational.ParquetSource(spark, str(tmp_path))
    found = relational.footer_bounds(spark, f"{tmp_path}/t", "id")
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(source.bounds("t", "id").first()) == (89_990, 10, 89_999)
    assert tuple(source.bounds("empty", "id").first()) == (0, None, None)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # this session is as before


def test_failed_steps_are_collected(spark, store, tmp_path):
    source = source_tables(spark, str(tmp_path / "src"), [(1, "toys", "1.00", T)])
    with pytest.raises(jobs.StepsFailed, match="users, purchases") as error:
        jobs.load_tables(store, source)
    assert set(error.value.failures) == {"users", "purchases"}
    assert store.read("bronze.items").count() == 1


def test_conform_checks_only_what_may_fail(spark):
    assert schemas.may_reject(items(spark, [(1, "a", "1.00", T)]), "bronze.items")
    widened = items(spark, [(1, "a", "1.00", T)]).withColumn("price", F.lit(1).cast("decimal(6,1)"))
    assert not schemas.may_reject(widened, "bronze.items")


def test_full_run(spark, store, tmp_path):
    folder = str(tmp_path / "src")
    stamp = {"created_at": F.lit(T), "updated_at": F.lit(T)}
    spark.createDataFrame(
        [(1, "A", "B", "a@b.cc"), (2, "C", "D", None)],
        "id int, first_name string, last_name string, email string",
    ).withColumns(stamp).write.parquet(f"{folder}/users")
    source = source_tables(spark, folder, [(7, "toys", "1.00", T), (8, "books", "-2.00", T)])
    spark.createDataFrame(
        [(1, 1, 7, 2, Decimal("10.00"), "FLASH"), (2, 2, 8, 3, Decimal("20.00"), None)],
        "id int, user_id long, item_id long, quantity int, purchase_price decimal(12,2), "
        "campaign_id string",
    ).withColumns(stamp).write.parquet(f"{folder}/purchases")
    views = tmp_path / "views"
    views.mkdir()
    at = int(T.replace(tzinfo=dt.timezone.utc).timestamp())
    (views / "a.json").write_text(
        "\n".join(
            json.dumps({"user_id": 1, "url": url, "channel": "social", "received_at": at})
            for url in ("/products/7", "/home", "/products/7")
        )
    )
    jobs.full_run(store, source, str(views), f"{tmp_path}/cp")

    selling = {r.item_id: r.total_revenue for r in store.read("gold.top_selling_items").collect()}
    assert selling == {7: Decimal("20.00"), 8: Decimal("60.00")}
    (hour,) = store.read("gold.sales_performance_24h").collect()
    assert tuple(hour) == (13, Decimal("80.00"))
    (funnel,) = store.read("gold.top_converting_items").collect()
    assert (funnel.item_id, funnel.total_pageviews, funnel.total_purchases) == (7, 2, 2)
    assert {r.price for r in store.read("silver.items").collect()} == {Decimal("1.00"), Decimal("0.00")}

    for _ in range(2):
        path = jobs.segment_users(store, "2024-01-06", f"{tmp_path}/export")
        assert store.read("gold.user_engagement_segments").count() == 1
    (line,) = spark.read.option("header", True).csv(path).collect()
    assert (line.user_id, line.total_pageviews, line.engagement_segment) == ("1", "2", "low_engagement")
    jobs.build_silver(store, newest_only=True)
    assert jobs.build_gold(store)["gold.top_selling_items"] == 2
