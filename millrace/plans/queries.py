"""Registered queries: ``(spark, folder of the given tables) -> DataFrame``.

Results are shown with plain types (money as double, dates as text, times without zone) so that
two engines can be compared; the operators themselves keep exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from millrace.functions import times
from millrace.operators import (
    changes,
    gold,
    logins,
    quality,
    segments,
    silver,
    vectors,
)
from millrace.operators.latest import latest_by_key
from millrace.plans import jobs
from millrace.session import prepare, scratch_dir
from millrace.sources import kafka
from millrace.sources import shop_tables as shop
from millrace.sources.files import read_geo, read_logins
from millrace.sources.relational import ParquetSource
from millrace.streaming import changes as change_streams
from millrace.streaming import logins as logins_stream
from millrace.streaming import sales
from millrace.streaming.pageviews import ingest_pageviews
from millrace.tables import Store

AS_OF = "2024-01-31"
SPLIT_AT = "2024-01-16"  # first load of the incremental query ends here
SEARCH_TEXT = "the support team answered quickly and solved my problem"

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Show money as double, dates as text and times without zone."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        shown.append(column)
    return df.select(*shown)


def _as_text(query: Query, column: str) -> Query:
    """The query with a nullable flag or number as text: engines show missing ones differently."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(spark, folder).withColumn(column, F.col(column).cast("string"))

    run.__name__ = query.__name__
    return run


def _typed_pageviews(spark: SparkSession, folder: str) -> DataFrame:
    return shop.pageviews(spark, folder).withColumn(
        "received_at", times.from_epoch_seconds(F.col("received_at"))
    )


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return silver.purchases_enriched(
        shop.purchases(spark, folder), shop.users(spark, folder), shop.items(spark, folder)
    )


def _enriched_events(spark: SparkSession, folder: str) -> DataFrame:
    return silver.purchases_enriched(
        shop.purchase_events(spark, folder), shop.users(spark, folder), shop.items(spark, folder)
    )


def _item_views(spark: SparkSession, folder: str) -> DataFrame:
    return silver.pageviews_by_items(_typed_pageviews(spark, folder), shop.items(spark, folder))


def silver_users(spark, folder):
    return silver.users(shop.users(spark, folder))


def silver_items(spark, folder):
    return silver.items(shop.items(spark, folder))


def top_selling_items(spark, folder):
    return gold.top_selling_items(_enriched(spark, folder))


def top_selling_items_top10(spark, folder):
    return gold.top_items(top_selling_items(spark, folder))


def sales_by_hour(spark, folder):
    return gold.sales_by_hour(_enriched_events(spark, folder))


def pageviews_by_channel(spark, folder):
    return gold.pageviews_by_channel(_item_views(spark, folder))


def top_converting_items(spark, folder):
    return gold.top_converting_items(_item_views(spark, folder), _enriched_events(spark, folder))


def top_converting_items_distinct(spark, folder):
    return gold.top_converting_items(
        _item_views(spark, folder), _enriched_events(spark, folder), distinct_users=True
    )


def user_engagement_segments(spark, folder):
    return segments.user_engagement_segments(
        silver_users(spark, folder), shop.pageviews_for_segments(spark, folder), AS_OF
    )


def segments_export(spark, folder):
    written = segments.export_segments(
        user_engagement_segments(spark, folder), AS_OF, scratch_dir(spark, "segments")
    )
    return (
        spark.read.option("header", True)
        .schema(
            "user_id BIGINT, email STRING, full_name STRING, total_pageviews BIGINT, "
            "active_days BIGINT, last_active_date DATE, days_since_last_active BIGINT, "
            "engagement_segment STRING"
        )
        .csv(written)
    )


def rt_purchases_latest(spark, folder):
    return changes.latest_purchases(
        changes.valid_purchases(shop.purchase_changes(spark, folder))
    )


def rt_purchase_errors(spark, folder):
    return changes.purchase_errors(shop.purchase_changes(spark, folder))


def _kept_purchases(spark: SparkSession, folder: str) -> Store:
    """The purchase log as a store with kept newest versions: first versions in one batch, which is
    folded, then the second ones, which are not yet."""
    store = Store(spark, scratch_dir(spark, "purchases"))
    rows = changes.valid_purchases(shop.purchase_changes(spark, folder)).withColumns(
        {"log_position": F.monotonically_increasing_id(), "ingested_at": F.current_timestamp()}
    )
    second = F.col("campaign_id") == "BOGO23"
    store.write(rows.filter(~second), "rt.purchases", batch_id=0)
    change_streams.keep_newest(store)
    store.write(rows.filter(second), "rt.purchases", batch_id=1)
    return store


_SALES_STORES: dict[tuple[str, str], str] = {}  # (application, folder of the given tables): root of the store


def _kept_sales(spark: SparkSession, folder: str) -> Store:
    """Both versions folded; the sums hold the first fold, the second is in the changes after them. Made once in an
    application and then only asked, as dashboards do."""
    key = spark.sparkContext.applicationId, folder
    if key in _SALES_STORES:
        store = Store(spark, _SALES_STORES[key])
        if sales.position(store) is not None:
            return store
    store = _kept_purchases(spark, folder)
    sales.fold_sales(store)
    change_streams.keep_newest(store)
    _SALES_STORES[key] = store.root
    return store


def hourly_sales_24h(spark, folder):
    return sales.hourly_sales(_kept_sales(spark, folder), AS_OF)


def top_products(spark, folder):
    return sales.top_products(_kept_sales(spark, folder))


def kpis(spark, folder):
    return sales.kpis(_kept_sales(spark, folder))


def hourly_sales_within_hour(spark, folder):
    """A-6 from half past an hour on: the first hour comes from the newest versions."""
    store = _kept_sales(spark, folder)
    return sales.hourly_sales(store, f"{AS_OF} 00:30:00", change_streams.newest_purchases(store))


def purchases_kept_newest(spark, folder):
    """The kept table after the second fold."""
    return _kept_sales(spark, folder).read("rt.purchases_newest").drop("bucket", "log_position", "last_batch")


def purchases_equal_times(spark, folder):
    """Every purchase is changed twice at the same instant; the later message in the log wins."""
    first = changes.valid_purchases(shop.purchase_changes(spark, folder)).filter("campaign_id <> 'BOGO23'")
    log = first.withColumn("log_position", F.explode(F.array(F.lit(1), F.lit(2))))
    numbered = log.withColumn("quantity", F.when(F.col("log_position") == 2, 1).otherwise(900))
    return changes.latest_purchases(numbered, ["id", "quantity"])


def item_documents_equal_times(spark, folder):
    """Changes of an item within one millisecond: the place in the log decides, not the name."""
    rows = shop.item_changes(spark, folder).filter("__op = 'r'")
    log = rows.withColumn("log_position", F.explode(F.array(F.lit(1), F.lit(2))))
    named = log.withColumn("name", F.concat(F.when(F.col("log_position") == 2, "a ").otherwise("z "), "name"))
    return changes.item_documents(named, ["id", "name"])


def item_documents(spark, folder):
    return changes.item_documents(shop.item_changes(spark, folder))


def item_document_count(spark, folder):
    needed = changes.item_documents(shop.item_changes(spark, folder), ["id", "__deleted"])
    return changes.document_count(needed)


def logins_enriched(spark, folder):
    return logins.enrich_logins(shop.logins(spark, folder), shop.geo(spark))


def logins_enriched_geo_csv(spark, folder):
    """SRC-6: prefixes from a CSV file with a comment and a line that is too long."""
    base = scratch_dir(spark, "geo")
    lines = ["# prefixes", "ip_prefix,country,city", *(",".join(r) for r in shop.GEO_ROWS), "1,2,3,4,5"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/in")
    found = logins.enrich_logins(shop.logins(spark, folder), read_geo(spark, f"{base}/in"))
    return found


def anomaly_messages(spark, folder):
    """SNK-6: anomalies as keyed JSON messages for an upsert topic."""
    found = login_anomalies(spark, folder).filter("country IS NOT NULL")
    shown = found.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))
    return kafka.as_messages(shown, ["user_id", "timestamp"])


def logins_enriched_many_prefixes(spark, folder):
    """Thousands of prefixes, derived from the logins' own addresses."""
    events = shop.logins(spark, folder)
    return logins.enrich_logins(events, shop.many_prefixes(events))


def login_anomalies(spark, folder):
    """Over the stored enriched logins, so that they are enriched once."""
    store = Store(spark, scratch_dir(spark, "logins"))
    store.write(logins_enriched(spark, folder), "rt.login_events_enriched", batch_id=0)
    return logins.login_anomalies(store.read("rt.login_events_enriched"))


def login_log_upserted(spark, folder):
    """SNK-6: the login log written twice, as after a retried job, seen as a keyed table."""
    store = Store(spark, scratch_dir(spark, "logins"))
    rows = logins_enriched(spark, folder)
    for n in range(2):
        store.write(rows.filter(F.col("event_id") % (n + 1) == 0), "rt.login_events_enriched", batch_id=n)
    kept = logins.upserted(store.read("rt.login_events_enriched"))
    return kept.select("user_id", "timestamp")


def quality_report(spark, folder):
    return (
        quality.quality_report(silver_users(spark, folder), "users", quality.USER_RULES)
        .unionByName(
            quality.quality_report(silver_items(spark, folder), "items", quality.ITEM_RULES)
        )
        .unionByName(
            quality.quality_report(
                shop.purchases(spark, folder), "purchases", quality.PURCHASE_RULES
            )
        )
    )


def latest_users(spark, folder):
    return latest_by_key(shop.user_versions(spark, folder), "id", "updated_at")


def _loaded(spark: SparkSession, folder: str) -> Store:
    """Two loads of three growing tables; the second one starts at the first one's cursor. Every fiftieth
    purchase has a price beyond the declared type."""
    base = scratch_dir(spark, "incremental")
    store = Store(spark, f"{base}/store")
    too_much = F.when(F.col("id") % 50 == 9, F.lit(10**11)).otherwise(F.col("purchase_price"))
    tables = {
        "users": shop.users(spark, folder),
        "items": shop.items(spark, folder),
        "purchases": shop.purchase_events(spark, folder).withColumn(
            "purchase_price", too_much.cast("decimal(20,2)")
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{base}/now/{name}")
        early = spark.read.parquet(f"{base}/now/{name}").filter(F.col("updated_at") < SPLIT_AT)
        early.write.parquet(f"{base}/earlier/{name}")
    for state in ("earlier", "now"):
        jobs.load_tables(store, ParquetSource(spark, f"{base}/{state}"))
    return store


def incremental_ingest(spark, folder):
    columns = ["id", "created_at", "updated_at"]
    store = _loaded(spark, folder)
    each = [
        store.read(f"bronze.{name}").select(F.lit(name).alias("table_name"), *columns)
        for name in jobs.RELATIONAL_TABLES
    ]
    return each[0].unionAll(each[1]).unionAll(each[2])


def load_bounds(spark, folder):
    """A-10: rows and bounds of the ids, from the footers of the source's files."""
    base = scratch_dir(spark, "bounds")
    source = ParquetSource(spark, base)
    found = []
    for name, rows in (("users", shop.users), ("items", shop.items), ("purchases", shop.purchases)):
        rows(spark, folder).write.parquet(f"{base}/{name}")
        found.append(source.bounds(name, "id").select(F.lit(name).alias("table_name"), "rows", "low", "high"))
    return found[0].unionAll(found[1]).unionAll(found[2])


def _refreshed(spark: SparkSession, folder: str) -> Store:
    """Silver made from early purchases and most items, then refreshed for later days and the other items."""
    store = Store(spark, scratch_dir(spark, "refresh"))
    split = F.lit(SPLIT_AT).cast("timestamp")
    users, items, bought = shop.users(spark, folder), shop.items(spark, folder), shop.purchase_events(spark, folder)
    views = shop.pageviews(spark, folder).withColumns(
        {"received_at": times.from_epoch_seconds(F.col("received_at")), "source_file": F.lit("")}
    )
    late_item, late, late_view = F.col("id") % 10 == 0, F.col("created_at") >= split, F.col("received_at") >= split

    def add(rows: DataFrame, name: str, batch_id: int | None = None) -> None:
        store.write(rows.withColumn("ingested_at", F.current_timestamp()), name, batch_id=batch_id)

    add(users, "bronze.users")
    for n, (item, purchase, view) in enumerate(((~late_item, ~late, ~late_view), (late_item, late, late_view))):
        add(items.filter(item), "bronze.items")
        add(bought.filter(purchase), "bronze.purchases")
        add(views.filter(view), "bronze.pageviews", n)
        jobs.refresh_silver(store)
    return store


def silver_refreshed_purchases(spark, folder):
    return _refreshed(spark, folder).read("silver.purchases_enriched").drop("created_day")


def silver_refreshed_pageviews(spark, folder):
    return _refreshed(spark, folder).read("silver.pageviews_by_items").drop("received_day")


def rejected_rows(spark, folder):
    rows = _loaded(spark, folder).read("bronze.rejected_rows")
    return rows.select("table_name", F.get_json_object("raw_record", "$.id").cast("bigint").alias("id"))


def _full_run(spark: SparkSession, folder: str) -> Store:
    """JOB-10 over the shop's tables as a relational source and pageviews as JSON files."""
    base = scratch_dir(spark, "full-run")
    store = Store(spark, f"{base}/store")
    for name, rows in (
        ("users", shop.users(spark, folder)),
        ("items", shop.items(spark, folder)),
        ("purchases", shop.purchase_events(spark, folder)),
    ):
        rows.write.parquet(f"{base}/source/{name}")
    _pageview_files(spark, folder, f"{base}/in")
    jobs.full_run(store, ParquetSource(spark, f"{base}/source"), f"{base}/in", f"{base}/checkpoints")
    return store


def full_run_gold(spark, folder):
    """SNK-2, JOB-2 to JOB-4, JOB-10: the conversion table at the end of a full run."""
    return _full_run(spark, folder).read("gold.top_converting_items")


def full_run_quality(spark, folder):
    """DQ-1: the quality report that a full run leaves."""
    return _full_run(spark, folder).read("silver.quality_report")


def segments_job(spark, folder):
    """JOB-5 over the silver tables of a full run: segments per label."""
    store = _full_run(spark, folder)
    jobs.segment_users(store, AS_OF, scratch_dir(spark, "segments"))
    made = store.read("gold.user_engagement_segments")
    return made.groupBy("engagement_segment").agg(
        F.count("*").alias("users"), F.sum("total_pageviews").alias("pageviews")
    )


def segments_from_days(spark, folder):
    """A-5, J-4, JOB-5 from kept activity: the views of two halves of the month, one day that comes again with half of
    its views and then whole."""
    store = Store(spark, scratch_dir(spark, "activity"))
    store.write(silver_users(spark, folder), "silver.users")
    views = shop.pageviews_for_segments(spark, folder).withColumns(
        {c: F.lit(None) for c in ("item_id", "item_name", "item_category", "channel")}
    )
    again = F.to_date("received_at") == F.lit(SPLIT_AT).cast("date")
    late = F.col("received_at") >= F.lit(SPLIT_AT).cast("timestamp")
    for rows in (views.filter(~late), views.filter(again & (F.col("user_id") % 2 == 0)), views.filter(late)):
        store.write(rows, "silver.pageviews_by_items", mode="overwrite")
        jobs.refresh_activity(store)
    jobs.segment_users(store, AS_OF, scratch_dir(spark, "segments"))
    return store.read("gold.user_engagement_segments")


def _pageview_files(spark: SparkSession, folder: str, target: str) -> None:
    """Pageviews as JSON lines. Error events become cut-off lines, signups a wrong user_id type."""
    good = shop.pageviews(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    bad = (
        shop.load(spark, folder, "events")
        .filter("event_type IN ('error', 'signup')")
        .selectExpr(
            "IF(event_type = 'error', "
            "concat('{\"user_id\":', user_id, ',\"url\":\"/broken/', event_id), "
            "concat('{\"user_id\":\"u', user_id, '\",\"url\":\"/signup/', event_id, '\"}')) AS value"
        )
    )
    good.unionByName(bad).write.text(target)


def _ingested(spark: SparkSession, folder: str, table: str) -> DataFrame:
    base = scratch_dir(spark, "pageviews")
    store = Store(spark, f"{base}/store")
    _pageview_files(spark, folder, f"{base}/in")
    ingest_pageviews(store, f"{base}/in", f"{base}/checkpoint")
    return store.read(table)


def pageviews_ingest_stream(spark, folder):
    return _ingested(spark, folder, "bronze.pageviews").select(
        "user_id", "url", "channel", "received_at"
    )


def pageviews_source_files(spark, folder):
    """P-9: every stored pageview names the file it came from and the time it came."""
    rows = _ingested(spark, folder, "bronze.pageviews")
    file = F.regexp_extract("source_file", r"/in/part-[^/]+\.txt$", 0) != ""
    return rows.agg(
        F.count("*").alias("pageviews"),
        F.count(F.when(file, 1)).alias("with_file"),
        F.count("ingested_at").alias("with_time"),
    )


def pageviews_dlq(spark, folder):
    return _ingested(spark, folder, "bronze.pageviews_dlq").select("raw_record", "user_id", "url")


def _followed_purchases(spark: SparkSession, folder: str) -> Store:
    """Purchase changes as JSON messages, undecodable ones as plain text, through the stream."""
    base = scratch_dir(spark, "purchases")
    store = Store(spark, f"{base}/store")
    rows = shop.purchase_changes(spark, folder)
    body = F.to_json(F.struct(*[c for c in rows.columns if not c.startswith("_")]))
    rows.select(
        F.when(F.col("_error") == "", body).otherwise(F.col("_raw_message")).alias("value")
    ).write.text(f"{base}/in")
    jobs.follow_purchases(store, spark.readStream.text(f"{base}/in"), f"{base}/checkpoints")
    return store


def rt_purchases_stream(spark, folder):
    log = _followed_purchases(spark, folder).read("rt.purchases")
    return changes.latest_purchases(log).drop("ingested_at")


def rt_purchase_errors_stream(spark, folder):
    log = _followed_purchases(spark, folder).read("rt.purchases_errors")
    return log.select("_error", "_raw_message")


def _followed_items(spark: SparkSession, folder: str) -> Store:
    """Item changes as envelopes on a topic: the row sits in ``before`` for a delete, else in ``after``.
    Every hundredth message is cut off, and messages of another topic lie between."""
    base = scratch_dir(spark, "items")
    store = Store(spark, f"{base}/store")
    row = F.struct(
        "id", "name", "category", F.col("price").cast("string").alias("price"), "inventory"
    )
    gone = F.col("__op") == "d"
    envelope = F.to_json(
        F.struct(
            F.when(gone, row).alias("before"),
            F.when(~gone, row).alias("after"),
            F.col("__op").alias("op"),
            F.struct(
                F.col("__table").alias("table"), F.col("__source_ts_ms").alias("ts_ms")
            ).alias("source"),
        )
    )
    sent = shop.item_changes(spark, folder).select("id", "__op", envelope.alias("value"))
    cut_off = sent.filter("id % 100 = 3").select(F.concat(F.lit('{"op":"u","after":{"id":'), "id").alias("value"))
    other = sent.select(F.lit("dbz.public.users").alias("topic"), "value")
    own = sent.select("value").unionAll(cut_off).select(F.lit("dbz.public.items").alias("topic"), "value")
    own.unionAll(other).write.json(f"{base}/in")
    messages = spark.readStream.schema("topic STRING, value STRING").json(f"{base}/in")
    jobs.follow_items(store, messages, f"{base}/checkpoints")
    return store


def item_documents_stream(spark, folder):
    log = _followed_items(spark, folder).read("rt.items")
    return changes.item_documents(log).drop("created_at", "updated_at")


def item_errors_stream(spark, folder):
    """Unreadable item messages, with the number of readable ones."""
    store = _followed_items(spark, folder)
    good = store.read("rt.items").agg(F.count("*").alias("good"))
    return store.read("rt.items_errors").select("_error", "_raw_message").join(F.broadcast(good))


def _watched(spark: SparkSession, drops: list[DataFrame], **options) -> Store:
    """Drops of login files, JOB-6 after each of them."""
    base = scratch_dir(spark, "logins")
    store = Store(spark, f"{base}/store")
    for rows in drops:
        rows.write.mode("append").json(f"{base}/in")
        jobs.watch_logins(
            store,
            read_logins(spark, f"{base}/in"),
            shop.geo(spark),
            f"{base}/checkpoints",
            state_partitions=spark.sparkContext.defaultParallelism,
            **options,
        )
    return store


def _backlog_anomalies(spark: SparkSession, folder: str, **options) -> DataFrame:
    """All logins as one backlog of files, with a login far later that lets the watermark pass them."""
    rows = shop.logins(spark, folder)
    closing = rows.limit(1).withColumns(
        {"user_id": F.lit("closing"), "timestamp": F.lit("2999-01-01T00:00:00.000Z")}
    )
    store = _watched(spark, [rows.unionAll(closing)], **options)
    found = logins_stream.read_anomalies(store)
    return found.filter(~F.col("user_id").eqNullSafe("closing"))


def login_anomalies_stream(spark, folder):
    return _backlog_anomalies(spark, folder)


def login_anomalies_joined_stream(spark, folder):
    """J-6, W-2 as a join of two streams."""
    return _backlog_anomalies(spark, folder, joined=True)


def login_late_stream(spark, folder):
    """W-7: a fifth of the logins comes after the watermark has passed nearly all of them."""
    rows = shop.logins(spark, folder)
    fifth = F.col("event_id") % 5 == 0
    late = _watched(spark, [rows.filter(~fifth), rows.filter(fifth)]).read("rt.login_late")
    return late.drop("event_day", "batch_id")


def login_log_once_stream(spark, folder):
    """SNK-6: every third login is sent twice at once, and every second one again in a later batch."""
    rows = shop.logins(spark, folder)
    third, second = rows.filter("event_id % 3 = 0"), rows.filter("event_id % 2 = 0")
    store = _watched(spark, [rows.unionAll(third), second], joined=True, repeats_within="60 days")
    return store.read("rt.login_events_enriched").select("user_id", "timestamp")


def login_errors_stream(spark, folder):
    """Every hundredth login has a time that cannot be read."""
    base = scratch_dir(spark, "logins")
    store = Store(spark, f"{base}/store")
    broken = F.when(F.col("event_id") % 100 == 7, F.concat(F.lit("no time "), "event_id"))
    rows = shop.logins(spark, folder).withColumn("timestamp", F.coalesce(broken, "timestamp"))
    rows.select("user_id", "timestamp", "ip", "device", "platform").write.json(f"{base}/in")
    jobs.watch_logins(store, read_logins(spark, f"{base}/in"), shop.geo(spark), f"{base}/checkpoints")
    good = store.read("rt.login_events_enriched").agg(F.count("*").alias("good"))
    return store.read("rt.login_errors").select("_error", "_raw_message").join(F.broadcast(good))


def _as_millionths(name: str) -> Column:
    """A vector as text, so that engines can be compared."""
    numbers = F.transform(
        name, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string")
    )
    return F.array_join(numbers, ",").alias("embedding")


def review_embeddings(spark, folder):
    made = vectors.new_embeddings(vectors.without_embedding(shop.reviews(spark, folder)))
    return made.select("review_id", _as_millionths("embedding"))


def embedding_write_back(spark, folder):
    """Reviews after a run of the embedding job."""
    store = Store(spark, scratch_dir(spark, "reviews"))
    reviews = shop.reviews(spark, folder)
    store.write(reviews, "rt.reviews")
    jobs.embed_reviews(store, vectors.hashing_encoder)
    return store.read("rt.reviews").select(
        "review_id", "review", _as_millionths("review_embedding")
    )


def similar_vectors_top5(spark, folder):
    corpus = shop.vectors(spark, folder)
    probe = corpus.orderBy("review_id").first()["review_embedding"]
    return vectors.nearest(corpus, probe).select(
        "review_id", "label", F.round("distance", 4).alias("similarity")
    )


def similar_reviews_top5(spark, folder):
    """Embed all reviews into the embeddings table, then search them by text."""
    store = Store(spark, scratch_dir(spark, "reviews"))
    reviews = shop.reviews(spark, folder)
    made = vectors.new_embeddings(vectors.without_embedding(reviews))
    store.write(made, "rt.review_embeddings")
    corpus = vectors.search_vectors(reviews, store.read("rt.review_embeddings"))
    probe = vectors.hashing_encoder()([SEARCH_TEXT])[0]
    shown = reviews.select("review_id", "customer_name", "review")
    found = vectors.nearest(corpus, probe, details=shown)
    return found.select(
        "review_id", "customer_name", "review", F.round("distance", 4).alias("similarity")
    )


ALL: dict[str, Query] = {
    "silver_users": _as_text(silver_users, "valid_email"),
    "silver_items": silver_items,
    "silver_purchases_enriched": _enriched,
    "silver_pageviews_by_items": _item_views,
    "top_selling_items": top_selling_items,
    "top_selling_items_top10": top_selling_items_top10,
    "sales_by_hour": sales_by_hour,
    "pageviews_by_channel": pageviews_by_channel,
    "top_converting_items": top_converting_items,
    "top_converting_items_distinct": top_converting_items_distinct,
    "user_engagement_segments": _as_text(user_engagement_segments, "days_since_last_active"),
    "segments_export": _as_text(segments_export, "days_since_last_active"),
    "rt_purchases_latest": rt_purchases_latest,
    "rt_purchase_errors": rt_purchase_errors,
    "hourly_sales_24h": hourly_sales_24h,
    "hourly_sales_within_hour": hourly_sales_within_hour,
    "top_products": top_products,
    "kpis": kpis,
    "purchases_equal_times": purchases_equal_times,
    "purchases_kept_newest": purchases_kept_newest,
    "item_documents": item_documents,
    "item_documents_equal_times": item_documents_equal_times,
    "item_document_count": item_document_count,
    "logins_enriched": logins_enriched,
    "logins_enriched_geo_csv": logins_enriched_geo_csv,
    "logins_enriched_many_prefixes": logins_enriched_many_prefixes,
    "login_anomalies": login_anomalies,
    "anomaly_messages": anomaly_messages,
    "login_log_upserted": login_log_upserted,
    "quality_report": quality_report,
    "latest_by_key": latest_users,
    "incremental_ingest": incremental_ingest,
    "load_bounds": load_bounds,
    "full_run_quality": full_run_quality,
    "segments_job": segments_job,
    "segments_from_days": _as_text(segments_from_days, "days_since_last_active"),
    "full_run_gold": full_run_gold,
    "rejected_rows": rejected_rows,
    "silver_refreshed_purchases": silver_refreshed_purchases,
    "silver_refreshed_pageviews": silver_refreshed_pageviews,
    "pageviews_ingest_stream": pageviews_ingest_stream,
    "pageviews_dlq": pageviews_dlq,
    "pageviews_source_files": pageviews_source_files,
    "rt_purchases_stream": rt_purchases_stream,
    "rt_purchase_errors_stream": rt_purchase_errors_stream,
    "item_documents_stream": item_documents_stream,
    "item_errors_stream": item_errors_stream,
    "login_anomalies_stream": login_anomalies_stream,
    "login_anomalies_joined_stream": login_anomalies_joined_stream,
    "login_late_stream": login_late_stream,
    "login_log_once_stream": login_log_once_stream,
    "login_errors_stream": login_errors_stream,
    "review_embeddings": review_embeddings,
    "embedding_write_back": embedding_write_back,
    "similar_vectors_top5": similar_vectors_top5,
    "similar_reviews_top5": similar_reviews_top5,
}


def registered() -> dict[str, Query]:
    """Every query with prepared session settings and plain result types."""

    def wrap(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(query(prepare(spark), folder))

        run.__name__ = query.__name__
        return run

    return {name: wrap(query) for name, query in ALL.items()}
