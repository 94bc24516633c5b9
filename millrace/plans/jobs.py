"""Jobs (JOB-1 .. JOB-10)."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace import schemas
from millrace.functions import cleaning
from millrace.functions.encoders import Encoder
from millrace.operators import activity, changes, day_keys, gold, quality, segments, silver, vectors
from millrace.operators.latest import latest_by_key
from millrace.session import scratch_dir
from millrace.sources.relational import Source, last_cursor, read_incremental
from millrace.streaming import changes as change_streams
from millrace.streaming import logins as login_streams
from millrace.streaming import sales
from millrace.streaming.pageviews import ingest_pageviews
from millrace.tables import Store

log = logging.getLogger(__name__)

CURSORS, QUALITY = "bronze.load_cursors", "silver.quality_report"
BUILT_FROM, DAY_KEYS = "silver.built_from", "silver.day_keys"
VIEWS, DAY_ACTIVITY, ACTIVITY = "silver.pageviews_by_items", "silver.day_activity", "silver.user_activity"
RELATIONAL_TABLES = ("users", "items", "purchases")  # fixed value


class StepsFailed(RuntimeError):
    """Some steps of a job failed after all of them were tried."""

    def __init__(self, job: str, failures: dict[str, Exception]):
        super().__init__(f"{job} failed for: {', '.join(failures)}")
        self.failures = failures


def run_all(job: str, steps: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent steps, keep going after a failure, raise at the end."""
    results: dict[str, object] = {}
    failures: dict[str, Exception] = {}
    for name, step in steps.items():
        try:
            results[name] = step()
        except Exception as error:
            log.exception("%s: step %s failed", job, name)
            failures[name] = error
    if failures:
        raise StepsFailed(job, failures)
    return results


def write_logged(store: Store, df: DataFrame, name: str, mode: str, run: str | None = None) -> int:
    """A-11: write a table and log how many rows it got."""
    rows = store.write(df, name, mode, run=run)
    log.info("%s: %s rows", name, rows)
    return rows


def load_pageviews(store: Store, path: str, checkpoint: str) -> None:
    """JOB-1."""
    ingest_pageviews(store, path, checkpoint)


def load_table(store: Store, source: Source, table: str, partitions: int, lookback: str) -> int:
    """One table of JOB-2; rows that do not fit the declared types are kept as rejected."""
    name = f"bronze.{table}"
    target = loaded_until(store, name)
    rows = read_incremental(source, table, target, partitions=partitions, lookback=lookback)
    if rows is None:
        return 0
    # The source is read once: what both writes see is this copy, whatever is committed meanwhile.
    path = scratch_dir(store.spark, f"staged-{table}")
    rows.write.parquet(path)
    staged = store.spark.read.schema(rows.schema).parquet(path)
    fitting, refused = schemas.conform(staged, name)
    # Refused rows go first: once the others are stored, the cursor has passed them all. Their run is named
    # after the cursor it began at, so a repeated run replaces them.
    if schemas.may_reject(staged, name):
        run = F.xxhash64(F.lit(name), F.lit(last_cursor(target, "updated_at", lookback)))
        store.write(refused.withColumn("batch_id", run), "bronze.rejected_rows")
    # The rows' run is named likewise: a run that died before it kept its cursor is replaced by the next one.
    begun = hashlib.sha256(f"{last_cursor(target, 'updated_at', lookback)}".encode()).hexdigest()[:16]
    written = write_logged(store, fitting, name, "append", begun)
    reached = staged.agg(F.lit(name).alias("table_name"), F.max("updated_at").alias("updated_at"))
    store.write(reached.filter("updated_at IS NOT NULL"), CURSORS, "overwrite")
    return written


def loaded_until(store: Store, name: str) -> DataFrame | None:
    """Rows whose newest ``updated_at`` is the cursor of a table: its kept cursor, or the table itself if it
    was filled by other means."""
    if store.exists(CURSORS):
        kept = store.read(CURSORS).filter(F.col("table_name") == name)
        if kept.first() is not None:
            return kept
    return store.read(name) if store.exists(name) else None


def load_tables(
    store: Store,
    source: Source,
    tables: Sequence[str] = RELATIONAL_TABLES,
    partitions: int = 10,
    lookback: str = "0 seconds",
) -> dict[str, object]:
    """JOB-2: every table is tried; rows per table are returned."""
    return run_all(
        "load tables",
        {t: lambda t=t: load_table(store, source, t, partitions, lookback) for t in tables},
    )


def build_silver(
    store: Store, newest_only: bool = False, since: str | None = None
) -> dict[str, object]:
    """JOB-3: full rebuild of the silver tables.

    ``newest_only`` keeps one version per id (DQ-2). ``since`` (yyyy-MM-dd) rebuilds purchases and
    pageviews from that day on only, reading and replacing just those days.
    """

    def bronze(table: str, start: str | None = None) -> DataFrame:
        df = store.read(f"bronze.{table}", start)
        return latest_by_key(df, "id", "updated_at") if newest_only else df

    mode = "replace" if since is None else "overwrite"
    return run_all(
        "build silver",
        {
            "users": lambda: write_logged(
                store, silver.users(bronze("users")), "silver.users", "replace"
            ),
            "items": lambda: write_logged(
                store, silver.items(bronze("items")), "silver.items", "replace"
            ),
            "purchases_enriched": lambda: write_logged(
                store,
                silver.purchases_enriched(
                    bronze("purchases", since), bronze("users"), bronze("items")
                ),
                "silver.purchases_enriched",
                mode,
            ),
            "pageviews_by_items": lambda: write_logged(
                store,
                silver.pageviews_by_items(store.read("bronze.pageviews", since), bronze("items")),
                "silver.pageviews_by_items",
                mode,
            ),
        },
    )


def _days(column: str, days: set[str | None]) -> Column:
    """Whether a day column is one of ``days`` (yyyy-MM-dd; None: no day)."""
    named = F.col(column).isin([dt.date.fromisoformat(d) for d in days if d])
    return named | F.col(column).isNull() if None in days else named


def _day_of(part: str) -> str | None:
    value = part.split("/")[0].partition("=")[2]
    return None if value.startswith("__HIVE") else value


def refresh_silver(store: Store) -> dict[str, int]:
    """JOB-3, J-1, J-2: rebuild only the days whose bronze rows are new or hold a user or item with a new version.

    What was used is kept: the partition copies of the relational tables and the last batch of the pageviews. Ids of
    new dimension rows find the days through bitmaps of each day's ids. Days that nothing touches are neither read
    nor written. Returns the rows written per table. Bronze must be Parquet, as only there copies have names.
    """
    built: dict[str, set[str]] = {}
    if store.exists(BUILT_FROM):
        for row in store.read(BUILT_FROM).collect():  # as many rows as bronze has partition copies
            built.setdefault(row.table_name, set()).add(row.part)
    live = {t: store.partitions(f"bronze.{t}") for t in RELATIONAL_TABLES}
    fresh = {t: [p for p in live[t] if p not in built.get(t, ())] for t in RELATIONAL_TABLES}
    views = store.read("bronze.pageviews")
    batch = views.agg(F.max("batch_id")).first()[0]
    seen = max(map(int, built.get("pageviews", ())), default=-1)
    new_views = views.filter(F.col("batch_id") > seen).select(F.col("received_day").cast("string")).distinct()

    changed = None
    for table, key in (("users", "user_id"), ("items", "item_id")):
        ids = store.read_partitions(f"bronze.{table}", fresh[table]).select(F.lit(key).alias("key"), "id")
        changed = ids if changed is None else changed.unionAll(ids)
    days = {
        "purchases": {_day_of(p) for p in fresh["purchases"]},
        "pageviews": {row[0] for row in new_views.collect()},
    }
    if store.exists(DAY_KEYS):
        for fact in days:
            held = store.read(DAY_KEYS).filter(F.col("fact") == fact)
            found = day_keys.days_with(held, changed).select(F.col("day").cast("string"))
            days[fact] |= {row[0] for row in found.collect()}

    users, items = store.read("bronze.users"), store.read("bronze.items")
    bought = store.read("bronze.purchases").filter(_days("created_day", days["purchases"]))
    viewed = views.filter(_days("received_day", days["pageviews"]))
    written = {}
    if fresh["users"]:
        touched = users.filter(_days("created_day", {_day_of(p) for p in fresh["users"]}))
        written["users"] = write_logged(store, silver.users(touched), "silver.users", "overwrite")
    if fresh["items"]:
        written["items"] = write_logged(store, silver.items(items), "silver.items", "replace")
    user_and_item = {"user_id": F.col("user_id"), "item_id": F.col("item_id")}
    item_of_url = {"item_id": cleaning.item_id_of(F.col("url"))}
    enriched, by_items = silver.purchases_enriched(bought, users, items), silver.pageviews_by_items(viewed, items)
    for fact, rows, day, made, name, keys in (
        ("purchases", bought, "created_day", enriched, "silver.purchases_enriched", user_and_item),
        ("pageviews", viewed, "received_day", by_items, "silver.pageviews_by_items", item_of_url),
    ):
        if days[fact]:
            written[fact] = write_logged(store, made, name, "overwrite")
            bitmaps = day_keys.day_bitmaps(rows, F.col(day), keys).withColumn("fact", F.lit(fact))
            store.write(bitmaps, DAY_KEYS, mode="overwrite")
    parts = [(t, p) for t in RELATIONAL_TABLES for p in live[t]]
    parts += [] if batch is None else [("pageviews", str(batch))]
    store.write(store.spark.createDataFrame(parts, "table_name string, part string"), BUILT_FROM, mode="replace")
    return written


def report_quality(store: Store) -> int:
    """DQ-1: the rules of users, items and purchases over the stored tables; returns the number of rows
    that failed some rule, and logs it."""
    checks = {
        "users": ("silver.users", quality.USER_RULES),
        "items": ("silver.items", quality.ITEM_RULES),
        "purchases": ("bronze.purchases", quality.PURCHASE_RULES),
    }
    reports = [quality.quality_report(store.read(t), n, rules) for n, (t, rules) in checks.items()]
    write_logged(store, reports[0].unionAll(reports[1]).unionAll(reports[2]), QUALITY, "replace")
    failed = store.read(QUALITY).agg(F.coalesce(F.sum("failed"), F.lit(0))).first()[0]
    log.info("%s: %s failures", QUALITY, failed)
    return failed


def build_gold(store: Store) -> dict[str, int]:
    """JOB-4: stops at the first failure."""
    bought = store.read("silver.purchases_enriched")
    seen = store.read("silver.pageviews_by_items")
    results = {
        "gold.top_selling_items": gold.top_selling_items(bought),
        "gold.sales_performance_24h": gold.sales_by_hour(bought),
        "gold.pageviews_by_channel": gold.pageviews_by_channel(seen),
        "gold.top_converting_items": gold.top_converting_items(seen, bought),
    }
    return {name: write_logged(store, df, name, "replace") for name, df in results.items()}


def refresh_activity(store: Store) -> int:
    """A-5, J-4: bring the kept activity of users up to date with the pageviews of silver; returns the number of days
    taken up.

    Only days whose partition copies changed are read, and only their 64-day words rewritten. What a day gave is
    kept, so a day that comes again, or is gone, is first taken back. The words and the list of days they hold are
    published as one; a run that dies before that leaves the old list, and the next run does the same days again.
    One refresh may run at a time.
    """
    live: dict[str, list[str]] = {}
    for part in store.partitions(VIEWS):
        live.setdefault(part.split("/")[0], []).append(part)
    kept = store.read(ACTIVITY) if store.exists(ACTIVITY) else store.read_partitions(ACTIVITY, [])
    listed = kept.filter("part = 'folded' AND folded_from IS NOT NULL").collect()  # a row per day
    held = {r.folded_day: (r.folded_from, r.version) for r in listed}
    now = {day: " ".join(sorted(parts)) for day, parts in live.items()}
    stale = {day for day in {*now, *held} if now.get(day) != held.get(day, (None,))[0]}
    if not stale and store.exists(ACTIVITY):
        return 0
    version = uuid.uuid4().hex
    named = {folder: _day_of(folder) or "none" for folder in stale}
    # Other versions of a day come from runs that died.
    pairs = [(named[d], v) for d in stale for v in {version, held.get(d, (None, version))[1]}]
    wanted = store.spark.createDataFrame(pairs, "activity_day string, version string")

    def of_days() -> DataFrame:
        known = store.exists(DAY_ACTIVITY)
        rows = store.read(DAY_ACTIVITY) if known else store.read_partitions(DAY_ACTIVITY, [])
        rows = rows.filter(F.col("activity_day").isin([*named.values()]))
        return rows.join(wanted, ["activity_day", "version"], "left_semi").select("user_id", "day", "views", "version")

    fresh = store.read_partitions(VIEWS, [part for day in stale for part in live.get(day, ())])
    came = segments.views_by_day(fresh).withColumn("version", F.lit(version))
    store.write(came.unionByName(of_days()), DAY_ACTIVITY, mode="overwrite")

    sign = F.when(F.col("version") == version, 1).otherwise(-1)
    words = [activity.word_name(None if d == "none" else d) for d in named.values()]
    folded = activity.fold_days(kept.filter(F.col("part").isin(words)), of_days().withColumn("sign", sign))
    state = {day: (now[day], version) if day in stale else held[day] for day in now}
    # The first row keeps the list a partition of its own even when no day is left.
    rows = [("", None, version), *((day, *source) for day, source in state.items())]
    names = store.spark.createDataFrame(rows, "folded_day string, folded_from string, version string")
    store.write(folded.unionByName(names, allowMissingColumns=True), ACTIVITY, mode="overwrite")
    return len(stale)


def segment_users(store: Store, day: str, folder: str) -> str:
    """JOB-5: a rerun replaces the day's partition and its export (D-8). Only views of days that are new or changed
    since the last run are read."""
    users = store.read("silver.users")
    if store.catalog:  # its tables have no named partition copies
        df = segments.user_engagement_segments(users, store.read(VIEWS), day)
    else:
        refresh_activity(store)
        words = store.read(ACTIVITY).filter(F.col("part") != "folded")
        df = segments.segments_of(users, activity.activity_of_users(words), day)
    write_logged(store, df, "gold.user_engagement_segments", "overwrite")
    return segments.export_segments(store.read("gold.user_engagement_segments"), day, folder)


def watch_logins(
    store: Store,
    logins: DataFrame,
    geo: DataFrame,
    checkpoints: str,
    state_partitions: int | None = None,
    max_files: int | None = None,
    joined: bool = False,
    repeats_within: str | None = None,
) -> None:
    """JOB-6: enrich, then look for anomalies in the enriched log, ``max_files`` of it at a time; ``joined`` does so
    by Spark's join state instead of kept cells, ``repeats_within`` keeps repeated messages out of the log."""
    login_streams.ingest_logins(store, logins, geo, f"{checkpoints}/logins", repeats_within, state_partitions)
    if joined:
        login_streams.write_joined_anomalies(store, f"{checkpoints}/joined", state_partitions, max_files)
        return
    login_streams.write_anomalies(
        store,
        store.read_stream("rt.login_events_enriched", max_files),
        f"{checkpoints}/anomalies",
        state_partitions,
    )


def follow_purchases(store: Store, messages: DataFrame, checkpoints: str) -> None:
    """JOB-7: the log, the newest versions, and the sales that the dashboards read."""
    change_streams.ingest_purchase_changes(store, messages, f"{checkpoints}/purchases")
    if change_streams.keep_newest(store):
        sales.fold_sales(store)


def follow_items(
    store: Store, messages: DataFrame, checkpoints: str, destination: str = "items"
) -> None:
    """JOB-8: messages of several topics may come together; those whose topic leads elsewhere than to
    ``destination`` are left to other runs (SNK-7). Messages without a topic all belong here."""
    if "topic" in messages.columns:
        messages = messages.filter(changes.destination_of(F.col("topic")) == destination)
    change_streams.ingest_item_changes(store, messages, f"{checkpoints}/{destination}")


def embed_reviews(store: Store, make_encoder: Callable[[], Encoder]) -> int:
    """JOB-9: make the missing embeddings, write them back to the reviews and return their number. An error
    leaves no part of the run behind. Runs that overlap may make an embedding twice; one is used."""
    made = store.read("rt.review_embeddings") if store.exists("rt.review_embeddings") else None
    reviews = store.read("rt.reviews")
    todo = vectors.without_embedding(reviews, made).filter("review IS NOT NULL")
    written = write_logged(
        store, vectors.new_embeddings(todo, make_encoder), "rt.review_embeddings", "append"
    )
    if written:
        made = store.read("rt.review_embeddings")
        if store.catalog:
            store.write(vectors.write_back(reviews, made), "rt.reviews", mode="replace")
            return written
        # Only the buckets of reviews that lack an embedding made by now are read whole and rewritten.
        lacking = reviews.filter(F.col("review_embedding").isNull()).select("review_id", "bucket")
        touched = lacking.join(made.select("review_id"), "review_id", "left_semi").select("bucket").distinct()
        buckets = [row.bucket for row in touched.collect()]  # schemas.BUCKETS at most
        old = reviews.filter(F.col("bucket").isin(buckets))
        new = made.filter(F.expr(schemas.bucket_of("review_id")).isin(buckets))
        store.write(vectors.write_back(old, new), "rt.reviews", mode="overwrite")
    return written


def full_run(store: Store, source: Source, pageviews: str, checkpoints: str) -> None:
    """JOB-10: stops at the first failing step."""
    for layer in ("bronze", "silver", "gold"):
        store.ensure(layer)
    load_tables(store, source)
    load_pageviews(store, pageviews, f"{checkpoints}/pageviews")
    build_silver(store)
    report_quality(store)
    build_gold(store)
