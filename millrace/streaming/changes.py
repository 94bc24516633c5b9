"""Change streams into log tables (W-3, W-4, W-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from millrace import schemas
from millrace.operators import changes
from millrace.streaming import sales
from millrace.streaming.run import run_stream, shared_scan
from millrace.tables import Store


def ingest_purchase_changes(store: Store, messages: DataFrame, checkpoint: str) -> None:
    """W-4: ``messages`` has the JSON text of one change per row in ``value``; readable rows go to
    the purchases log, the others to the error table."""

    def good(batch: DataFrame, n: int) -> None:
        rows = changes.valid_purchases(batch).withColumn("ingested_at", F.current_timestamp())
        store.write(rows, "rt.purchases", batch_id=n)

    def bad(batch: DataFrame, n: int) -> None:
        rows = changes.purchase_errors(batch).withColumn("ingested_at", F.current_timestamp())
        store.write(rows, "rt.purchases_errors", batch_id=n)

    def decode(batch: DataFrame) -> DataFrame:
        return changes.decode_changes(batch, limits=changes.PURCHASE_LIMITS)

    run_stream(messages, shared_scan(good, bad, prepare=decode), checkpoint)


def ingest_item_changes(store: Store, messages: DataFrame, checkpoint: str) -> None:
    """SRC-4, P-22: change envelopes as JSON text in ``value`` into the item log, unreadable ones into the
    error table."""

    def good(batch: DataFrame, n: int) -> None:
        rows = batch.filter(F.col("_error") == "")
        store.write(
            rows.withColumn("__deleted", F.col("__deleted").cast("boolean")), "rt.items", batch_id=n
        )

    def bad(batch: DataFrame, n: int) -> None:
        rows = changes.purchase_errors(batch).withColumn("ingested_at", F.current_timestamp())
        store.write(rows, "rt.items_errors", batch_id=n)

    run_stream(messages, shared_scan(good, bad, prepare=changes.decode_items), checkpoint)


LOG, NEWEST = "rt.purchases", "rt.purchases_newest"


def _kept_and_later(store: Store) -> tuple[DataFrame | None, int | None, DataFrame]:
    """The kept newest versions, if there are any, the batch they reach, and the later part of the log."""
    log = store.read(LOG)
    if not store.exists(NEWEST):
        return None, None, log
    kept = store.read(NEWEST)
    last = kept.agg(F.max("last_batch")).first()[0]
    return kept, last, log if last is None else log.filter(F.col("batch_id") > last)


def newest_purchases(store: Store, since: str | None = None) -> DataFrame:
    """W-3: the newest version of every purchase, from the kept ones and the later log.

    A kept row stands unless the later log has its id; only those few ids are reduced again.
    ``since`` (a time) leaves out purchases made before.
    """
    kept, _, later = _kept_and_later(store)
    names = [c for c in schemas.TABLES[NEWEST].schema.names if c != "last_batch"]
    log = later.select(*names, "batch_id")
    if kept is None:
        found = changes.latest_purchases(log)
    else:
        touched = log.select("id").distinct()
        again = kept.join(touched, "id", "left_semi").withColumn("batch_id", F.col("last_batch"))
        moved = changes.latest_purchases(log.unionByName(again.select(*log.columns)))
        still = kept.join(touched, "id", "left_anti")
        found = still.select(*moved.columns).unionByName(moved)
    return found if since is None else found.filter(F.col("created_at") >= F.lit(since).cast("timestamp"))


def keep_newest(store: Store) -> int:
    """W-3, A-6 to A-8: fold the later log into the kept newest versions; returns the number of ids in it.

    Only the hash buckets that the later log touches are read and rewritten. What the fold changes in the sales
    goes to ``rt.sales_changes`` first: the version that a purchase had is taken off its hour and item, the one it
    gets is added. A fold that died after that is taken up again with the same batches, so its changes replace
    themselves; until a fold is through, ``rt.sales_position`` keeps them from being read. One fold at a time.
    """
    kept, reached, later = _kept_and_later(store)
    last = _unfinished(store, reached)
    if last is None:
        last = later.agg(F.max("batch_id")).first()[0]
    if last is None:
        if reached is not None:
            sales.set_position(store, reached)
        return 0
    names = [c for c in schemas.TABLES[NEWEST].schema.names if c != "last_batch"]
    rows = later.filter(F.col("batch_id") <= last).select(*names, "batch_id")
    newest = changes.latest_by_key(rows, "id", changes.versions_of(rows, "updated_at"), names)
    bucket = F.expr(schemas.bucket_of("id"))
    fresh = newest.withColumn("bucket", bucket).persist(StorageLevel.DISK_ONLY)
    try:
        touched = [row.bucket for row in fresh.select("bucket").distinct().collect()]  # BUCKETS at most
        new = fresh.select("id", F.struct(*names).alias("new"))
        if kept is None:
            met = new.withColumn("old", F.lit(None).cast(new.schema["new"].dataType))
        else:
            old = kept if store.catalog else kept.filter(F.col("bucket").isin(touched))
            old = old.select("id", F.struct(*names).alias("old"))
            met = old.join(new, "id", "full")
        # Batches after the kept ones are later in the log, so of equal times the new row wins.
        wins = F.col("old").isNull() | (F.col("new.updated_at") >= F.col("old.updated_at"))
        met = met.withColumn("now", F.when(F.col("new").isNotNull() & wins, F.col("new")).otherwise(F.col("old")))
        met = met.persist(StorageLevel.DISK_ONLY)
        try:
            changed = met.filter(F.col("new").isNotNull() & wins).select("old", "now")
            store.write(sales.signed_changes(changed), sales.CHANGES, batch_id=last)
            store.write(met.select("now.*", F.lit(last).alias("last_batch")), NEWEST, mode="replace" if store.catalog else "overwrite")
        finally:
            met.unpersist()
        folded = fresh.count()
    finally:
        fresh.unpersist()
    sales.set_position(store, last)
    return folded


def _unfinished(store: Store, reached: int | None) -> int | None:
    """The last batch of a fold that left its sales changes but not its newest versions."""
    if not store.exists(sales.CHANGES):
        return None
    batches = store.read(sales.CHANGES)
    if reached is not None:
        batches = batches.filter(F.col("batch_id") > reached)
    return batches.agg(F.max("batch_id")).first()[0]
