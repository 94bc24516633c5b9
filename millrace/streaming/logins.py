"""Login enrichment and anomalies as streams (SRC-5, J-5, J-6, W-1, W-2, SNK-6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.functions import times
from millrace.operators import logins as rules
from millrace.streaming.run import run_stream, shared_scan
from millrace.tables import Store

DELAY = "5 seconds"  # fixed value: how late an event may arrive
LATE_POSITION = "rt.login_late_position"
SPAN = "1 minute"  # width of the cells of the joined form, which fires that much later


def ingest_logins(
    store: Store,
    logins: DataFrame,
    geo: DataFrame,
    checkpoint: str,
    repeats_within: str | None = None,
    state_partitions: int | None = None,
) -> None:
    """Enrich every batch and add it to the login log; a login without a readable time goes to the
    error table, before any watermark.

    SNK-6: with ``repeats_within``, an interval such as '10 minutes', a message that repeats the user and time of
    one before it is left out, across batches too, so the log has one row per key. Spark keeps the keys of that
    interval and drops logins that come later than it. Errors are then read by a stream of their own.
    """

    def good(batch: DataFrame, n: int) -> None:
        rows = rules.enrich_logins(rules.readable(batch), geo)
        store.write(rows, "rt.login_events_enriched", batch_id=n)

    def unread(rows: DataFrame, n: int) -> None:
        store.write(rows.withColumn("ingested_at", F.current_timestamp()), "rt.login_errors", batch_id=n)

    def bad(batch: DataFrame, n: int) -> None:
        unread(rules.unreadable(batch), n)

    if repeats_within is None:
        run_stream(logins, shared_scan(good, bad), checkpoint)
        return
    timed = rules.readable(logins).withColumn("_at", times.from_iso(F.col("timestamp")))
    once = timed.withWatermark("_at", repeats_within).dropDuplicatesWithinWatermark(["user_id", "_at"]).drop("_at")
    run_stream(once, good, f"{checkpoint}/once", state_partitions)
    run_stream(rules.unreadable(logins), unread, f"{checkpoint}/errors")


def login_cells(enriched: DataFrame, delay: str = DELAY) -> DataFrame:
    """W-1, W-7: per user, country and second the distinct instants of the logins, once the watermark has
    passed the second; later logins are dropped and counted by Spark.

    Combined map-side. A second has at most a thousand instants, since times are cut to
    milliseconds, so a hot user's rows are bounded by time and not by traffic.
    """
    second = F.window("timestamp", "1 second")
    return (
        enriched.filter("country IS NOT NULL AND user_id IS NOT NULL")
        .withWatermark("timestamp", delay)
        .groupBy("user_id", "country", second.alias("second"))
        .agg(F.collect_set(F.unix_micros("timestamp")).alias("instants"))
        .select(
            "user_id",
            "country",
            F.col("second.start").alias("second"),
            F.array_sort("instants").alias("instants"),
        )
    )


def judge(store: Store, n: int) -> DataFrame:
    """W-2: the anomalies among the cells of batch ``n``, given the kept cells of the seven days before it.

    The batch rule does the work: windows over time buckets, no state in Python and no list per
    key. Cells of later batches are left out, so a replayed batch finds the same.
    """
    own = store.read("rt.login_cells").filter(F.col("batch_id") == n)
    start = own.agg(F.min("second") - F.expr("INTERVAL 8 DAYS")).first()[0]
    if start is None:
        return own.limit(0).selectExpr(
            "user_id", "second AS timestamp", "'' AS reason", "country"
        )
    kept = store.read("rt.login_cells", since=start.strftime("%Y-%m-%d")).filter(F.col("batch_id") <= n)
    cells = kept.select(
        "user_id",
        "country",
        times.floor_div(F.unix_micros("second"), rules.MIN_GAP).alias("_cell"),
        F.element_at("instants", 1).alias("first_us"),
        F.element_at("instants", -1).alias("last_us"),
        F.when(F.col("batch_id") == n, F.col("instants")).alias("instants"),
    )
    fired = (
        rules.open_cells(cells)
        .withColumn("at", F.explode("instants"))
        .filter(rules.unseen(F.col("at")))
    )
    return fired.select(
        "user_id",
        F.timestamp_micros("at").alias("timestamp"),
        F.lit(rules.REASON).alias("reason"),
        "country",
    )


def write_anomalies(
    store: Store, enriched: DataFrame, checkpoint: str, state_partitions: int | None = None
) -> None:
    """J-6 on a stream; ``enriched`` is the login log read as a stream, once for the logins of unknown
    country, which fire at once, and once for the others, whose closed seconds are kept and judged."""

    def unknown(batch: DataFrame, n: int) -> None:
        store.write(rules.nowhere(batch), "rt.login_unknown", batch_id=n)

    def known(batch: DataFrame, n: int) -> None:
        store.write(batch, "rt.login_cells", batch_id=n)
        store.write(judge(store, n), "rt.login_new_country", batch_id=n)

    run_stream(enriched, unknown, f"{checkpoint}/unknown")
    watermark = run_stream(login_cells(enriched), known, f"{checkpoint}/cells", state_partitions)
    keep_late(store, watermark)


def keep_late(store: Store, watermark: str | None) -> None:
    """W-7: the logins of known country that the watermark dropped, kept in ``rt.login_late``.

    They are the log's rows of closed seconds that no cell holds, whatever batches Spark made of the log; a login
    at an instant that a cell does hold was not missed. At the end of a run all that lies in the log has been seen, so
    the next run judges only later batches of it, against the cells of their days. Late rows keep the batch of
    their log, so a run that died and comes again adds nothing.
    """
    if watermark is None or store.catalog:
        return
    judged = store.read(LATE_POSITION).first().batch if store.exists(LATE_POSITION) else -1
    log = store.read("rt.login_events_enriched").filter(F.col("batch_id") > judged)
    closed = log.filter("country IS NOT NULL AND user_id IS NOT NULL").filter(
        F.date_trunc("second", "timestamp") + F.expr("INTERVAL 1 SECOND") <= F.lit(watermark).cast("timestamp")
    )
    upto, start = log.agg(F.max("batch_id"), F.min("event_day").cast("string")).first()
    if upto is None:
        return
    if start is not None and store.exists("rt.login_cells"):
        cells = store.read("rt.login_cells", since=start)
        held = cells.select("user_id", "country", F.explode("instants").alias("_us"))
        placed = closed.withColumn("_us", F.unix_micros("timestamp"))
        closed = placed.join(held, ["user_id", "country", "_us"], "left_anti")
    store.write(closed, "rt.login_late")
    position = store.spark.range(1).select(F.lit(upto).alias("batch"))
    store.write(position, LATE_POSITION, mode="replace")


def login_spans(enriched: DataFrame, span: str = SPAN, delay: str = DELAY) -> DataFrame:
    """Per user, country and span of time, once the watermark has passed it: first and last instant, and the
    opening instants, less than a second after the first. Combined map-side, so rows are bounded by time."""
    us = F.unix_micros("timestamp")
    opening = F.filter("instants", lambda at: at < F.col("first_us") + rules.MIN_GAP)
    return (
        enriched.filter("country IS NOT NULL AND user_id IS NOT NULL")
        .withWatermark("timestamp", delay)
        .groupBy("user_id", "country", F.window("timestamp", span).alias("span"))
        .agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.collect_set(us).alias("instants"))
        .select("user_id", "country", F.window_time("span").alias("closed"), "first_us", "last_us", opening.alias("opening"))
    )


def joined_anomalies(
    logins: DataFrame, earlier: DataFrame, span: str = SPAN, delay: str = DELAY
) -> DataFrame:
    """J-6, W-2 as a left outer join of two streams, both the login log, within the seven days before a login.

    Both sides shrink to spans first. Only a span's opening instants can fire, as later ones have the first
    before them; of an earlier span the first and last instant tell whether a login lies in reach. So an instant
    meets at most the 10,080 minutes of seven days, however busy the user. The watermark drops spans of the right
    side after seven days and one span, and lets a login fire as soon as no earlier span can come.
    ``span`` is at least a second and at most a day.
    """
    if not rules.MIN_GAP <= times.interval_micros(span) <= 86_400 * rules.SECOND:
        raise ValueError(f"span {span!r} is not between a second and a day")
    asked = login_spans(logins, span, delay).select(
        "user_id", "country", F.col("closed").alias("at_closed"), F.explode("opening").alias("at")
    )
    seen = login_spans(earlier, span, delay).select(
        F.col("user_id").alias("seen_user"), F.col("country").alias("seen_country"), "closed", "first_us", "last_us"
    )
    within = (
        (F.col("user_id") == F.col("seen_user"))
        & (F.col("country") == F.col("seen_country"))
        & (F.col("closed") < F.col("at_closed"))
        & (F.col("closed") >= F.col("at_closed") - F.expr(f"INTERVAL 7 DAYS + INTERVAL {span}"))
        & (F.col("first_us") <= F.col("at") - rules.MIN_GAP)
        & (F.col("last_us") >= F.col("at") - rules.LOOKBACK)
    )
    return (
        asked.join(seen, within, "left_outer")
        .filter("seen_user IS NULL")
        .select("user_id", F.timestamp_micros("at").alias("timestamp"), F.lit(rules.REASON).alias("reason"), "country")
    )


def write_joined_anomalies(
    store: Store,
    checkpoint: str,
    state_partitions: int | None = None,
    max_files: int | None = None,
    span: str = SPAN,
) -> None:
    """J-6 over the stored login log by Spark's own join state, instead of kept cells (``write_anomalies``). Each
    store takes one of the two forms."""

    def write(name: str) -> Callable[[DataFrame, int], None]:
        return lambda batch, n: store.write(batch, name, batch_id=n)

    def log() -> DataFrame:
        return store.read_stream("rt.login_events_enriched", max_files)

    run_stream(rules.nowhere(log()), write("rt.login_unknown"), f"{checkpoint}/unknown")
    found = joined_anomalies(log(), log(), span)
    run_stream(found, write("rt.login_new_country"), f"{checkpoint}/joined", state_partitions)


def read_anomalies(store: Store) -> DataFrame:
    """SNK-6: all anomalies written so far, whichever of the two streams found them."""
    columns = ["user_id", "timestamp", "reason", "country"]
    both = [store.read(name).select(*columns) for name in ("rt.login_unknown", "rt.login_new_country") if store.exists(name)]
    return both[0] if len(both) == 1 else both[0].unionAll(both[1])
