"""Login enrichment and new-country anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.functions import cleaning, times
from millrace.operators.latest import latest_by_key

REASON = "Login from new country"  # fixed value
SECOND = 1_000_000
LOOKBACK, MIN_GAP = 7 * 86_400 * SECOND, SECOND  # fixed values, in microseconds


def classify_logins(logins: DataFrame) -> DataFrame:
    """P-10, P-11: event time and device type."""
    return logins.withColumns(
        {
            "timestamp": times.from_iso(F.col("timestamp")),
            "device_type": cleaning.device_type(F.col("device")),
        }
    )


def _time_read() -> Column:
    return times.from_iso(F.col("timestamp")).isNotNull()


def readable(logins: DataFrame) -> DataFrame:
    """Logins whose time can be read."""
    return logins.filter(_time_read())


def unreadable(logins: DataFrame) -> DataFrame:
    """The others, as error rows with the login as JSON."""
    rows = logins.filter(~_time_read())
    return rows.select(
        F.lit("unreadable time").alias("_error"), F.to_json(F.struct("*")).alias("_raw_message")
    )


def geo_join(logins: DataFrame, geo: DataFrame) -> DataFrame:
    """J-5: country and city of every prefix that starts ``ip``; NULLs where none does.

    Prefix matching becomes equality: a prefix equals one of the heads of the IP. Each distinct IP is
    looked up once by its heads and joined back, whatever the size of the prefix table; the
    planner picks each join by measured size, and hot IPs shrink to one row for the lookup and
    are split by the adaptive skew join on the way back. For batch input, in a stream inside
    ``foreachBatch``.
    """
    geo = geo.filter(F.col("ip_prefix").isNotNull()).select("ip_prefix", "country", "city")
    heads = F.transform(
        F.sequence(F.lit(0), F.length("ip")), lambda n: F.substring(F.col("ip"), F.lit(1), n)
    )
    resolved = (
        logins.select("ip")
        .distinct()
        .select(F.col("ip").alias("_ip"), F.explode(heads).alias("ip_prefix"))
        .join(geo, "ip_prefix")
        .select("_ip", "country", "city")
    )
    return logins.join(resolved, F.col("ip") == F.col("_ip"), "left").drop("_ip")


def enrich_logins(logins: DataFrame, geo: DataFrame) -> DataFrame:
    """P-10, P-11, J-5."""
    keep = [c for c in logins.columns if c not in ("device", "user_agent", "device_type")]
    return geo_join(classify_logins(logins), geo).select(*keep, "device_type", "country", "city")


def upserted(log: DataFrame) -> DataFrame:
    """SNK-6: a login or anomaly log as a keyed table, the last written row per user and time."""
    wanted = [c for c in log.columns if c not in ("batch_id", "event_day")]
    return latest_by_key(log, ["user_id", "timestamp"], "batch_id", wanted)


def open_cells(cells: DataFrame, gap: int = MIN_GAP, reach: int = LOOKBACK) -> DataFrame:
    """The cells that can still hold an anomaly, with the instants next to them.

    ``cells``: user_id, country, _cell (microseconds // gap), first_us, last_us; once each. Only the
    newest earlier login matters, and it sits in one of the two cells before. Cells look back
    over two neighbours inside time buckets, so one busy user is spread over many tasks.
    """
    keys = ["user_id", "country"]
    back = -(-reach // gap) + 1  # cells a login can look back over
    span = 4 * back  # cells per bucket
    home = times.floor_div(F.col("_cell"), span)
    tail = F.pmod(F.col("_cell"), F.lit(span).cast("bigint")) >= span - back
    # The end of a bucket is repeated in the next one, where it is only looked back at.
    placed = cells.withColumn(
        "_bucket", F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    order = Window.partitionBy(*keys, "_bucket").orderBy("_cell")
    adjacent = F.lag("_cell").over(order) == F.col("_cell") - 1
    near = F.when(adjacent, F.lag("first_us").over(order))
    before = F.when(adjacent, F.lag("last_us", 2).over(order)).otherwise(
        F.lag("last_us").over(order)
    )
    return (
        placed.withColumns({"_near": near, "_before": before})
        .filter(F.col("_bucket") == home)
        .filter(
            (F.col("_near").isNull() | (F.col("first_us") < F.col("_near") + gap))
            & (F.col("_before").isNull() | (F.col("last_us") > F.col("_before") + reach))
        )
        .drop("_bucket")
    )


def unseen(at: Column, gap: int = MIN_GAP, reach: int = LOOKBACK) -> Column:
    """Whether an instant in an open cell has no login between ``reach`` and ``gap`` before it."""
    return (F.col("_near").isNull() | (at < F.col("_near") + gap)) & (
        F.col("_before").isNull() | (at > F.col("_before") + reach)
    )


def nowhere(enriched: DataFrame) -> DataFrame:
    """Logins without user or country: an unknown country never counts as seen, so they all fire."""
    unknown = F.col("country").isNull() | F.col("user_id").isNull()
    return enriched.filter(unknown).select(
        "user_id", "timestamp", F.lit(REASON).alias("reason"), "country"
    )


def login_anomalies(
    enriched: DataFrame, lookback: str = "7 days", min_gap: str = "1 second"
) -> DataFrame:
    """J-6: logins without one of the same user and country between ``lookback`` and ``min_gap``
    earlier, both ends included. An unknown country never counts as seen, so it always fires.

    Logins first shrink to cells (``min_gap`` wide) with their first and last time, a count
    bounded by time and not by traffic; only cells that can still hold an anomaly, normally a
    small part, meet the logins again. Logins of unknown country pass by without a shuffle.
    ``enriched`` is read three times, so it should be a stored table.
    """
    gap, reach = times.interval_micros(min_gap), times.interval_micros(lookback)
    keys = ["user_id", "country", "_cell"]
    known = enriched.filter("country IS NOT NULL AND user_id IS NOT NULL")
    placed = known.withColumn("_us", F.unix_micros("timestamp")).withColumn(
        "_cell", times.floor_div(F.col("_us"), gap)
    )
    cells = placed.groupBy(*keys).agg(F.min("_us").alias("first_us"), F.max("_us").alias("last_us"))
    fired = placed.join(open_cells(cells, gap, reach).drop("first_us", "last_us"), keys).filter(
        unseen(F.col("_us"), gap, reach)
    )
    shown = fired.select("user_id", "timestamp", F.lit(REASON).alias("reason"), "country")
    return shown.unionAll(nowhere(enriched))
