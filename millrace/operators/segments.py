"""Daily user engagement segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The segment rule (P-19).
HIGH_VIEWS, HIGH_DAYS = 50, 3
MEDIUM_VIEWS, MEDIUM_VIEWS_MAX, MEDIUM_DAYS = 10, 49, 7


def views_by_day(pageviews: DataFrame) -> DataFrame:
    """The views of each user on each day, combined map-side."""
    day = F.to_date("received_at").alias("day")
    return pageviews.groupBy("user_id", day).agg(F.count("page").alias("views"))


def user_engagement_segments(users: DataFrame, pageviews: DataFrame, as_of: str) -> DataFrame:
    """J-4, A-5, P-16, P-19 for the day ``as_of`` (yyyy-MM-dd).

    Views shrink to one row per (user, day) and then per user before they meet the users, so a
    user with a third of all views costs one row.
    """
    activity = views_by_day(pageviews).groupBy("user_id").agg(
        F.sum("views").alias("views"),
        F.count("day").alias("active_days"),
        F.max("day").alias("last_active_date"),
    )
    return segments_of(users, activity, as_of)


def segments_of(users: DataFrame, activity: DataFrame, as_of: str) -> DataFrame:
    """The segments, given (user_id, views, active_days, last_active_date) once per user. Users count once per
    (id, email, full_name); copies multiply the view count as the row-level join would."""
    people = (
        users.filter("valid_email")
        .groupBy(F.col("id").alias("user_id"), "email", "full_name")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    today = F.lit(as_of).cast("date")
    views = F.col("total_pageviews")
    idle = F.col("days_since_last_active")
    return (
        people.join(activity, "user_id", "left")
        .select(
            "user_id",
            "email",
            "full_name",
            (F.col("copies") * F.coalesce("views", F.lit(0))).alias("total_pageviews"),
            F.coalesce("active_days", F.lit(0)).cast("bigint").alias("active_days"),
            "last_active_date",
            F.datediff(today, "last_active_date").cast("bigint").alias("days_since_last_active"),
        )
        .withColumn(
            "engagement_segment",
            F.when((views >= HIGH_VIEWS) & (idle <= HIGH_DAYS), "high_engagement")
            .when(
                views.between(MEDIUM_VIEWS, MEDIUM_VIEWS_MAX) & (idle <= MEDIUM_DAYS),
                "medium_engagement",
            )
            .otherwise("low_engagement"),
        )
        .withColumn("segment_date", today)
    )


def segments_of_day(segments: DataFrame, day: str) -> DataFrame:
    """P-20: one day's rows without the date column."""
    return segments.filter(F.col("segment_date") == F.lit(day).cast("date")).drop("segment_date")


def export_segments(segments: DataFrame, day: str, folder: str) -> str:
    """SNK-8: CSV of one day below ``folder/<day>``, written by all tasks, replaced on a rerun."""
    target = f"{folder.rstrip('/')}/segmented_users_{day}"
    segments_of_day(segments, day).write.mode("overwrite").option("header", True).csv(target)
    return target
