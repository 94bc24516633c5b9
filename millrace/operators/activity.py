"""Kept activity of users: the active days as bits of 64-day words, and the views (A-5, J-4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import times

WORD = 64  # days whose bits one bigint holds


def word_of(day: Column) -> Column:
    """The 64-day word of a day."""
    return times.floor_div(F.unix_date(day), WORD)


def word_name(day: str | None) -> str:
    """The partition of a day's word; 'none' for rows without a day."""
    return "none" if day is None else str((dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days // WORD)


def fold_days(kept: DataFrame, changes: DataFrame) -> DataFrame:
    """``kept`` (user_id, word, days, views) after ``changes`` (user_id, day, views, sign).

    A change of sign -1 takes a day as it was held before, one of sign 1 adds it as it is now; a day that is
    both taken and added stays. Rows without a day have views but no word and no bit. One aggregate by
    (user, word), combined map-side; a user has one kept row and at most 128 changes per word.
    """
    bit = F.expr(f"shiftleft(1L, cast(pmod(unix_date(day), {WORD}) AS int))")
    bit = F.coalesce(bit, F.lit(0).cast("bigint"))
    taken, added = F.col("sign") < 0, F.col("sign") > 0
    none = F.lit(0).cast("bigint")
    moved = changes.select(
        "user_id",
        word_of(F.col("day")).alias("word"),
        none.alias("held"),
        F.when(taken, bit).otherwise(none).alias("cleared"),
        F.when(added, bit).otherwise(none).alias("set"),
        (F.col("views") * F.col("sign")).alias("views"),
    )
    before = kept.select("user_id", "word", F.col("days").alias("held"), none.alias("cleared"), none.alias("set"), "views")
    return (
        before.unionAll(moved)
        .groupBy("user_id", "word")
        .agg(*[F.bit_or(c).alias(c) for c in ("held", "cleared", "set")], F.sum("views").alias("views"))
        .select(
            "user_id",
            "word",
            F.expr("(held & ~cleared) | set").alias("days"),
            "views",
        )
    )


def activity_of_users(kept: DataFrame) -> DataFrame:
    """(user_id, views, active_days, last_active_date) from the kept words."""
    highest = F.col("word") * WORD + F.length(F.bin("days")) - 1  # place of the greatest bit
    last = F.when(F.col("days") != 0, F.date_from_unix_date(highest.cast("int")))
    return kept.groupBy("user_id").agg(
        F.sum("views").alias("views"),
        F.sum(F.bit_count("days")).alias("active_days"),
        F.max(last).alias("last_active_date"),
    )
