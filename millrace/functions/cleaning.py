"""Row-level rules for users, items, purchases, pageviews and logins (P-1 .. P-18)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns and words that decide results.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PAGE_PATTERN = r"^/([^/]+)/\d+$"
ITEM_ID_PATTERN = r"/(\d+)$"
MOBILE_WORDS = ("iphone", "android")


def is_valid_email(email: Column) -> Column:
    """P-1: NULL stays NULL."""
    return email.rlike(EMAIL_PATTERN)


def full_name(first: Column, last: Column) -> Column:
    """P-2: NULL parts are skipped."""
    return F.concat_ws(" ", first, last)


def floor_at_zero(amount: Column) -> Column:
    """P-3: negative becomes 0, NULL stays NULL."""
    return F.when(amount < 0, F.lit(0)).otherwise(amount)


def page_of(url: Column) -> Column:
    """P-6: '' where the whole path is not /<page>/<digits>."""
    return F.regexp_extract(url, PAGE_PATTERN, 1)


def item_id_of(url: Column) -> Column:
    """P-6: trailing digits as a long; NULL where there are none or they overflow."""
    return F.regexp_extract(url, ITEM_ID_PATTERN, 1).try_cast("bigint")


def device_type(device: Column) -> Column:
    """P-10: NULL and unknown devices count as desktop."""
    name = F.lower(device)
    mobile = F.lit(False)
    for word in MOBILE_WORDS:
        mobile = mobile | name.contains(word)
    return F.when(mobile, F.lit("mobile")).otherwise(F.lit("desktop"))


def conversion_rate(purchases: Column, pageviews: Column) -> Column:
    """P-18: 0.0 without pageviews."""
    return F.when(pageviews == 0, F.lit(0.0)).otherwise(purchases.cast("double") / pageviews)
