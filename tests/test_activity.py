"""Kept activity of users: folded by day, against the segments of all views at once."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import activity, segments
from millrace.plans import jobs
from millrace.tables import Store

VIEW = "user_id long, page string, received_at timestamp"
START = dt.datetime(2023, 11, 1)


def write_views(store, rows, mode="overwrite"):
    df = store.spark.createDataFrame(rows, VIEW)
    rest = {c: F.lit(None) for c in ("item_id", "item_name", "item_category", "channel")}
    store.write(df.withColumns(rest), jobs.VIEWS, mode=mode)


def kept(store):
    words = store.read(jobs.ACTIVITY).filter("part != 'folded'")
    rows = activity.activity_of_users(words).collect()
    return {r.user_id: (r.views, r.active_days, r.last_active_date) for r in rows if r.views or r.active_days}


def expected(store):
    out = {}
    for r in store.read(jobs.VIEWS).collect():
        views, days = out.setdefault(r.user_id, [0, set()])
        out[r.user_id][0] = views + (r.page is not None)
        days.update([r.received_at.date()] if r.received_at else [])
    return {u: (v, len(d), max(d, default=None)) for u, (v, d) in out.items() if v or d}


def random_views(rng, days, n):
    rows = []
    for _ in range(n):
        user = 1 if rng.random() < 0.33 else rng.choice([None, *range(2, 12)])
        day = rng.choice(days)
        at = None if day is None else START + dt.timedelta(days=day, seconds=rng.randint(0, 86_399))
        rows.append((user, rng.choice(["a", "b", None]), at))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_days(spark, tmp_path, seed):
    """New days, days that come again with other views, views without a time, more copies of a day, days gone."""
    rng = random.Random(seed)
    store = Store(spark, str(tmp_path))
    for days, mode in (([0, 1, 63, 140], "overwrite"), ([1, 2, None], "overwrite"), ([2, 3], "append"), ([5], "replace")):
        write_views(store, random_views(rng, days, 60), mode)
        assert jobs.refresh_activity(store) > 0
        assert kept(store) == expected(store)
        assert jobs.refresh_activity(store) == 0


def test_days_before_1970_and_the_last_bit(spark):
    days = [dt.date(1970, 1, 1) + dt.timedelta(days=n) for n in (-65, -64, -1, 0, 62, 63, 64)]
    none = spark.createDataFrame([], "user_id long, word long, days long, views long")
    changes = spark.createDataFrame([(n, d, 2, 1) for n, d in enumerate(days)], "user_id long, day date, views long, sign int")
    got = activity.activity_of_users(activity.fold_days(none, changes)).collect()
    assert {(r.user_id, r.views, r.active_days, r.last_active_date) for r in got} == {
        (n, 2, 1, d) for n, d in enumerate(days)
    }
    all_days = changes.withColumn("user_id", F.lit(7))
    (one,) = activity.activity_of_users(activity.fold_days(none, all_days)).collect()
    assert (one.active_days, one.last_active_date, one.views) == (7, days[-1], 14)


def test_a_new_day_reads_its_own_views_only(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rng = random.Random(5)
    write_views(store, random_views(rng, [0, 1, 100], 60))
    jobs.refresh_activity(store)
    words, days = store.partitions(jobs.ACTIVITY), store.partitions(jobs.DAY_ACTIVITY)
    write_views(store, random_views(rng, [101], 20))
    asked = []
    whole = Store.read_partitions

    def watched(self, name, listed):
        asked.extend(listed if name == jobs.VIEWS else [])
        return whole(self, name, listed)

    monkeypatch.setattr(Store, "read_partitions", watched)
    assert jobs.refresh_activity(store) == 1
    assert [part.split("/")[0] for part in asked] == ["received_day=2024-02-10"]
    after = store.partitions(jobs.ACTIVITY)
    old_word = f"part={activity.word_name('2023-11-01')}/"
    assert [p for p in words if p.startswith(old_word)] == [p for p in after if p.startswith(old_word)]
    assert set(days) <= set(store.partitions(jobs.DAY_ACTIVITY))


@pytest.mark.parametrize("dies_at", [jobs.DAY_ACTIVITY, jobs.ACTIVITY])
def test_a_run_that_dies_counts_once(spark, tmp_path, monkeypatch, dies_at):
    store = Store(spark, str(tmp_path))
    rng = random.Random(9)
    write_views(store, random_views(rng, [0, 1], 40))
    jobs.refresh_activity(store)
    write_views(store, random_views(rng, [1, 2], 40))
    write = Store.write

    def dying(self, df, name, *args, **options):
        if name == dies_at:
            raise OSError("gone")
        return write(self, df, name, *args, **options)

    monkeypatch.setattr(Store, "write", dying)
    for _ in range(2):
        with pytest.raises(OSError):
            jobs.refresh_activity(store)
    monkeypatch.setattr(Store, "write", write)
    write_views(store, random_views(rng, [1], 40))
    jobs.refresh_activity(store)
    assert kept(store) == expected(store)


def test_job_equals_segments_of_all_views(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rng = random.Random(2)
    people = [(n, f"u{n}@x.org", f"U {n}", n % 4 != 0, START) for n in [*range(1, 14), 2]]
    users = spark.createDataFrame(people, "id long, email string, full_name string, valid_email boolean, created_at timestamp")
    missing = {c: F.lit(None) for c in ("first_name", "last_name", "updated_at")}
    store.write(users.withColumns(missing), "silver.users")
    for days in ([0, 1, 2], [3], [2, 4]):
        write_views(store, random_views(rng, days, 200))
        jobs.segment_users(store, "2023-11-06", f"{tmp_path}/export")
        got = store.read("gold.user_engagement_segments").collect()
        whole = segments.user_engagement_segments(store.read("silver.users"), store.read(jobs.VIEWS), "2023-11-06")
        assert sorted(map(str, got)) == sorted(map(str, whole.select(*got[0].__fields__).collect()))
