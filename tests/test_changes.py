"""Change rows: newest version, defaults, decoding, envelopes, documents."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import changes, quality
from millrace.operators.latest import latest_by_key
from millrace.sources import kafka


def test_newest_version_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 50), rng.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, version long, payload long")
    expected = {}
    for key, version, payload in rows:
        expected[key] = max(expected.get(key, (-1, -1)), (version, payload))
    got = {r.id: (r.version, r.payload) for r in latest_by_key(df, "id", "version").collect()}
    assert got == expected


def test_the_winner_among_equal_versions_does_not_depend_on_the_columns(spark):
    rows = [(1, 5, i % 7, (i * 5) % 11) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, version long, one long, two long")
    (whole,) = latest_by_key(df, "id", "version").collect()
    for columns in (["id", "one"], ["two", "id"], ["id", "two", "one"]):
        (row,) = latest_by_key(df, "id", "version", columns).collect()
        assert all(row[c] == whole[c] for c in columns)
    changed = df.selectExpr("id", "version AS updated_at", "one AS item_id", "two AS quantity", "one AS log_position")
    best = max(r[2] for r in rows)
    got = changes.latest_purchases(changed).collect()[0]
    assert got.item_id == best


def test_equal_versions_fall_back_to_sequence(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, "z"), (1, 5, 2, "a"), (2, None, 1, "x"), (2, 1, 0, None)],
        "id long, version long, seq long, text string",
    )
    got = {r.id: r.text for r in latest_by_key(df, "id", ["version", "seq"]).collect()}
    assert got == {1: "a", 2: None}
    assert latest_by_key(df, "id", ["version", "seq"], ["id", "text"]).columns == ["id", "text"]


def test_partial_aggregation_precedes_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS id", "id AS version")
    plan = latest_by_key(df, "id", "version")._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max_by" in plan


def test_defaults(spark):
    df = spark.createDataFrame(
        [(1, *[None] * 9, ""), (2, *[None] * 9, "bad")],
        f"{schemas.PURCHASE_CHANGE}, _error string",
    )
    (row,) = changes.valid_purchases(df).collect()
    epoch = dt.datetime(1970, 1, 1)
    assert tuple(row) == (1, 0, 0, "", 1, 0, Decimal("0.00"), False, epoch, epoch)


def test_micros_and_price(spark):
    def change(micros, price):
        return (1, 1, 1, "", 1, 1, price, False, micros, micros, "")

    df = spark.createDataFrame(
        [change(-1_500, 0.295), change(1_700_000_000_123_999, 2.5)],
        f"{schemas.PURCHASE_CHANGE}, _error string",
    )
    early, late = changes.valid_purchases(df).orderBy("created_at").collect()
    assert early.created_at == dt.datetime(1969, 12, 31, 23, 59, 59, 998000)
    assert late.created_at == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert (early.purchase_price, late.purchase_price) == (Decimal("0.30"), Decimal("2.50"))


def test_decoding(spark):
    good = {"id": 3, "user_id": 4, "purchase_price": 1.5, "deleted": True}
    texts = [json.dumps(good), "not json", '{"id": "x", "user_id": 4}', "{}", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = changes.decode_changes(df).collect()
    assert sorted((r.id or 0, r._error, r._raw_message) for r in rows) == sorted(
        [(3, "", "")] + [(0, "decode error", t) for t in texts[1:4]]
    )


def test_decoded_structs_take_the_same_route(spark):
    """As Avro records arrive: a struct, or NULL for bytes that are no record."""
    df = spark.createDataFrame(
        [(b"one", 1, (1, 70000)), (b"two", 2, None), (b"three", 3, (3, 2)), (None, 4, None)],
        "value binary, offset long, record struct<id: long, status: int>",
    )
    rows = changes.decode_avro_changes(df, F.col("record"), "id BIGINT, status INT", {"status": "smallint"})
    got = sorted((r.log_position, r.id, r._error, r._raw_message) for r in rows.collect())
    assert got == [(1, 1, "value out of range", "b25l"), (2, None, "decode error", "dHdv"), (3, 3, "", "")]


def test_values_out_of_range_are_errors(spark):
    texts = [
        '{"id": 1, "status": 70000}',
        '{"id": 2, "purchase_price": 1e300}',
        '{"id": 3, "quantity": 99999999999}',
        '{"id": 4, "status": 2, "purchase_price": 9999999999.99}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = changes.decode_changes(df, limits=changes.PURCHASE_LIMITS)
    errors = sorted(r._error for r in rows.collect())
    assert errors == ["", "decode error", "value out of range", "value out of range"]
    assert {r._raw_message for r in changes.purchase_errors(rows).collect()} == set(texts[:3])
    (kept,) = changes.valid_purchases(rows).collect()
    assert (kept.id, kept.status) == (4, 2)


def test_versions_in_different_months_leave_one_row(spark):
    df = spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31), 0),
            (1, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), 1),
        ],
        "id long, created_at timestamp, updated_at timestamp, batch_id long",
    )
    (row,) = changes.latest_purchases(df).collect()
    assert row.created_at == dt.datetime(2024, 2, 1)


def envelope(op, ts, before=None, after=None):
    return {"op": op, "before": before, "after": after, "source": {"table": "items", "ts_ms": ts}}


def item(i, name, price="1.50"):
    return {"id": i, "name": name, "price": price, "created_at": 1_000_000}


def test_item_documents(spark):
    messages = [
        envelope("r", 1, after=item(1, "one")),
        envelope("u", 2, before=item(1, "one"), after=item(1, "uno", "not a price")),
        envelope("r", 1, after=item(2, "two")),
        envelope("d", 3, before=item(2, "two")),
        None,  # tombstone
        envelope("r", 1, after=item(3, "three")),
        envelope("d", 2, before=item(3, "three")),
        envelope("c", 4, after=item(3, "again")),
    ]
    df = spark.createDataFrame([(m and json.dumps(m),) for m in messages], "value string")
    rows = df.select(F.from_json("value", schemas.ITEM_ENVELOPE).alias("c")).select("c.*")
    documents = changes.item_documents(changes.typed_items(changes.flatten_changes(rows)))
    got = {r.id: (r.name, r.price, r["__deleted"], r["__op"]) for r in documents.collect()}
    assert got == {
        1: ("uno", None, False, "u"),
        2: ("two", Decimal("1.50"), True, "d"),
        3: ("again", Decimal("1.50"), False, "c"),
    }
    assert tuple(changes.document_count(documents).first()) == (3, 2)
    assert tuple(changes.document_count(documents.limit(0)).first()) == (0, 0)


def test_destination(spark):
    df = spark.createDataFrame([("dbz.public.items",), ("other.items",)], "topic string")
    got = [r[0] for r in df.select(changes.destination_of(F.col("topic"))).collect()]
    assert got == ["items", "other.items"]


def test_quality_report(spark):
    df = spark.createDataFrame([(1, 2.0), (None, -1.0), (3, None)], "id long, price double")
    rules = {"id": "id IS NOT NULL", "positive": "price > 0"}
    got = sorted(map(tuple, quality.quality_report(df, "t", rules).collect()))
    assert got == [("t", "id", 1, 3), ("t", "positive", 2, 3)]
    empty = quality.quality_report(df.limit(0), "t", rules).collect()
    assert {(r.failed, r.total) for r in empty} == {(0, 0)}


def test_offsets_and_topics_of_a_topic_are_kept(spark):
    """The later offset wins among equal times, whatever order the rows are read in; the topic still routes."""
    rows = [
        (f'{{"id": 1, "quantity": {n}, "updated_at": 5}}'.encode(), topic, n)
        for n, topic in ((7, "dbz.public.purchases"), (9, "dbz.public.purchases"), (8, "dbz.public.purchases"))
    ]
    messages = spark.createDataFrame([*rows, (None, "dbz.public.purchases", 10)], "value binary, topic string, offset long")
    values = kafka.text_values(messages.withColumn("key", F.lit(b"k")))
    assert values.columns == ["value", "topic", "offset"]
    decoded = changes.decode_changes(values.repartition(3))
    (row,) = changes.latest_purchases(changes.valid_purchases(decoded)).collect()
    assert row.quantity == 9
    assert {r[0] for r in values.select(changes.destination_of(F.col("topic"))).collect()} == {"purchases"}
    assert kafka.text_values(messages.select("value")).columns == ["value"]
