"""Embeddings and nearest neighbours."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.encoders import DIMENSIONS, hashing_encoder
from millrace.operators import vectors
from millrace.plans import jobs
from millrace.tables import Store

CORPUS = [
    (1, "a", [1.0, 0.0]),
    (2, "b", [0.0, 2.0]),
    (3, "c", [3.0, 3.0]),
    (4, "d", [0.0, 0.0]),
    (5, "e", None),
    (6, "f", [1.0, 2.0, 3.0]),
    (7, "g", [-1.0, 0.0]),
    (8, "h", [5.0, 0.0]),
]
SCHEMA = "review_id long, review string, review_embedding array<float>"


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(CORPUS, SCHEMA).repartition(3, "review_id")


def test_order_ties_and_unusable_vectors(corpus):
    rows = vectors.nearest(corpus, [2.0, 0.0], k=20).collect()
    assert [r.review_id for r in rows] == [1, 8, 3, 2, 7, 4, 5, 6]
    assert [r.review for r in rows][:2] == ["a", "h"]
    assert rows[4].distance == 2.0
    assert [r.distance for r in rows[5:]] == [None] * 3


def test_equals_expression_form(corpus):
    probe = [0.3, -0.7]
    expected = (
        corpus.select(
            "review_id", vectors.cosine_distance(F.col("review_embedding"), probe).alias("d")
        )
        .orderBy(F.col("d").asc_nulls_last(), "review_id")
        .limit(4)
        .collect()
    )
    got = vectors.nearest(corpus, probe, k=4).collect()
    assert [r.review_id for r in got] == [r.review_id for r in expected]
    assert np.allclose([r.distance for r in got], [r.d for r in expected])


def test_zero_query(corpus):
    rows = vectors.nearest(corpus, [0.0, 0.0], k=3).collect()
    assert [(r.review_id, r.distance) for r in rows] == [(1, None), (2, None), (3, None)]


def test_encoder():
    encode = hashing_encoder()
    got = encode(["late delivery", "Late delivery", "great support", "", "ü"])
    assert got.shape == (5, DIMENSIONS) and got.dtype == np.float32
    assert np.array_equal(got[0], got[1])
    assert np.allclose(np.linalg.norm(got[[0, 2, 4]], axis=1), 1)
    assert got[0] @ got[2] < 0.9
    long = "word " * 20_000
    assert not np.array_equal(encode([long])[0], encode([long + "different ending"])[0])


def reviews(spark):
    rows = [
        (1, "n", "e", None, "late delivery", None),
        (2, "n", "e", None, "great support", [0.5] * DIMENSIONS),
        (3, "n", "e", None, None, None),
    ]
    return spark.createDataFrame(
        rows,
        "review_id long, customer_name string, customer_email string, date date, review string, "
        "review_embedding array<float>",
    )


def test_embedding_job(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(reviews(spark), "rt.reviews")
    assert jobs.embed_reviews(store, hashing_encoder) == 1
    assert jobs.embed_reviews(store, hashing_encoder) == 0
    made = store.read("rt.review_embeddings")
    got = {r.review_id: r.review_embedding for r in store.read("rt.reviews").collect()}
    twice = vectors.write_back(reviews(spark), made.unionAll(made)).collect()
    assert {r.review_id: r.review_embedding for r in twice} == got and len(twice) == len(got)
    assert np.allclose(got[1], hashing_encoder()(["late delivery"])[0])
    assert got[2] == [0.5] * DIMENSIONS
    assert got[3] is None
    searched = vectors.search_vectors(store.read("rt.reviews"), made).collect()
    assert {r.review_id: r.review_embedding for r in searched} == got

    more = reviews(spark).limit(1).selectExpr("9 AS review_id", "* EXCEPT (review_id)")
    store.write(more, "rt.reviews")
    before = set(store.partitions("rt.reviews"))
    assert jobs.embed_reviews(store, hashing_encoder) == 1
    after = set(store.partitions("rt.reviews"))
    (bucket,) = spark.sql(f"SELECT {schemas.bucket_of('9L')}").first()
    assert {p.split("/")[0] for p in before ^ after} == {f"bucket={bucket}"}  # other buckets keep their files
    assert {r.review_id: r.review_embedding for r in store.read("rt.reviews").filter("review_id <> 9").collect()} == got


def test_similar_texts_are_near(spark):
    texts = ["the delivery was late", "delivery was very late", "lovely colours and fabric"]
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    made = vectors.new_embeddings(vectors.without_embedding(rows))
    probe = hashing_encoder()(["late delivery"])[0]
    found = vectors.nearest(
        vectors.search_vectors(rows, made), probe, k=2, details=rows.drop("review_embedding")
    ).collect()
    assert {(r.review_id, r.review) for r in found} == {(0, texts[0]), (1, texts[1])}


def test_number_of_neighbours_is_checked(corpus):
    with pytest.raises(ValueError):
        vectors.nearest(corpus, [1.0, 0.0], k=0)
