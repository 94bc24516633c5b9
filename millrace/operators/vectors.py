"""Review embeddings and exact nearest neighbours by cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.encoders import Encoder, hashing_encoder

BATCH = 100  # fixed value: texts per encoder call


def embed(make_encoder: Callable[[], Encoder] = hashing_encoder) -> Callable[[Column], Column]:
    """V-1: a column function text -> array<float>; the encoder is made once per Python worker."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_encoder()
        for texts in batches:
            vectors: list[np.ndarray] = []
            for start in range(0, len(texts), BATCH):
                part = texts.iloc[start : start + BATCH].fillna("").tolist()
                vectors.extend(np.asarray(encode(part), dtype=np.float32))
            yield pd.Series(vectors, index=texts.index)

    return run


def without_embedding(reviews: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """P-21: (review_id, review) of the reviews that have no embedding, here or in the table of
    embeddings made earlier. Only ids meet in the join."""
    todo = reviews.filter(F.col("review_embedding").isNull()).select("review_id", "review")
    if embeddings is None:
        return todo
    return todo.join(embeddings.select("review_id"), "review_id", "left_anti")


def new_embeddings(
    todo: DataFrame, make_encoder: Callable[[], Encoder] = hashing_encoder
) -> DataFrame:
    """V-1: (review_id, embedding) for rows (review_id, review); rows without text get none."""
    texts = todo.filter(F.col("review").isNotNull())
    return texts.select("review_id", embed(make_encoder)(F.col("review")).alias("embedding"))


def write_back(reviews: DataFrame, embeddings: DataFrame) -> DataFrame:
    """J-7, SNK-9: reviews with the made embeddings filled in, one row per review."""
    new = embeddings.groupBy("review_id").agg(F.max("embedding").alias("_new"))
    return reviews.join(new, "review_id", "left").select(
        *[
            F.coalesce("_new", "review_embedding").alias(c) if c == "review_embedding" else F.col(c)
            for c in reviews.columns
        ]
    )


def search_vectors(reviews: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(review_id, review_embedding) of all reviews, as after ``write_back`` but without moving a
    vector through a join: own vectors, made ones, and a NULL for reviews with neither."""
    columns = ["review_id", "review_embedding"]
    own = reviews.filter(F.col("review_embedding").isNotNull()).select(*columns)
    made = embeddings.select("review_id", F.col("embedding").alias("review_embedding"))
    none = without_embedding(reviews, embeddings).select(
        "review_id", F.lit(None).cast("array<float>").alias("review_embedding")
    )
    return own.unionByName(made).unionByName(none)


def cosine_distance(vector: Column, query: Sequence[float]) -> Column:
    """1 - cosine, as a Spark expression; NULL for a NULL, zero or wrong-length vector."""
    probe = F.array(*[F.lit(float(x)) for x in query])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    wide = F.transform(vector, lambda x: x.cast("double"))
    dot = total(F.zip_with(wide, probe, lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(wide, lambda x: x * x)))
    length = float(np.linalg.norm(np.asarray(query, dtype=np.float64)))
    usable = (F.size(vector) == len(query)) & (norm > 0) & (F.lit(length) > 0)
    return F.when(usable, F.lit(1.0) - dot / (norm * F.lit(length)))


def nearest(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = 5,
    id_column: str = "review_id",
    vector_column: str = "review_embedding",
    details: DataFrame | None = None,
) -> DataFrame:
    """V-2, T-4: the k rows nearest to ``query`` with their ``distance``, nearest first.

    Exact over the whole corpus: every task scores its Arrow batches with one matrix product and
    hands on its best k, so k rows per task reach the final sort. Only id and vector pass through
    Python; the other columns (of ``details``, by default the corpus) are fetched for the k
    winners by a join that the planner chooses by their number. Vectors without a distance (NULL, zero, wrong
    length) come last; ties go to the smaller id.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    kind = corpus.schema[id_column].dataType.simpleString()
    probe = np.asarray(query, dtype=np.float64)
    length = np.linalg.norm(probe)
    unit = probe / length if length > 0 else None

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for batch in batches:
            distance = _distances(batch.column(1), unit, len(probe))
            pool = pa.table({"id": batch.column(0), "distance": distance})
            if best is not None:
                pool = pa.concat_tables([best, pool])
            best = pool.sort_by([("distance", "ascending"), ("id", "ascending")]).slice(0, k)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    top = (
        corpus.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
        .mapInArrow(best_of, f"id {kind}, distance double")
        .orderBy(F.col("distance").asc_nulls_last(), "id")
        .limit(k)
    )
    winners = top.withColumnRenamed("id", id_column)
    source = corpus if details is None else details
    rest = [c for c in source.columns if c not in (id_column, vector_column)]
    if rest:
        winners = source.select(id_column, *rest).join(winners, id_column)
    return winners.select(id_column, *rest, "distance").orderBy(
        F.col("distance").asc_nulls_last(), id_column
    )


def _distances(vectors: pa.Array, unit: np.ndarray | None, dimensions: int) -> pa.Array:
    """Cosine distance of every list in an Arrow array to a unit vector."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    usable = lengths == dimensions
    distances = np.full(len(vectors), np.nan)
    if unit is not None and usable.any():
        kept = vectors.filter(pa.array(usable))
        flat = kept.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        matrix = flat.reshape(-1, dimensions)
        norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
        with np.errstate(divide="ignore", invalid="ignore"):
            scores = 1.0 - np.einsum("ij,j->i", matrix, unit) / norms
        scores[~np.isfinite(scores)] = np.nan
        # Equal vectors must tie whatever the order of summation.
        distances[usable] = np.round(scores, 12)
    return pa.array(distances, mask=np.isnan(distances))
