"""Exact top-k inner products: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds.

Vectors lie in blocks of falling length. A first pass over the longest gives every query k scores to
beat. Then a block is skipped for a query if their lengths' product cannot reach its k-th score; inside a
block, vectors are cut off the same way, and the rest are judged by the product over the leading
dimensions of an SVD rotation plus the product of what is left of both lengths. Only survivors get their
exact integer product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import cut, shuffle_partitions

SCALE = 256
BLOCK = 4096  # vectors of a block, and queries that meet it in one task
QUERIES = 512  # queries judged together
LEADING = 0.5  # part of the dimensions, after rotation, that the partial product uses
SLACK = 1e-6  # relative error that the floating-point bounds may have

HITS = "query_id long, vec_id long, score long"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and integer components, without rows that lack an id, a vector, or a finite component."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(math.inf))
    )
    return embeddings.where("vec_id is not null and embedding is not null").where(~F.coalesce(bad, F.lit(True))).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<double>").alias("v")
    )


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, rows in _by_size(batch.column("v")):
            sums[size] = sums.get(size, 0) + rows.T @ rows
    for size, total in sums.items():
        if size:
            at = np.arange(size * size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size * size, size), pa.int32()), pa.array(at, pa.int32()), pa.array(total.ravel())],
                names=["size", "at", "total"],
            )


def _by_size(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray]]:
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        yield size, flat[(ends[rows] - size)[:, None] + np.arange(size)]


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension, the right singular vectors of all vectors of that dimension, leading first. Tasks sum
    outer products; dimension squared numbers reach the driver."""
    sums = vectors.mapInArrow(_gram, "size int, at int, total double").groupBy("size", "at").agg(F.sum("total").alias("t"))
    found: dict[int, np.ndarray] = {}
    for row in sums.collect():
        found.setdefault(row["size"], np.zeros((row["size"],) * 2)).ravel()[row["at"]] = row["t"]
    return {size: np.linalg.svd(total)[2].T for size, total in found.items()}


class Side:
    """Vectors of a block with their lengths, leading parts and the lengths of the rest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        turned = vectors @ rotation
        self.leading = turned[:, : max(1, int(turned.shape[1] * LEADING))]
        self.length = np.sqrt((vectors * vectors).sum(axis=1))
        self.rest = np.sqrt(np.maximum(0, self.length**2 - (self.leading**2).sum(axis=1)))


def best_of(queries: Side, least: np.ndarray, block: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of queries and vectors and the scores that may belong to a query's k best. ``least``: a
    score that k candidates are known to reach; ``block`` is in descending length."""
    hits: list[tuple[int, np.ndarray, np.ndarray]] = []
    reach = np.searchsorted(-block.length, -least / np.maximum(queries.length, 1e-300) * (1 - SLACK), side="right")
    reach = np.where(least <= 0, len(block.ids), reach)
    widest = int(reach.max(initial=0))
    partial = queries.leading @ block.leading[:widest].T
    partial += np.multiply.outer(queries.rest, block.rest[:widest])
    for q in range(len(queries.ids)):
        slack = SLACK * max(1.0, queries.length[q] * (block.length[0] if widest else 0))
        may = np.flatnonzero(partial[q, : reach[q]] >= least[q] - slack)
        may = may[block.ids[may] != queries.ids[q]]
        if len(may):
            score = (block.vectors[may] @ queries.vectors[q]).round().astype(np.int64)
            keep = np.lexsort((block.ids[may], -score))[:k]
            hits.append((q, may[keep], score[keep]))
    if not hits:
        return (np.empty(0, np.int64),) * 3
    owner = np.concatenate([np.full(len(m), q) for q, m, _ in hits])
    return owner, np.concatenate([m for _, m, _ in hits]), np.concatenate([s for _, _, s in hits])


def _side(frame: pd.DataFrame, rotations: dict[int, np.ndarray], size: int) -> Side:
    vectors = np.stack(frame["v"].to_numpy()) if len(frame) else np.empty((0, size))
    return Side(frame["vec_id"].to_numpy(np.int64), vectors, rotations[size])


def _search(rotations: dict[int, np.ndarray], k: int):
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(block):
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        queries = queries.rename(columns={"query_id": "vec_id", "query_v": "v"})
        size = len(block["v"].iloc[0])
        own = _side(block.sort_values(["length", "vec_id"], ascending=[False, True]), rotations, size)
        out = []
        for start in range(0, len(queries), QUERIES):
            some = queries.iloc[start : start + QUERIES]
            least = some["least"].to_numpy(np.float64, na_value=-math.inf)
            side = _side(some, rotations, size)
            q, v, score = best_of(side, least, own, k)
            out.append(pd.DataFrame({"query_id": side.ids[q], "vec_id": own.ids[v], "score": score}))
        return pd.concat(out)[names]

    return run


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of the integer vectors
    floor(256 x) of each query with every other row of its dimension; equal scores by smaller vec_id.

    Rows without id, without vector or with a null or non-finite component take no part. A row with the
    query's id is its own; a repeated candidate appears once. Vectors of other dimensions, and empty ones,
    have no product with it. With fewer than k candidates all are returned. Other columns are ignored.

    Queries travel in rows to the blocks they may find something in; a block of vectors is one task's
    group of at most about BLOCK rows, however many rows are equally long.
    """
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    held = usable(embeddings).where(F.size("v") > 0).withColumn("size", F.size("v")).withColumn("length", length)
    parts = shuffle_partitions(embeddings)
    # Blocks of falling length: ranges of (size, length), cut again by number of rows.
    ranged = held.dropDuplicates(["vec_id", "v"]).repartitionByRange(parts, "size", F.desc("length"), "vec_id")
    within = Window.partitionBy("part").orderBy("size", F.desc("length"), "vec_id")
    numbered = cut(ranged.withColumn("part", F.spark_partition_id()), "search-vectors")
    numbered = numbered.withColumn("block", F.floor((F.row_number().over(within) - 1) / BLOCK))
    vectors = cut(
        numbered.withColumn("block", F.concat_ws("-", "size", "part", F.col("block").cast("string"))), "search-blocks"
    )
    turn = rotations(vectors.select("v"))
    blocks = vectors.groupBy("size", "block").agg(F.max("length").alias("longest"))
    asking = vectors.where(is_query)
    groups = max(1, math.ceil(asking.count() / BLOCK))
    queries = asking.select(
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("query_v"),
        F.col("size").alias("query_size"),
        F.col("length").alias("query_length"),
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("query_group"),
    )
    run = _search(turn, k)

    def search(asked: DataFrame, among: DataFrame) -> DataFrame:
        """Each group of queries meets each block that one of them may find something in."""
        met = cut(asked, "search-asked")
        meetings = met.select(F.col("block").alias("met"), F.col("query_group").alias("met_group")).distinct()
        rows = among.select("block", "vec_id", "v", "length").join(meetings, F.col("block") == F.col("met"))
        left = met.groupBy("block", "query_group")
        right = rows.select("met", "met_group", "vec_id", "v", "length").groupBy("met", "met_group")
        return left.cogroup(right).applyInPandas(lambda q, b: run(q, b), HITS)

    first = blocks.groupBy("size").agg(F.max_by("block", F.struct("longest", "block")).alias("block"))
    columns = ["block", "query_group", "query_id", "query_v", "least"]
    begin = queries.join(F.broadcast(first), F.col("query_size") == F.col("size"))  # one row per dimension
    seen = cut(search(begin.withColumn("least", F.lit(None).cast("double")).select(*columns), vectors), "search-first")
    bounds = seen.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("least"))
    rest = blocks.join(F.broadcast(first.select("block")), "block", "left_anti")
    reachable = (
        F.col("least").isNull()
        | (F.col("least") <= 0)
        | (F.col("query_length") * F.col("longest") >= F.col("least") * (1 - SLACK))
    )
    asked = queries.join(bounds, "query_id", "left").join(rest, F.col("query_size") == F.col("size")).where(reachable)
    hits = seen.union(search(asked.select(*columns), vectors)).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
