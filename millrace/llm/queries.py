"""Registered queries of the training-data operators: ``(spark, folder of the given tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from millrace.llm import (
    bbit_minhash,
    byte_cnn,
    fingerprints,
    fuzzy_lines,
    line_resampling,
    lp_packing,
    matrix_bpe,
    norm_search,
    oracle,
    pareto_mix,
    ranked_ids,
    size_shards,
    token_alignment,
    trigram_scan,
)
from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def statements() -> dict[str, str]:
    return oracle.statements()


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")


@query
def op1_bloom_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.versions(documents(spark, folder))


@query
def op2_fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_lines.without_repeats(documents(spark, folder)).select("doc_id", "n_lines", "n_removed", "text")


@query
def op3_byte_cnn_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~byte_cnn.held_out())
    scored = byte_cnn.scored(docs, byte_cnn.learned(docs, labels))
    predicted = F.when(F.col("score") >= byte_cnn.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", byte_cnn.held_out().alias("held_out"), "score", predicted.alias("predicted"))


@query
def op4_ranked_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_ids.round_trip(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_matrix_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return matrix_bpe.round_trip(documents(spark, folder), path, public_tokenizers.PATTERN)


@query
def op6_lp_packing(spark: SparkSession, folder: str) -> DataFrame:
    return lp_packing.pack(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_prefix_sum_shards(spark: SparkSession, folder: str) -> DataFrame:
    return size_shards.shards(documents(spark, folder)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_norm_pruned_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = prepare(spark).read.parquet(f"{folder}/embeddings.parquet")
    return norm_search.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op9_trigram_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = trigram_scan.scan(documents(spark, folder))

    def number(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    joined = F.concat_ws(
        ",", F.transform("secret_spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
    return found.select(
        "doc_id",
        *(number(rule.kind).alias(f"n_{rule.kind}") for rule in trigram_scan.RULES),
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )


@query
def op10_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return bbit_minhash.near_duplicates(documents(spark, folder), size=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query
def op11_pointer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.aligned(documents(spark, folder), a, b).drop("groups")


@query
def op12_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pareto_mix.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_line_resampling(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = prepare(spark).read.parquet(f"{folder}/benchmark.parquet")
    drawn = line_resampling.resampled(documents(spark, folder), benchmark)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
