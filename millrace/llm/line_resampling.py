"""Importance resampling towards a target distribution, each distinct line scored once.

Features are runs of consecutive words, hashed into buckets. How much more often a bucket occurs in the target
texts than in the documents is its gain; a document's weight is the mean gain of its features, and random Gumbel
noise on top of it draws documents in proportion to their importance.

No word contains a line end, so texts are cut into lines there. The features of a line are the same wherever it
stands: they are found once for each distinct line and count as often as the line occurs. Runs that reach over
a line end are found from the ends of the lines and added on their own (none, if runs have one word).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut, text_key, with_prefix_sums

BUCKETS = 10_000
RUN = 1  # words in the longest feature
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

HOT = 1000  # a line with more than a thousandth of all lines is hot: fewer than so many can be

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS, _LOWERED = re.compile(_WORD), str.maketrans(_UPPER, _LOWER)


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case and no other letter changed."""
    plain = F.octet_length(text) == F.length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def hashed(feature: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")


def _starts(items: Column, k: int) -> Column:
    """Where runs of ``k`` items begin, from 1."""
    return F.when(F.size(items) >= k, F.sequence(F.lit(1), F.size(items) - k + 1)).otherwise(F.array().cast("array<int>"))


def runs(found: Column, run: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``run`` of the words ``found``."""

    def long(k: int) -> Column:
        return F.transform(_starts(found, k), lambda i: hashed(F.array_join(F.slice(found, i, k), " "), buckets))

    single = F.transform(found, lambda w: hashed(w, buckets))
    return F.concat(single, *(long(k) for k in range(2, run + 1))) if run > 1 else single


def runs_between(run: int, buckets: int) -> Callable[[Column], Column]:
    """A column function: buckets of the runs of 2 to ``run`` words of a text that reach over a line end."""

    def of_text(text: str | None) -> list[int]:
        tokens: list[tuple[str, int]] = []  # the ends of lines, with a gap where the middle of a line is left out
        for number, line in enumerate((text or "").translate(_LOWERED).split("\n")):
            found = _WORDS.findall(line)
            if len(found) > 2 * (run - 1):
                found[run - 1 : 1 - run] = [""]
            tokens += [(word, number) for word in found]
        out = []
        for k in range(2, run + 1):
            for part in zip(*(tokens[i:] for i in range(k))):
                if part[0][1] != part[-1][1] and all(word for word, _ in part):
                    out.append(zlib.crc32(" ".join(word for word, _ in part).encode()) % buckets)
        return out

    @F.pandas_udf("array<int>")
    def between(texts: pd.Series) -> pd.Series:
        return texts.map(of_text)

    return between


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_ANY_WORD))


def distinct_lines(docs: DataFrame, run: int, buckets: int, name: str) -> DataFrame:
    """(key, times, n_words, buckets) of each distinct line that has a word."""
    found = docs.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    found = found.withColumn("found", words(F.col("line")))
    return cut(
        found.select(
            text_key(F.col("line")).alias("key"), "times", F.size("found").alias("n_words"),
            runs(F.col("found"), run, buckets).alias("buckets"),
        ),
        name,
    )


def bucket_counts(docs: DataFrame, lines: DataFrame, run: int, buckets: int) -> DataFrame:
    """(bucket, n): features of all documents, from their distinct lines and the runs between lines."""
    counted = lines.select(F.explode("buckets").alias("bucket"), "times").groupBy("bucket").agg(F.sum("times").alias("n"))
    if run == 1:
        return counted
    between = docs.select(F.explode(runs_between(run, buckets)(F.col("text"))).alias("bucket"))
    between = between.groupBy("bucket").agg(F.count("*").alias("n"))
    return counted.union(between).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> Column:
    """An array with the gain of each bucket; ``buckets`` numbers, which is all that comes to the driver."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), "n")
    )
    sums = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).union(
        corpus.sparkSession.range(buckets).select(F.col("id").cast("int"), F.lit(0).cast("long"), F.lit(0).cast("long"))
    )
    sums = cut(sums.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "resampling-buckets")
    total = sums.agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(total["s"] + buckets)) / ((F.col("s") + 1) * F.lit(total["t"] + buckets))
    gains = sums.select("bucket", F.floor(F.lit(1000) * F.log(ratio)).alias("gain")).orderBy("bucket").collect()
    return F.split(F.lit(",".join(str(row["gain"]) for row in gains)), ",").cast("array<bigint>")  # folds to one literal


def weights(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of ``docs``; see ``resampled``."""
    lines = distinct_lines(docs, run, buckets, "resampling-lines")
    wanted = distinct_lines(target, run, buckets, "resampling-target")
    gains = bucket_gains(bucket_counts(docs, lines, run, buckets), bucket_counts(target, wanted, run, buckets), buckets)

    def gained(found: Column) -> Column:
        return F.aggregate(found, F.lit(0).cast("long"), lambda total, b: total + F.get(gains, b))

    valued = cut(
        lines.select("key", "times", "n_words", F.size("buckets").alias("n_features"), gained(F.col("buckets")).alias("gain")),
        "resampling-valued",
    )
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", _lines(F.col("text")).alias("lines"))
    parts = F.transform("lines", lambda line: F.struct(text_key(line).alias("key"), F.lit(None).cast("array<int>").alias("between")))
    if run > 1:  # one more part of each text
        between = F.struct(F.lit(None).cast("binary").alias("key"), runs_between(run, buckets)(F.col("text")).alias("between"))
        parts = F.concat(parts, F.array(between))
    placed = cut(numbered.select("row", "doc_id", F.explode_outer(parts).alias("part")).select("row", "doc_id", "part.*"), "resampling-placed")

    many = (valued.agg(F.sum("times")).first()[0] or 0) // HOT
    values = ["n_words", "n_features", "gain"]
    hot, others = valued.where(F.col("times") > many), valued.where(F.col("times") <= many)
    met = placed.join(F.broadcast(hot.select("key", *values)), "key", "left")  # fewer than HOT rows
    rest = met.where("key is not null and gain is null").select("row", "doc_id", "key").join(others, "key")
    apart = met.where("key is null or gain is not null").select(
        "row", "doc_id", "n_words",
        F.when(F.col("between").isNotNull(), F.size("between")).otherwise(F.col("n_features")).alias("n_features"),
        F.when(F.col("between").isNotNull(), gained(F.col("between"))).otherwise(F.col("gain")).alias("gain"),
    )
    sums = apart.union(rest.select("row", "doc_id", *values)).groupBy("row", "doc_id").agg(
        *(F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(v) for v in values)
    )
    mean = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0))
    return sums.select("doc_id", "n_words", "n_features", mean.cast("long").alias("weight"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``; rank is null if it is not drawn.

    ``percent`` of the rows with at least ``least_words`` words are drawn, the highest scores first, then the
    smaller doc_id (null last). Null and empty texts, and those without words, have no features and weight 0.
    Repeated rows are rows of their own with ranks of their own; an id counts with the same noise in each of its
    rows, and a null id as an empty one. Other columns are ignored. An empty target leaves gains that depend on the
    documents alone; an empty table gives no rows.
    """
    shown = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(shown, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(weights(docs, target, run, buckets).withColumn("score", F.col("weight") + noise), "resampling-scored")
    able = F.col("n_words") >= least_words
    entered = scored.where(able).select(
        "*", (-F.col("score")).alias("from_top"), F.col("doc_id").isNull().alias("nameless"), F.lit(1).alias("one")
    )
    ranked = with_prefix_sums(entered, ["from_top", "nameless", "doc_id"], "one", "resampling-ranks")
    place = F.when(F.col("row_index") < F.expr(f"{int(percent)} * sum_all div 100"), F.col("row_index") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    out = ranked.select(*columns, place.cast("long").alias("rank"))
    return out.union(scored.where(~able).select(*columns, F.lit(None).cast("long")))
