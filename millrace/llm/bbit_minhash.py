"""Near-duplicate documents by b-bit MinHash.

Each set of word shingles keeps the low eight bits of 256 minima, packed into 256 bytes. Bands of six
of them name the buckets in which candidates meet; a pair's similarity is then estimated from the
packed signatures by exclusive-or and bit counts, corrected for chance agreement, and pairs that come
near the limit are confirmed on the full sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut, maybe_among, pieces, shuffle_partitions, text_key
from millrace.llm.groups import family_blocks, linked_groups

MINIMA = 256
BITS = 8
ROWS = 6  # minima in a band; at similarity 0.8 a pair misses all 42 bands with probability 3e-6
SLACK = 5.0  # standard deviations below the limit at which an estimate still goes to the full check

BLOCK = 200_000  # shingles on either side of a block of documents that are compared in one task

SKETCH = "doc_id long, text_key binary, n_shingles long, digest binary, signature binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words; A-Z is lower-cased, words end at
    ASCII white space, fewer words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + len(mixed)]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _families(count: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(20).integers(0, 2**32, (2, count), np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def signature(values: np.ndarray, count: int = MINIMA) -> bytes:
    """The low bits of the ``count`` minima, a byte each."""
    factors, shifts = _families(count)
    folded = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    least = np.full(count, 2**32 - 1, np.uint32)
    for start in range(0, len(folded), 2048):  # keeps a very long document within the cache
        hashed = np.multiply.outer(factors, folded[start : start + 2048]) + shifts[:, None]
        least = np.minimum(least, hashed.min(axis=1))
    return (least & np.uint32(2**BITS - 1)).astype(np.uint8).tobytes()


def estimate(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Similarity of signatures (rows of bytes): the share of equal bytes, less what chance gives."""
    differ = first ^ second
    for half in (4, 2, 1):  # any set bit of a byte ends up in its lowest bit
        differ |= differ >> np.uint8(half)
    words = np.ascontiguousarray(differ & np.uint8(1)).view(np.uint64)
    unequal = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    chance = 2.0**-BITS
    return (1 - unequal / first.shape[1] - chance) / (1 - chance)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 512):
            counts, digests, signatures = [], [], []
            for text in batch.column("text"):
                values = shingles(text.as_py(), size)
                counts.append(len(values))
                digests.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                signatures.append(signature(values) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "digest", "signature"],
            )

    return run


def _likely(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sides = [
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA)
                    for c in ("signature_a", "signature_b")
                ]
                yield batch.select(["a", "b"]).filter(pa.array(estimate(*sides) >= limit))

    return run


def _confirmed(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in pieces(batches, 512):
            keep = []
            for a, one, two in zip(batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")):
                if a != last:
                    last, held = a, shingles(one.as_py(), size)
                other = shingles(two.as_py(), size)
                common = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(held) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked_in_block(rows: list[dict], size: int, percent: int, limit: float) -> Iterator[tuple[bytes, bytes]]:
    """Links between the outside documents of a block and its documents of other groups."""
    outside = [r for r in rows if r["outside"]]
    inside = [r for r in rows if not r["outside"]]
    if not outside or not inside:
        return
    marks = np.frombuffer(b"".join(r["signature"] for r in inside), np.uint8).reshape(-1, MINIMA)
    roots = np.array([r["root"] for r in inside], object)
    sets: dict[int, np.ndarray] = {}
    for row in outside:
        own = np.frombuffer(row["signature"], np.uint8)
        likely = np.flatnonzero((estimate(marks, own[None, :]) >= limit) & (roots != row["root"]))
        if not len(likely):
            continue
        for i in likely.tolist():
            if i not in sets:
                sets[i] = shingles(inside[i]["text"], size)
        mine = shingles(row["text"], size)
        flat = np.concatenate([sets[i] for i in likely])
        sizes = np.array([len(sets[i]) for i in likely])
        at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        common = np.add.reduceat((mine[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        for i in likely[100 * common >= percent * (len(mine) + sizes - common)].tolist():
            yield row["id"], inside[i]["id"]


def _linked_in_blocks(size: int, percent: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in pieces(batches, 256) for row in batch.to_pylist())
        for _, block in itertools.groupby(rows, key=lambda r: (r["family"], r["c"], r["o"])):
            found = list(_linked_in_block(list(block), size, percent, limit))
            if found:
                sides = [pa.array(side, pa.binary()) for side in zip(*found)]
                yield pa.RecordBatch.from_arrays(sides, names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept; one row per row of ``docs``.

    Documents are linked if their shingle sets have a Jaccard similarity of ``percent`` or more;
    component_id is the least doc_id that links reach, itself included. Equal sets are one class, so
    copies make no pairs. A document without words or text is linked with nothing. Rows without doc_id
    lend theirs to nobody; such a row alone has no component_id and is kept. Repeated rows (equal id)
    are kept together. Other columns are ignored; no rows, no result.
    """
    read = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    sketch = cut(read.mapInArrow(_sketch(size), SKETCH), "minhash-sketch")
    classes = cut(
        sketch.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("weight"),
        )
        .select(F.col("digest").alias("id"), "best.doc_id", "best.text_key", "signature", "weight"),
        "minhash-classes",
    )
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(MINIMA // ROWS - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("signature"), k * ROWS + 1, F.lit(ROWS))),
    )
    members = classes.select("id", F.explode(F.array_distinct(bands)).alias("bucket"))
    share = percent / 100
    limit = share - SLACK * (share * (1 - share) / MINIMA) ** 0.5

    def sides(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
        for side in ("a", "b"):
            own = values.select(F.col("id").alias(side), F.col(value).alias(f"{value}_{side}"))
            pairs = pairs.join(own, side)
        return pairs

    def texts(ids: DataFrame) -> DataFrame:
        """The text of each id's first document."""
        wanted = cut(ids.distinct().join(classes.select("id", "doc_id", "text_key"), "id"), "minhash-wanted")
        near = maybe_among(read, F.col("text_key"), wanted, "text_key")
        own = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_key") == F.col("w.text_key"))
        return near.alias("d").join(wanted.alias("w"), own).select("w.id", "d.text").dropDuplicates(["id"])

    def confirm(pairs: DataFrame) -> DataFrame:
        marked = sides(pairs, classes, "signature").select("a", "b", "signature_a", "signature_b")
        likely = cut(marked.mapInArrow(_likely(limit), "a binary, b binary"), "minhash-likely")
        own = texts(likely.select(F.explode(F.array("a", "b")).alias("id")))
        both = sides(likely, own, "text").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_confirmed(size, percent), "a binary, b binary")

    def compare(held: DataFrame) -> DataFrame:
        key = ["family", "c", "o"]
        blocks = family_blocks(held, classes.select("id", "weight"), BLOCK)
        own = texts(held.select("id")).join(classes.select("id", "signature"), "id")
        rows = blocks.join(own, "id").repartition(shuffle_partitions(docs), *key).sortWithinPartitions(*key)
        return rows.mapInArrow(_linked_in_blocks(size, percent, limit), "a binary, b binary")

    roots = linked_groups(members, confirm, compare, "minhash")
    rooted = classes.select("id", "doc_id").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = rooted.join(smallest, "root").select(F.col("id").alias("digest"), "component_id")
    found = sketch.join(placed, "digest", "left").withColumn(
        "component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents whose group has one with a smaller doc_id."""
    found = near_duplicates(docs, size, percent).where("not kept").select("doc_id", "text_key").distinct()
    gone = cut(found.withColumnsRenamed({"doc_id": "gone_id", "text_key": "gone_key"}), "minhash-gone")
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (text_key(docs["text"]) == gone["gone_key"])
    return docs.join(gone, same, "left_anti")
