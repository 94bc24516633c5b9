"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph's digest is added to three cells of its document's sketch, each cell holding a count, a sum of
digests and a sum of check values. Two versions' sketches are subtracted cell by cell, so that only the
differing paragraphs remain, and these are peeled off: a cell with a single digest gives it away, and
taking it out of its other cells bares more. If cells remain, both versions are sketched again with four
times the cells. Many pairs are peeled at once in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import pieces, shuffle_partitions

CELLS = 24  # of a fingerprint; three equal parts, one for each hash
GROWTH = 4
HASHES = 3
ROUND = 256  # pairs peeled together

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_edited_differing long, n_next_differing long"
)

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_CHECK = np.uint64(0x94D049BB133111EB)
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _mixed(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * factor
    return values ^ (values >> np.uint64(31))


def paragraphs(text: bytes) -> list[bytes]:
    """A text's paragraphs: its lines, and of these the parts that end at a space after certain letters,
    one in four of all spaces or so. Where a part ends depends on the bytes before the space alone, so an
    edit leaves the parts elsewhere as they are."""
    if not text:
        return []
    raw = np.frombuffer(text, np.uint8)
    ends = raw == 10
    if len(raw) > 3:
        spread = raw[2:-1].astype(np.uint32) * 193 + raw[1:-2] * np.uint32(71) + raw[:-3] * np.uint32(29)
        ends[3:] |= (raw[3:] == 32) & ((spread >> np.uint32(2)) & np.uint32(3) == 0)
    cuts = [0, *(np.flatnonzero(ends) + 1).tolist()]
    if cuts[-1] != len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def digests(text: str) -> np.ndarray:
    """One 64-bit digest for every paragraph; the second copy of a paragraph has another than the first."""
    hashed = np.array([xxhash.xxh3_64_intdigest(p) for p in paragraphs(text.encode("utf-8", "surrogatepass"))], np.uint64)
    if not len(hashed):
        return hashed
    ordered = np.sort(hashed)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    copies = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
    return _mixed(ordered + copies.astype(np.uint64) * _SEEDS[0], _MIX)


def _places(values: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each digest in each part of a sketch (HASHES, n)."""
    part = np.uint64(cells // HASHES)
    spread = [_mixed(values + s, _CHECK) % part + part * np.uint64(k) for k, s in enumerate(_SEEDS)]
    return np.array(spread).astype(np.int64).reshape(HASHES, -1)


def _sketches(owner: np.ndarray, values: np.ndarray, signs: np.ndarray, owners: int, cells: int):
    """Counts, digest sums and check sums of all owners' cells, one after another."""
    at = _places(values, cells) + owner * cells
    counts = np.zeros(owners * cells, np.int64)
    sums, checks = np.zeros(owners * cells, np.uint64), np.zeros(owners * cells, np.uint64)
    signed = signs.astype(np.uint64)  # a negative sign wraps around, as the sums do
    for row in at:
        np.add.at(counts, row, signs)
        np.add.at(sums, row, values * signed)
        np.add.at(checks, row, _mixed(values, _CHECK) * signed)
    return counts, sums, checks


def _peel(counts: np.ndarray, sums: np.ndarray, checks: np.ndarray, cells: int):
    """Owners, digests and signs that peeling recovers, and the owners whose sketch did not empty."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    look = np.flatnonzero(counts | sums.view(np.int64))
    while len(look):
        sign = counts[look]
        value = np.where(sign < 0, ~sums[look] + np.uint64(1), sums[look])
        pure = (np.abs(sign) == 1) & (_mixed(value, _CHECK) * sign.astype(np.uint64) == checks[look])
        owner, value, sign = look[pure] // cells, value[pure], sign[pure]
        own = _places(value, cells) + owner * cells
        pure = (own == look[pure]).any(axis=0) if len(value) else np.zeros(0, bool)
        owner, value, sign = owner[pure], value[pure], sign[pure]
        if not len(value):
            break
        # the same digest may show in several cells of its owner; it is taken out once
        _, once = np.unique(np.array([owner.astype(np.uint64), value]), axis=1, return_index=True)
        owner, value, sign = owner[once], value[once], sign[once]
        found.append((owner, value, sign))
        places = _places(value, cells) + owner * cells
        for row in places:
            np.subtract.at(counts, row, sign)
            np.subtract.at(sums, row, value * sign.astype(np.uint64))
            np.subtract.at(checks, row, _mixed(value, _CHECK) * sign.astype(np.uint64))
        look = np.unique(places)
        look = look[(counts[look] != 0) | (sums[look] != 0)]
    stuck = np.unique(np.flatnonzero(counts | sums.view(np.int64) | checks.view(np.int64)) // cells)
    empty = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
    joined = tuple(np.concatenate(x) for x in zip(*found)) if found else empty
    return joined, stuck


def differences(pairs: list[tuple[np.ndarray, np.ndarray]], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of digest arrays, the digests only the first and only the second has."""
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.uint64),) * 2 for _ in pairs]
    waiting = np.arange(len(pairs))
    while len(waiting):
        sides = [(i, np.concatenate(pairs[k]), len(pairs[k][0])) for i, k in enumerate(waiting)]
        sizes = np.array([len(v) for _, v, _ in sides])
        owner = np.repeat(np.arange(len(waiting)), sizes)
        values = np.concatenate([v for _, v, _ in sides])
        signs = np.concatenate([np.where(np.arange(len(v)) < n, 1, -1) for _, v, n in sides])
        sketch = _sketches(owner, values, signs, len(waiting), cells)  # sums of one side less the other's
        (owners, values, signs), stuck = _peel(*sketch, cells)
        order = np.argsort(owners, kind="stable")
        owners, values, signs = owners[order], values[order], signs[order]
        ends = np.searchsorted(owners, np.arange(len(waiting) + 1))
        failed = set(stuck.tolist())
        for i, k in enumerate(waiting.tolist()):
            if i not in failed:
                own, sign = values[ends[i] : ends[i + 1]], signs[ends[i] : ends[i + 1]]
                out[k] = (own[sign > 0], own[sign < 0])
        waiting = waiting[stuck]
        cells *= GROWTH
    return out


def fingerprint(values: np.ndarray, cells: int = CELLS) -> str:
    """The sketch as text: number of paragraphs, then each cell's count, digest sum and check sum in hex."""
    counts, sums, checks = _sketches(np.zeros(len(values), np.int64), values, np.ones(len(values), np.int64), 1, cells)
    low = (checks & np.uint64(0xFFFFFFFF)).astype("<u4")
    return f"{len(values)}:" + b"".join((counts.astype("<u4").tobytes(), sums.astype("<u8").tobytes(), low.tobytes())).hex()


def likeness(first: np.ndarray, second: np.ndarray, only: tuple[np.ndarray, np.ndarray]) -> float:
    """Shared paragraphs, counted on both sides, as a part of all; two empty documents are alike."""
    total = len(first) + len(second)
    return 1.0 if not total else 1 - (len(only[0]) + len(only[1])) / total


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    changed = [edited(text, following) for _, text, following in rows]
    own = [digests(text) for _, text, _ in rows]
    new = [digests(text) for text in changed]
    after = [digests(following) for _, _, following in rows]
    to_new, to_next = differences(list(zip(own, new))), differences(list(zip(own, after)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key for key, _, _ in rows], pa.int64()),
            pa.array([len(text) for _, text, _ in rows], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
            pa.array([fingerprint(d) for d in own]),
            pa.array([fingerprint(d) for d in new]),
            pa.array([likeness(a, b, d) for a, b, d in zip(own, new, to_new)], pa.float64()),
            pa.array([likeness(a, b, d) for a, b, d in zip(own, after, to_next)], pa.float64()),
            pa.array([len(a) + len(b) for a, b in to_new], pa.int64()),
            pa.array([len(a) + len(b) for a, b in to_next], pa.int64()),
        ],
        names=[f.split()[0] for f in RESULT.split(", ")],
    )


def _successive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row with the one after it in the same bucket; a row that is there only to be the next
    one is not compared itself."""
    rows: list[tuple[int | None, str, str]] = []
    bucket, last = None, None
    for batch in pieces(batches, ROUND):
        for row in batch.to_pylist():
            if last is not None:
                if row["bucket"] != bucket:
                    raise ValueError(f"no next document for doc_id {last[0]}")
                rows.append((*last, row["text"]))
                last = None
            if not row["extra"]:
                bucket, last = row["bucket"], (row["doc_id"], row["text"])
            if len(rows) >= ROUND:
                yield _compare(rows)
                rows = []
    if last is not None:
        raise ValueError(f"no next document for doc_id {last[0]}")
    if rows:
        yield _compare(rows)


def _range_of(starts: list[int]):
    """The number of the range a place lies in; what lies below the first start belongs to the first range."""
    places = np.unique(np.array(starts, np.int64))

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(places, place.to_numpy(np.int64), side="right") - 1, 0), dtype="int32")

    return range_of


def versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness to it and to the next document.

    Documents stand in the order of doc_id, null first, equal ids by a hash of their text; the last one's
    next is the first, and a single document is its own next. A null text is empty; an empty text has no
    paragraphs and is like an empty text only. Repeated rows are compared each. Other columns are ignored;
    no rows, no result. The two last columns count the differing paragraphs that were recovered.

    One shuffle moves the texts: ids are cut into ranges by approximate quantiles, one per partition, and
    the first document of a range also goes to the end of the range before, as its last one's next. Quantiles
    are doubles, which hold few of the ids above 2^53, so a range starts at the least id found in it.
    """
    spark_rows = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("place"),
        F.xxhash64("text").alias("mark"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = shuffle_partitions(docs)
    ids = spark_rows.select("place")
    lowest = ids.agg(F.min("place")).first()[0]
    found = ids.approxQuantile("place", [k / parts for k in range(1, parts)], 0.2 / parts) if lowest is not None else []
    near = [lowest if lowest is not None else 0, *(min(int(x), 2**63 - 1) for x in found)]
    rough = ids.groupBy(_range_of(near)("place").alias("range")).agg(F.min("place").alias("start"))
    starts = sorted(r["start"] for r in rough.collect())  # one a partition at most
    range_of = _range_of(starts)

    opening = F.col("place").isin(starts)
    before = F.when(F.col("bucket") == 0, F.lit(len(starts) - 1)).otherwise(F.col("bucket") - 1)
    copies: Column = F.when(
        opening,
        F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")),
            F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("extra")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))))
    spread = spark_rows.withColumn("bucket", range_of("place")).withColumn("copy", F.explode(copies))
    spread = spread.select("doc_id", "place", "mark", "text", "copy.bucket", "copy.extra")
    ordered = spread.repartitionByRange(parts, "bucket").sortWithinPartitions("bucket", "extra", "place", "mark")
    return ordered.select("doc_id", "text", "bucket", "extra").mapInArrow(_successive, RESULT)
