"""Byte-level BPE with numpy matrices, and its inverse.

New words are grouped by length into padded matrices of ids. In each round every row merges its leftmost
pair of least rank, found by argmin over a matrix of pair ranks; only the two pairs beside a merge are
looked up again, in a hash table of pairs; finished rows leave the matrix.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import pieces
from millrace.llm.word_ids import spaced_chunks

NONE = np.int32(2**31 - 1)
WIDEST = 256  # bytes; longer words have a row's work done by a heap instead of a matrix
ROWS = 20_000  # rows of a matrix at once
CACHED = 300_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairTable:
    """Ranks of id pairs: open addressing, looked up for whole arrays."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        waiting, at = np.arange(len(pairs)), self._home(pairs)
        self.probes = 0
        while len(waiting):  # every round, one of the pairs that want a free slot gets it
            free = self.keys[at] < 0
            self.keys[at[free]] = pairs[waiting[free]]
            won = self.keys[at] == pairs[waiting]
            self.ranks[at[won]] = ranks[waiting[won]]
            waiting, at = waiting[~won], (at[~won] + 1) & (len(self.keys) - 1)
            self.probes += 1

    def _home(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE where there is no such pair or an id is below 0."""
        pairs = (left.astype(np.int64) << 32) | right
        real = (left >= 0) & (right >= 0)
        pairs = np.where(real, pairs, 0)
        at = self._home(pairs)
        found = self.keys[at]
        out = np.where(found == pairs, self.ranks[at], NONE)
        rest = np.flatnonzero((found != pairs) & (found >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[at[rest]]
            hit = found == pairs[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return np.where(real, out, NONE)


class MatrixBpe:
    """Encoder and decoder of one file of ranks."""

    def __init__(self, path: str, pattern: str) -> None:
        store, place = pa.fs.FileSystem.from_uri(path)
        with store.open_input_stream(place) as stream:
            lines = stream.read().split(b"\n")
        self.whole = {base64.b64decode(a): int(b) for a, _, b in (x.partition(b" ") for x in lines if x)}
        size = max(self.whole.values()) + 1
        self.token = [b""] * size
        for token, rank in self.whole.items():
            self.token[rank] = token
        self.decimal = [str(i).encode() for i in range(size)]
        get = self.whole.get
        splits = [
            (left, right, rank)
            for token, rank in self.whole.items()
            for i in range(1, len(token))
            if (left := get(token[:i])) is not None and (right := get(token[i:])) is not None
        ]
        left, right, ranks = np.array(splits, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left << 32 | right, ranks.astype(np.int32))
        self.by_pair = dict(zip(zip(left.tolist(), right.tolist()), ranks.tolist()))
        self.byte = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.lengths = np.array([len(t) for t in self.token], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.find = regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, tuple[bytes, bytes]] = {}

    def _matrix(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of similar length."""
        lengths = np.array([len(w) for w in words])
        ids = np.full((len(words), lengths.max()), -1, np.int32)
        filled = np.arange(ids.shape[1]) < lengths[:, None]
        ids[filled] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        out: list[np.ndarray | None] = [None] * len(words)
        row = np.arange(len(words))
        ranks = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), -1)
        while len(row):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            best = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), NONE)
            done = best == NONE
            if done.any():
                for r, own, n in zip(row[done], ids[done], lengths[done]):
                    out[r] = own[:n]
                row, ids, ranks, at, best, lengths = (x[~done] for x in (row, ids, ranks, at, best, lengths))
                if not len(row):
                    break
            here, columns = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids[here, at] = best
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            lengths = lengths - 1
            for place in (at - 1, at):
                inside = (place >= 0) & (place < ranks.shape[1])
                rows, cols = here[inside], place[inside]
                ranks[rows, cols] = self.pairs.get(ids[rows, cols], ids[rows, cols + 1])
            longest = int(lengths.max())
            ids, ranks = ids[:, :longest], ranks[:, : max(0, longest - 1)]
        return out  # type: ignore[return-value]

    def _heap(self, word: bytes) -> np.ndarray:
        """The same merges, in the same order, for one very long word."""
        ids: list[int] = self.byte[np.frombuffer(word, np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank = self.by_pair.get
        queue = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(queue)
        while queue:
            best, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= size or ids[j] != b:
                continue
            ids[i], ids[j] = best, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                if (r := rank((best, ids[after[i]]))) is not None:
                    heapq.heappush(queue, (r, i, best, ids[after[i]]))
            if before[i] >= 0 and (r := rank((ids[before[i]], best))) is not None:
                heapq.heappush(queue, (r, before[i], ids[before[i]], best))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word; a word that is a token as a whole is that token."""
        raw = [w.encode("utf-8") for w in words]
        out: list[np.ndarray | None] = [None] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(raw):
            known = self.whole.get(word)
            if known is not None:
                out[i] = np.array([known], np.int32)
            elif len(word) > WIDEST:
                out[i] = self._heap(word)
            else:
                buckets.setdefault((len(word) + 3) // 4, []).append(i)
        for members in buckets.values():
            for start in range(0, len(members), ROWS):
                some = members[start : start + ROWS]
                for i, ids in zip(some, self._matrix([raw[k] for k in some])):
                    out[i] = ids
        return out  # type: ignore[return-value]

    def _learn(self, unknown: list[str]) -> None:
        split = {chunk: self.find(chunk) for chunk in unknown}
        fresh = list({w for words in split.values() for w in words if w not in self.words})
        self.words.update(zip(fresh, (ids.astype("<u4").tobytes() for ids in self.encode_words(fresh))))
        get = self.words.__getitem__
        for chunk, words in split.items():
            ids = b"".join(map(get, words))
            shown = b",".join(map(self.decimal.__getitem__, np.frombuffer(ids, "<u4").tolist()))
            self.chunks[chunk] = (ids, shown)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Of each text, its ids and the same as decimals joined by commas."""
        if len(self.words) > CACHED:
            self.words.clear()
        if len(self.chunks) > CACHED:
            self.chunks.clear()
        each = [[c for c in spaced_chunks(text) if c] for text in texts]
        unknown = {c for chunks in each for c in chunks if c not in self.chunks}
        if unknown:
            self._learn(list(unknown))
        get = self.chunks.__getitem__
        out = []
        for chunks in each:
            found = list(map(get, chunks))
            ids = np.frombuffer(b"".join([f[0] for f in found]), "<u4")
            out.append((ids, b",".join([f[1] for f in found])))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens."""
        lengths = self.lengths[ids]
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        return self.bytes[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes()


@functools.cache
def coder(path: str, pattern: str) -> MatrixBpe:
    """One coder for all tasks of a worker."""
    return MatrixBpe(path, pattern)


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in pieces(batches, 256):
            found = own.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) for ids, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(shown).hexdigest() for _, shown in found]),
                    pa.array([hashlib.sha256(own.decode(ids)).hexdigest() for ids, _ in found]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _ids(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in pieces(batches, 256):
            found = own.encode([t or "" for t in batch.column("text").to_pylist()])
            ids = pa.array([i for i, _ in found], pa.list_(pa.uint32())).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of every document; a null or empty text has no ids."""
    return docs.select("doc_id", "text").mapInArrow(_ids(path, pattern), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to, one row per row of ``docs``.

    No shuffle: a task reads whole texts and keeps a bounded cache. A null or empty text has no ids and
    the digests of nothing. Repeated rows are repeated; other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_digests(path, pattern), RESULT)
