"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked in a corpus.

Tokens of A and B that overlap in bytes belong together. Every token points to the token that overlaps it and
reaches farthest to the right: a token of A to the token of B that holds its last byte, a token of B to the token
of A that holds its last byte, or to itself if both end there. Following pointers ends at the last token of B of a
connected group, so doubling them (each takes over its successor's pointer) until nothing moves labels all tokens
with their group in as many rounds as the longest chain has binary digits, for a whole batch of texts at once.

A batch of texts, a few megabytes, is encoded and aligned in one step and leaves one narrow row per text and one
row per id pair. Pairs are summed over all batches, and what the corpus says about a batch's pairs meets the
batch's texts again by its number, so that neither texts nor single links are shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut, pieces
from millrace.llm.word_ids import TextEncoder

BATCH_CHARS = 2_000_000  # of text that are aligned together; a longer text is a batch of its own
BATCH_ROWS = 20_000
LINKS = 2_000_000  # id pairs of groups that are in memory at a time
CACHED = 500_000  # pieces of text kept by a worker at each level, about 100 MB a level

_SEGMENT = re.compile(" +[^ ]*")

TEXTS = """batch string, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long,
    groups_sha256 string, groups string, held binary, links binary, pair long, docs long"""


@functools.cache
def byte_level() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 signs stand for themselves,
    the other bytes, in order, for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelSide:
    """Tokenizer A: a byte-level tokenizer file. Encodes a space before the text; special tokens are plain text."""

    def __init__(self, path: str) -> None:
        self.encoder = TextEncoder(path, cached=CACHED)
        table = byte_level()
        entries = self.encoder.library.get_vocab()
        self.shown = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.shown[number] = bytes(table[c] for c in entry) if all(c in table for c in entry) else entry.encode()

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of a space and each text, None if it does not come back."""
        get = self.shown.__getitem__
        found = self.encoder.encode([" " + t for t in texts])
        return [x if b"".join(map(get, x.tolist())) == b" " + t.encode() else None for x, t in zip(found, texts)]


class PieceSide:
    """Tokenizer B: a sentencepiece model that puts a space before the text itself.

    If no piece goes on after a space that follows another sign, parts that start with spaces are encoded on their own
    and kept by the worker; else each text goes to the library whole. A text with U+2581, which the model cannot tell
    from a space, may get other ids this way; its bytes do not come back in either.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.shown = [
            bytes([int(e[3:5], 16)]) if self.library.is_byte(i) else e.replace("▁", " ").encode()
            for i, e in enumerate(entries)
        ]
        same = "  a  ﬁ  " * 2  # a normaliser would change it
        joined = b"".join(self.shown[i] for i in self.library.encode(same)).decode(errors="replace")
        self.apart = joined == " " + same and not any(re.search("[^▁]▁", e) for e in entries)
        self.space = self.library.piece_to_id("▁")
        self.known: dict[str, bytes | None] = {}

    def _checked(self, texts: list[str]) -> list[bytes | None]:
        """Ids as 4-byte numbers, None if their bytes are not those of a space and the text."""
        get = self.shown.__getitem__
        return [
            np.array(ids, "<i4").tobytes() if b"".join(map(get, ids)) == b" " + text.encode() else None
            for text, ids in zip(texts, self.library.encode(texts, num_threads=1))
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text, None if it does not come back."""
        if not self.apart:
            return [None if held is None else np.frombuffer(held, "<i4") for held in self._checked(texts)]
        # Where single spaces part the words, the words without them are enough to look up.
        parts = [t.split(" ") if "  " not in t and t[:1] != " " and t[-1:] != " " else [p[1:] for p in _SEGMENT.findall(" " + t)] for t in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        new = list(set().union(*parts).difference(self.known))
        self.known.update(zip(new, self._checked(new)))
        self.known[""] = np.array([self.space], "<i4").tobytes()  # the library has no ids for the empty text
        get = self.known.__getitem__
        out = []
        for some in parts:
            found = list(map(get, some))
            out.append(None if None in found else np.frombuffer(b"".join(found), "<i4"))
        return out


@functools.cache
def sides(a_path: str, b_path: str) -> tuple[ByteLevelSide, PieceSide]:
    return ByteLevelSide(a_path), PieceSide(b_path)


@functools.cache
def _lengths(side: ByteLevelSide | PieceSide) -> np.ndarray:
    return np.array([len(b) for b in side.shown], np.int64)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group, from 0 in order, of each token of A and of B; both tile the same bytes and end at these offsets."""
    n_a = len(a_ends)
    to_b = n_a + np.searchsorted(b_ends, a_ends)
    to_a = np.searchsorted(a_ends, b_ends)
    own = np.arange(n_a, n_a + len(b_ends))
    points = np.concatenate([to_b, np.where(a_ends[to_a] == b_ends, own, to_a)])
    while True:
        further = points[points]
        if np.array_equal(further, points):
            break
        points = further
    last = points[n_a:] == own
    label = np.cumsum(last) - 1  # the terminal tokens stand in order
    return label[points[:n_a] - n_a], label[points[n_a:] - n_a]


@dataclass
class Aligned:
    """Tokens of several texts one after the other, with the text and the group (over all texts) of each."""

    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    texts: int

    def per_text(self) -> dict[str, np.ndarray]:
        groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        first = np.searchsorted(self.a_group, np.arange(groups))
        of_text = self.a_text[first]
        sizes = np.bincount(self.a_group, minlength=groups) * np.bincount(self.b_group, minlength=groups)
        links = np.zeros(self.texts, np.int64)
        np.add.at(links, of_text, sizes)
        return {
            "n_a": np.bincount(self.a_text, minlength=self.texts),
            "n_b": np.bincount(self.b_text, minlength=self.texts),
            "n_groups": np.bincount(of_text, minlength=self.texts),
            "n_links": links,
        }

    def linked(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links): the distinct id pairs of each text, pair = a * ``b_size`` + b."""
        a_key, a_n = np.unique(self.a_group * 2**32 + self.a, return_counts=True)
        b_key, b_n = np.unique(self.b_group * 2**32 + self.b, return_counts=True)
        a_group, b_group = a_key >> 32, b_key >> 32
        b_first = np.searchsorted(b_group, a_group, "left")
        partners = np.searchsorted(b_group, a_group, "right") - b_first
        first = np.searchsorted(self.a_group, a_group)
        text = self.a_text[first]
        ends = np.cumsum(partners)
        found = []
        start = 0
        while start < len(a_key):  # an entry of A with all its partners is never more than the ids of B
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + LINKS, "right")))
            n = partners[start:stop]
            each = np.repeat(np.arange(start, stop), n)
            within = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            other = b_first[each] + within
            pair = (a_key[each] & 0xFFFFFFFF) * b_size + (b_key[other] & 0xFFFFFFFF)
            found.append(_summed(text[each], pair, a_n[each] * b_n[other]))
            start = stop
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return found[0] if len(found) == 1 else _summed(*(np.concatenate(x) for x in zip(*found)))

    def written(self) -> list[str]:
        """The groups of each text as a1,a2|b1;a3|b2,b3."""
        b_before = np.searchsorted(self.b_group, self.a_group, "left")
        a_before = np.searchsorted(self.a_group, self.b_group, "right")
        n = len(self.a) + len(self.b)
        a_at, b_at = np.arange(len(self.a)) + b_before, np.arange(len(self.b)) + a_before
        ids, kind, group, text = (np.empty(n, np.int64) for _ in range(4))
        for array, x, y in ((ids, self.a, self.b), (kind, 0, 1), (group, self.a_group, self.b_group), (text, self.a_text, self.b_text)):
            array[a_at], array[b_at] = x, y
        after = np.full(n, 3)
        same_group, same_kind = group[1:] == group[:-1], kind[1:] == kind[:-1]
        after[:-1] = np.where(same_group, np.where(same_kind, 0, 1), np.where(text[1:] == text[:-1], 2, 3))
        shown = _written_ids(int(ids.max(initial=0)) + 1)
        codes = (ids * 4 + after).tolist()
        cuts = np.searchsorted(text, np.arange(self.texts + 1)).tolist()
        get = shown.__getitem__
        return ["".join(map(get, codes[i:j])) for i, j in zip(cuts, cuts[1:])]


@functools.cache
def _digits(bits: int) -> list[str]:
    return [f"{i}{sign}" for i in range(2**bits) for sign in (",", "|", ";", "")]


def _written_ids(size: int) -> list[str]:
    return _digits(max(size - 1, 1).bit_length())


def _summed(text: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(text << 40 | pair, kind="stable")  # pairs of vocabularies of up to 2**20 ids each
    text, pair, links = text[order], pair[order], links[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
    starts = np.flatnonzero(new)
    return text[starts], pair[starts], np.add.reduceat(links, starts) if len(starts) else links


def align(texts: list[str | None], a: ByteLevelSide, b: PieceSide) -> Aligned:
    """Texts that are null, empty or do not come back from both sides byte by byte have no tokens."""
    given = [(i, t) for i, t in enumerate(texts) if t]
    own = [t for _, t in given]
    ids = [(i, x, y) for (i, _), x, y in zip(given, a.encode(own), b.encode(own)) if x is not None and y is not None]
    number = np.array([i for i, _, _ in ids], np.int64)

    def joined(side: int) -> tuple[np.ndarray, np.ndarray]:
        arrays = [row[side] for row in ids]
        every = np.concatenate(arrays).astype(np.int64) if arrays else np.zeros(0, np.int64)
        return every, np.repeat(number, [len(x) for x in arrays])

    (a_ids, a_text), (b_ids, b_text) = joined(1), joined(2)
    a_group, b_group = group_labels(np.cumsum(_lengths(a)[a_ids]), np.cumsum(_lengths(b)[b_ids]))
    return Aligned(a_ids, b_ids, a_text, b_text, a_group, b_group, len(texts))


def _batches(found: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Ids and texts of a bounded number of characters."""
    keys: list[int | None] = []
    texts: list[str | None] = []
    held = 0
    for batch in pieces(found, 200):
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if texts and (held + len(text or "") > chars or len(texts) >= BATCH_ROWS):
                yield keys, texts
                keys, texts, held = [], [], 0
            keys.append(key)
            texts.append(text)
            held += len(text or "")
    if texts:
        yield keys, texts


def _table(columns: dict[str, object], rows: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema
    )


def batch_rows(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False, chars: int = BATCH_CHARS) -> DataFrame:
    """Rows of two kinds for each batch: one per text with its pairs by number in ``held`` and their links in ``links``,
    and one per distinct pair, with ``place`` as its number and the texts of the batch that hold it in ``docs``."""
    schema = pa.schema(
        [(n, t) for n, t in (
            ("batch", pa.string()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
            ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
            ("held", pa.binary()), ("links", pa.binary()), ("pair", pa.int64()), ("docs", pa.int64()),
        )]
    )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(a_path, b_path)
        task = TaskContext.get().partitionId()
        for count, (keys, texts) in enumerate(_batches(found, chars)):
            name = f"{task}-{count}"
            aligned = align(texts, a, b)
            text, pair, links = aligned.linked(len(b.shown))
            pairs, number, docs_with = np.unique(pair, return_inverse=True, return_counts=True)
            cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
            number, links = number.astype("<i4"), links.astype("<i8")
            written = aligned.written()
            rows = {
                "batch": [name] * len(texts), "place": np.arange(len(texts), dtype=np.int32), "doc_id": keys,
                **aligned.per_text(),
                "groups_sha256": [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written],
                "held": [number[i:j].tobytes() for i, j in zip(cuts, cuts[1:])],
                "links": [_narrow(links[i:j]) for i, j in zip(cuts, cuts[1:])],
            }
            if keep_groups:
                rows["groups"] = written
            yield from pieces(iter([_table(rows, len(texts), schema)]), 2000)
            rows = {
                "batch": [name] * len(pairs), "place": np.arange(len(pairs), dtype=np.int32), "pair": pairs, "docs": docs_with,
            }
            yield from pieces(iter([_table(rows, len(pairs), schema)]), 20_000)

    return cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TEXTS), "alignment")


def _narrow(links: np.ndarray) -> bytes:
    """Numbers in the least of 1, 4 or 8 bytes that holds them all, which the length tells."""
    most = int(links.max(initial=0))
    return links.astype("<u1" if most < 2**8 else "<u4" if most < 2**32 else "<i8").tobytes()


def _wide(held: bytes, count: int) -> np.ndarray:
    return np.frombuffer(held, {1: "<u1", 4: "<u4", 8: "<i8"}[len(held) // count] if count else "<u1").astype(np.int64)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, total, best): texts that hold the pair linked, and whether no pair of the same id of A has more."""
    totals = cut(rows.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("total")), "alignment-pairs")
    totals = totals.withColumn("a", F.expr(f"pair div {b_size}"))
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    return totals.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False, chars: int = BATCH_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and
    ``groups`` (a1,a2|b1;a3|b2,b3) if asked for, else null.

    ``n_best`` are links whose id pair is held linked by as many texts as any pair of that id of A, ``count_sum`` the
    sum of these numbers over all links. A null or empty text, and one that either tokenizer changes, has no tokens,
    zeros and ''. Each repeated row has a result and counts as a text. Other columns are ignored; no rows, no results.
    """
    b_size = len(sides(a_path, b_path)[1].shown)
    rows = batch_rows(docs, a_path, b_path, keep_groups, chars)
    known = pair_counts(rows, b_size)
    asked = rows.where("pair is not null").select("batch", "place", "pair").join(known, "pair")
    asked = asked.select(F.col("batch").alias("of_batch"), "place", "total", "best")
    texts = rows.where("pair is null").select(
        "batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "held", "links"
    )
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        total[place] = right.column("total").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for held, links in zip(left.column("held"), left.column("links")):
            number = np.frombuffer(held.as_py(), "<i4")
            each = _wide(links.as_py(), len(number))
            n_best.append(int(each @ best[number]))
            count_sum.append(int(each @ total[number]))
        out = left.select(kept)
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    schema = """doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,
        n_best long, count_sum long"""
    return texts.groupBy("batch").cogroup(asked.groupBy("of_batch")).applyInArrow(weigh, schema)
