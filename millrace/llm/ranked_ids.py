"""Token ids as binary files of frequency ranks in byte-aligned variable-length coding.

A file holds a run of documents in ascending doc_id order. Its ids are replaced by their ranks, the most
frequent id of the file first, and a rank takes one to four bytes. The lengths stand apart from the
bytes: two bits each, four to a control byte. A reader looks all lengths up by control byte and gathers
the ranks with numpy, without a loop over ids.

File, little-endian: MAGIC; u32 count of ranks; u32 id of each rank; then blocks of u32 documents, u64
ids, u64 data bytes; i64 doc_id, u8 whether doc_id is null, and u64 count of ids per document; control
bytes; data bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut, in_order, pieces, shuffle_partitions, with_prefix_sums
from millrace.llm.word_ids import encoder
from millrace.session import scratch_dir

MAGIC = b"RANKIDS1"
FILE_IDS = 8_000_000  # a task starts a new file after so many ids, which bounds its memory
BLOCK_IDS = 500_000
_HEAD = np.dtype([("docs", "<u4"), ("ids", "<u8"), ("data", "<u8")])
#: Lengths of the four values that a control byte describes.
LENGTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
#: What to keep of four bytes read at a value of each length.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

MANIFEST = "part int, number int, path string, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    lengths = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    places = np.concatenate(([0], np.cumsum(lengths)))
    data = np.empty(places[-1], np.uint8)
    at = places[:-1]
    for k in range(4):
        longer = lengths > k
        if not longer.any():
            break
        data[at[longer] + k] = (values[longer] >> np.uint32(8 * k)).astype(np.uint8)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again, by table lookup."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    places = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = data + b"\0\0\0"
    words = np.ndarray((len(data),), "<u4", padded, strides=(1,))
    return words[places] & MASKS[lengths]


def file_bytes(doc_ids: list[int | None], texts: list[np.ndarray]) -> Iterator[bytes]:
    """A file's content, piece by piece."""
    total = np.concatenate(texts) if texts else np.empty(0, np.uint32)
    counts = np.bincount(total) if len(total) else np.empty(0, np.int64)
    used = np.flatnonzero(counts)
    by_rank = used[np.lexsort((used, -counts[used]))].astype("<u4")
    ranks = np.zeros(len(counts), np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    yield MAGIC + np.uint32(len(by_rank)).tobytes() + by_rank.tobytes()
    sizes = np.array([len(t) for t in texts], "<u8")
    block = np.cumsum(sizes) // BLOCK_IDS
    for number in np.unique(block):
        own = np.flatnonzero(block == number)
        ids = np.concatenate([texts[i] for i in own])
        control, data = pack(ranks[ids])
        keys = [doc_ids[i] for i in own]
        yield np.array([(len(own), len(ids), len(data))], _HEAD).tobytes()
        yield np.array([0 if k is None else k for k in keys], "<i8").tobytes()
        yield np.array([k is None for k in keys], np.uint8).tobytes() + sizes[own].tobytes()
        yield control + data


def read_file(stream) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """doc_ids and id arrays of each block of a file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of ranked ids")
    by_rank = np.frombuffer(stream.read(4 * int(np.frombuffer(stream.read(4), "<u4")[0])), "<u4")
    while head := stream.read(_HEAD.itemsize):
        docs, ids, data = (int(x) for x in np.frombuffer(head, _HEAD)[0])
        keys = np.frombuffer(stream.read(8 * docs), "<i8").tolist()
        nulls = np.frombuffer(stream.read(docs), np.uint8)
        sizes = np.frombuffer(stream.read(8 * docs), "<u8").astype(np.int64)
        control = stream.read(-(-ids // 4))
        values = by_rank[unpack(control, stream.read(data), ids)]
        yield [None if n else k for k, n in zip(keys, nulls)], np.split(values, np.cumsum(sizes)[:-1])


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        own = encoder(tokenizer)
        ending = np.array([end_id], own.dtype)
        keys: list[int | None] = []
        texts: list[np.ndarray] = []
        number = held = 0

        def flush() -> pa.RecordBatch:
            path = f"{root}/part-{part:07d}-{number:05d}.ids"
            fresh = f"{root}/_{uuid.uuid4().hex}"
            with store.open_output_stream(fresh) as out:
                for piece in file_bytes(keys, texts):
                    out.write(piece)
            store.move(fresh, path)  # a repeated task replaces the file by an equal one
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": number, "path": path, "n_docs": len(keys), "n_ids": held}],
                pa.schema(
                    [("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
                ),
            )

        for batch in pieces(batches, 256):
            found = own.encode([t or "" for t in batch.column("text").to_pylist()])
            for key, ids in zip(batch.column("doc_id").to_pylist(), found):
                keys.append(key)
                texts.append(np.concatenate((ids, ending)))
                held += len(ids) + 1
            if held >= FILE_IDS:
                yield flush()
                keys, texts, held, number = [], [], 0, number + 1
        if keys:
            yield flush()

    return run


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> DataFrame:
    """Writes the ids of all documents below ``folder`` and returns one row per file.

    Documents stand in ascending doc_id (null first), equal ids by their text. A null or empty text is
    its end id alone. Other columns are ignored; no rows, no files. ``folder`` is a URI or path that
    pyarrow can open on the executors.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    ordered = in_order(rows, "doc_id", "mark").select("doc_id", "text")
    return cut(ordered.mapInArrow(_write(folder, tokenizer, end_id), MANIFEST), "token-files")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["sum_before"]
                with store.open_input_stream(row["path"]) as stream:
                    for keys, texts in read_file(stream):
                        sizes = np.array([len(t) for t in texts], np.int64)
                        starts = start + np.cumsum(sizes) - sizes
                        start += int(sizes.sum())
                        sums = [zlib.crc32(t.astype("<u4").tobytes()) for t in texts]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, pa.int64()), pa.array(starts), pa.array(sizes), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and checksum, from the files alone."""
    based = with_prefix_sums(files, ["part", "number"], "n_ids", "token-file-starts")
    spread = based.select("path", "sum_before").repartition(shuffle_partitions(files))
    return spread.mapInArrow(_read(folder), RESULT)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    folder = scratch_dir(docs.sparkSession, "token-ids")
    return read_ids(write_ids(docs, tokenizer, folder, end_id), folder)
