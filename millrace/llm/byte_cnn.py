"""Quality classifier: a convolutional network over the bytes of whole documents, in numpy.

A document is covered by overlapping chunks. Learned filters slide over a chunk's bytes, each keeps its
highest response in the chunk, the chunks' responses are averaged, and two small layers make one
probability of them. A filter is a table of responses per byte and position, so sliding it is adding
looked-up rows. Only the labelled sample that trains the network is gathered, and its size is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import pieces

CHUNK = 512  # bytes
OVERLAP = 32
STRIDE = 2  # bytes between positions of a filter
WIDTH = 8  # bytes under a filter
FILTERS = 32
EMBEDDING = 8
HIDDEN = 16
PAD = 256  # stands for "no byte"; it is learned too, and tells a short text from a monotonous one

SAMPLE = 1200  # labelled documents of each label, at most, that train the network
SAMPLE_CHUNKS = 4  # evenly spread chunks of each of them that an epoch sees
SHORTENED = 0.2
EPOCHS = 16
THRESHOLD = 0.3
FOLDS = 5  # a fifth of the ids is held out

RESULT = "doc_id long, score double"


@dataclass
class Network:
    embedding: np.ndarray  # (257, EMBEDDING)
    filters: np.ndarray  # (WIDTH, EMBEDDING, FILTERS)
    filter_bias: np.ndarray
    hidden: np.ndarray  # (FILTERS, HIDDEN)
    hidden_bias: np.ndarray
    last: np.ndarray  # (HIDDEN,)
    last_bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return list(self.__dict__.values())


def fresh_network(seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int, fan: int) -> np.ndarray:
        return (rng.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)

    return Network(
        drawn(PAD + 1, EMBEDDING, fan=2),
        drawn(WIDTH, EMBEDDING, FILTERS, fan=WIDTH * EMBEDDING),
        np.zeros(FILTERS, np.float32),
        drawn(FILTERS, HIDDEN, fan=FILTERS),
        np.zeros(HIDDEN, np.float32),
        drawn(HIDDEN, fan=HIDDEN),
        np.zeros(1, np.float32),
    )


def chunks(text: bytes) -> np.ndarray:
    """The whole text as rows of CHUNK values; each row repeats at least the last OVERLAP bytes of the one
    before, the last one ends with the text. A shorter text is one padded row."""
    padded = np.full(max(CHUNK, len(text)), PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    last = len(padded) - CHUNK
    starts = np.append(np.arange(0, last, CHUNK - OVERLAP), last)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[starts]


def responses(net: Network, rows: np.ndarray, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Highest response of every filter in every row, and its position. Works in blocks that fit the cache."""
    tables = np.einsum("be,wef->wbf", net.embedding, net.filters)
    stops = CHUNK - WIDTH + 1
    best = np.empty((len(rows), FILTERS), np.float32)
    place = np.empty((len(rows), FILTERS), np.int64)
    for start in range(0, len(rows), block):
        some = rows[start : start + block]
        total = tables[0][some[:, 0:stops:STRIDE]]
        for k in range(1, WIDTH):
            total += tables[k][some[:, k : stops + k : STRIDE]]
        best[start : start + block] = total.max(axis=1)
        place[start : start + block] = total.argmax(axis=1)
    return best + net.filter_bias, place


def highest(net: Network, tables: np.ndarray, rows: np.ndarray, block: int = 64) -> np.ndarray:
    """Like responses, without positions."""
    stops = CHUNK - WIDTH + 1
    best = np.empty((len(rows), FILTERS), np.float32)
    for start in range(0, len(rows), block):
        some = rows[start : start + block]
        total = tables[0].take(some[:, 0:stops:STRIDE], axis=0)
        for k in range(1, WIDTH):
            total += tables[k].take(some[:, k : stops + k : STRIDE], axis=0)
        total.max(axis=1, out=best[start : start + block])
    return best + net.filter_bias


def combined(net: Network, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer and logit of documents' averaged responses."""
    hidden = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    return hidden, hidden @ net.last + net.last_bias[0]


def probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))


def score(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities of label 1. All chunks of all texts count; long texts pass through in blocks."""
    tables = np.einsum("be,wef->wbf", net.embedding, net.filters).astype(np.float32)
    pooled = np.empty((len(texts), FILTERS), np.float32)
    for i, text in enumerate(texts):
        pooled[i] = np.maximum(highest(net, tables, chunks(text)), 0).mean(axis=0, dtype=np.float64)
    return probability(combined(net, pooled)[1])


def _shortened(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """In one of SHORTENED draws a part of one of the rows alone, so that short texts are learned too."""
    if rng.random() >= SHORTENED:
        return rows
    row = rows[rng.integers(len(rows))].copy()
    start = rng.integers(0, CHUNK // 2)
    size = int(16 * (CHUNK / 16) ** rng.random())
    row = np.concatenate((row[start : start + size], np.full(CHUNK, PAD, row.dtype)))[:CHUNK]
    return row[None, :]


def train(texts: list[np.ndarray], labels: np.ndarray, prior: float = 0.5, seed: int = 11) -> Network:
    """Adam on the logistic loss. ``texts``: sampled chunks of each document; ``prior``: the share of
    label 1 that the two labels' weights should stand for."""
    net = fresh_network(seed)
    rng = np.random.default_rng(seed)
    if not len(texts):
        return net
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)).astype(np.float32)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
            each = [_shortened(texts[i], rng) for i in batch]
            rows = np.concatenate(each)
            sizes = np.array([len(r) for r in each])
            owner = np.repeat(np.arange(len(batch)), sizes)
            top, place = responses(net, rows)
            active = np.maximum(top, 0)
            pooled = np.add.reduceat(active, np.cumsum(sizes) - sizes) / sizes[:, None]
            hidden, logit = combined(net, pooled)
            error = ((probability(logit) - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)

            d_hidden = error[:, None] * net.last * (hidden > 0)
            d_top = (d_hidden @ net.hidden.T / sizes[:, None])[owner] * (top > 0)
            d_filters, d_embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
            row = np.arange(len(rows))[:, None]
            for k in range(WIDTH):  # only the winning position of each filter learns
                under = rows[row, place * STRIDE + k]
                d_filters[k] = np.einsum("rfe,rf->ef", net.embedding[under], d_top, optimize=True)
                np.add.at(d_embedding, under.ravel(), (d_top[:, :, None] * net.filters[k].T).reshape(-1, EMBEDDING))
            found = [
                d_embedding, d_filters, d_top.sum(0), pooled.T @ d_hidden, d_hidden.sum(0), hidden.T @ error,
                error.sum(keepdims=True),
            ]
            step += 1
            for value, slope, (first, second) in zip(net.weights(), found, moments):
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                rate = 0.004 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                value -= (rate * first / (np.sqrt(second) + 1e-7)).astype(np.float32)
    return net


def _spread_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        found = []
        for text in batch.column("text").to_pylist():
            rows = chunks((text or "").encode("utf-8", "surrogatepass"))
            chosen = np.unique(np.linspace(0, len(rows) - 1, SAMPLE_CHUNKS).round().astype(int))
            found.append(rows[chosen].astype("<i2").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())],
            names=["doc_id", "label", "chunks"],
        )


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Network:
    """The network trained on at most ``sample`` documents of each label, chosen by a hash of doc_id.

    ``labels``: doc_id and a 0/1 column; rows with nulls are left out. Without labels the network is
    the untrained one. Of a document, SAMPLE_CHUNKS chunks spread over its whole length are gathered.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(
        "doc_id is not null and label in (0, 1)"
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64(F.lit(5), "doc_id")
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(sample)
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * sample rows
    found = rows.mapInArrow(_spread_chunks, "doc_id long, label int, chunks binary").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["label"], r["chunks"]))
    texts = [np.frombuffer(r["chunks"], "<i2").reshape(-1, CHUNK) for r in found]
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    return train(texts, np.array([r["label"] for r in found]), prior)


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every document's whole text; null and empty texts score like an empty chunk.

    No shuffle. Repeated rows are repeated; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score(net, texts), pa.float64())], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def held_out() -> Column:
    """Whether an id belongs to the fold that never trains."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0


def good_documents(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with the columns of ``docs`` in their order."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(score(net, texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)
